"""Text expressions on hand-built rows."""

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from uttera import settings as S
from uttera.functions import arrays as A
from uttera.functions import text as T


def evaluate(spark, rows, schema, column):
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], f"i int, {schema}")
    return [r[0] for r in df.orderBy("i").select(column).collect()]


def clean(spark, texts):
    return evaluate(spark, [(t,) for t in texts], "t string", T.clean_transcript(F.col("t")))


def test_clean_transcript(spark):
    given_texts = ["", "@#", "  #કેમ છો?#  ", "a b", "a\t\n b", "p|q_r-s'", "<ok> [x].,!", "।॥ ः", None]
    expected = ["", "", "કેમ છો?", "a b", "a b", "p q r s", "<ok> [x].,!", "।॥ ः", None]
    assert clean(spark, given_texts) == expected


def test_clean_transcript_keeps_each_listed_character_alone(spark):
    characters = [chr(c) for c in range(0x20, 0x3000) if not 0xD800 <= c < 0xE000]
    kept = [c for c, out in zip(characters, clean(spark, characters)) if out == c]
    letters = [chr(c) for c in range(0x0A80, 0x0B00)]
    ascii_kept = [c for c in map(chr, range(128)) if c.isalnum() or c in ".,!?<>[]"]
    assert sorted(kept) == sorted([*ascii_kept, *letters, "।", "॥", "ः"])


def test_valid_transcript(spark):
    g = "ક"
    cases = {
        "": False, g: False, g * 2: True, g * 400: True, g * 401: False, "abc": False, "a઀": True, "a૿": True,
        "a੿": False, "a଀": False, f"  {g}  ": False, f" {g * 400} ": True, None: False,
    }
    assert evaluate(spark, [(t,) for t in cases], "t string", T.valid_transcript(F.col("t"))) == list(cases.values())


@pytest.mark.parametrize("space", list(S.SPACES))
def test_spaces_are_pythons(space):
    assert space.isspace()


def test_spaces_are_all_of_pythons():
    assert sorted(S.SPACES) == sorted(c for c in map(chr, range(0x110000)) if c.isspace())


def test_space_class_and_space_string_agree(spark):
    points = [(chr(c),) for c in range(1, 0x3100)]
    matched = evaluate(spark, points, "t string", F.col("t").rlike(f"^[{S.SPACE_CLASS}]\\z"))
    assert [m for m, (c,) in zip(matched, points) if m != (c in S.SPACES)] == []


def pauses(spark, cases):
    return evaluate(spark, cases, "t string, n int", T.insert_pause_tags(F.col("t"), F.col("n"), "<p>"))


def test_pause_tags(spark):
    cases = [
        ("a b c d e", -1), ("a b c d e", 0), ("a b c d e", 1), ("a b c", 1), ("a b c d e", 4), ("a b c d e", 5),
        ("a b c d e", 1000), ("", 3), ("   ", 3), ("one", 3), ("a  b", 0), ("a  b", 1), ("a b", None), (None, 2),
    ]
    assert pauses(spark, cases) == [
        "a b c d e", "a b c d e", "a b <p> c d e", "a b <p> c", "a <p> b <p> c <p> d <p> e",
        "a <p> b <p> c <p> d <p> e", "a <p> b <p> c <p> d <p> e", "", "   ", "one", "a  b", "a <p> b", "a b", None,
    ]


@settings(max_examples=5, deadline=None)
@given(st.lists(st.tuples(st.integers(2, 40), st.integers(1, 50)), min_size=20, max_size=40))
def test_pause_tags_fall_on_rounded_boundaries(spark, sizes):
    texts = [(" ".join(f"w{i}" for i in range(words)), gaps) for words, gaps in sizes]
    for (words, gaps), tagged in zip(sizes, pauses(spark, texts)):
        parts = tagged.split()
        n = min(gaps, words - 1)
        assert [p for p in parts if p != "<p>"] == [f"w{i}" for i in range(words)]
        places = [parts[: at].count("<p>") for at, p in enumerate(parts) if p == "<p>"]
        before = [int(parts[at + 1][1:]) for at, p in enumerate(parts) if p == "<p>"]
        assert places == list(range(n))
        assert before == [round(k * words / (n + 1)) for k in range(1, n + 1)]


def test_tokens_round_trip(spark):
    rows = [([],), ([12, 5, 900],), ([12799, 12800],)]
    strings = evaluate(spark, rows, "t array<int>", T.tokens_to_str(F.col("t")))
    assert strings == ["", "<|s_12|><|s_5|><|s_900|>", "<|s_12799|><|s_12800|>"]
    assert evaluate(spark, [(s,) for s in strings], "t string", T.parse_speech_tokens(F.col("t"))) == [r[0] for r in rows]


def test_parse_ignores_other_text(spark):
    rows = [("x<|s_x|>a<|s_7|> b<|s_ 8|><|s_9|>",), ("none",), (f"<|s_{10**30}|>",)]
    assert evaluate(spark, rows, "t string", T.parse_speech_tokens(F.col("t"))) == [[7, 9], [], [None]]


def test_chatml(spark):
    prompt = T.chatml(T.user_message(F.col("t")), generation_prompt=True)
    both = T.chatml(T.build_messages(F.col("t"), F.lit("<|s_1|>")))
    assert evaluate(spark, [(" hi ",)], "t string", prompt) == [
        "<|im_start|>user\nhi<|im_end|>\n<|im_start|>assistant\n"
    ]
    assert evaluate(spark, [("hi",)], "t string", both) == [
        "<|im_start|>user\nhi<|im_end|>\n<|im_start|>assistant\n<|s_1|><|im_end|>\n"
    ]


def test_utterance_id(spark):
    rows = [("1", "a"), (None, "a"), ("1", None), (None, None), ("", "")]
    built = evaluate(spark, rows, "s string, p string", T.utterance_id(F.col("s"), F.col("p")))
    assert built == ["1_a", "None_a", "1_None", "None_None", "_"]


def test_prompt_len_and_labels(spark):
    rows = [([1, 2], [1, 2, 3]), ([1, 2], [1, 2]), ([1, 9], [1, 2, 3]), ([9], [1]), ([1, 2, 3], [1]), ([], [1])]
    schema = "p array<int>, f array<int>"
    length = A.prompt_len(F.col("p"), F.col("f"))
    assert evaluate(spark, rows, schema, length) == [2, 2, 1, 0, 1, 0]
    assert evaluate(spark, rows, schema, A.label_mask(F.col("f"), length)) == [
        [-100, -100, 3], [-100, -100], [-100, 2, 3], [1], [-100], [1]
    ]


def test_array_functions(spark):
    nan = float("nan")
    rows = [([3.0, 4.0],), ([0.0, 0.0],), ([1.0, 1.0],)]
    normal = evaluate(spark, rows, "v array<double>", A.l2_normalize(F.col("v")))
    assert normal == [[0.6, 0.8], [0.0, 0.0], [pytest.approx(2**-0.5)] * 2]
    kept = evaluate(spark, [([nan, 1.0],)], "v array<double>", A.l2_normalize(F.col("v")))[0]
    assert kept[0] != kept[0] and kept[1] == 1.0
    assert evaluate(spark, [([1.0, 5.0, 5.0],), ([],)], "v array<double>", A.argmax(F.col("v"))) == [1, None]
    logits = [([[0.0, 1.0], [3.0, 2.0]],)]
    assert evaluate(spark, logits, "v array<array<double>>", A.argmax_each(F.col("v"))) == [[1, 0]]
    stereo = [([[1.0, 3.0], [2.0, 4.0]],), ([[]],)]
    assert evaluate(spark, stereo, "v array<array<double>>", A.downmix(F.col("v"), "last")) == [[2.0, 3.0], [None]]
    assert evaluate(spark, stereo, "v array<array<double>>", A.downmix(F.col("v"), "first")) == [[1.5, 3.5], []]
    assert evaluate(spark, [([0, 12799, 12800, -1],)], "v array<int>", A.out_of_range(F.col("v"))) == [2]
    assert evaluate(spark, [([1] * 50,)], "v array<int>", A.token_duration(F.col("v"))) == [2.0]
