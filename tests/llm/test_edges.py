"""Nulls, empty and long texts, ties, repeated rows, empty tables and clashing columns for every operator and stage."""

import collections
import itertools
import math
import random

import pytest
from pyspark.sql import functions as F

import corpus_pipeline as pipeline
from tests.llm.test_contracts import SF, plain_fingerprint
from uttera.llm import byte_network, chat, components, decontaminate, language, licenses, mixing, near_copies, pii, quality_rules, reputation, simhash

DOCS = "doc_id long, text string, lang string, source string, n_chars long, score string, key string, host string, row string, "
DOCS += "rejected string, topic string, _source string, _found string, _clean string, _pii string, _host string"
WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau upsilon".split()


def sentence(seed, n):
    chosen = random.Random(seed)
    return " ".join(chosen.choice(WORDS) + str(chosen.randrange(50)) for _ in range(n))


@pytest.fixture(scope="module")
def odd(spark):
    """Null in every column, empty and long texts, a repeated row, an id used twice, columns with clashing names."""
    rows = [
        (1, sentence(1, 60), "en", "a"), (1, sentence(1, 60), "en", "a"), (2, None, "en", "a"), (3, "", None, None),
        (4, "  \n\t ", "fr", "b"), (5, sentence(5, 30_000), "en", "b"), (6, sentence(1, 60), None, "a"), (None, sentence(7, 40), "de", None),
        (8, "123 456", "de", "a"), (9, "é", "fr", "a"), (1, sentence(9, 50), "en", "c"), (None, None, None, None),
        (12, "mail a@b.de general public license cc by", "en", "a"),
    ]
    full = [(d, t, lang, s, None if t is None else len(t), "x", None, "h", "r", "j", "t", *"abcde") for d, t, lang, s in rows]
    return spark.createDataFrame(full, DOCS)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="module")
def items(spark):
    return spark.createDataFrame([(1, sentence(7, 40)), (1, sentence(7, 40)), (2, "too short"), (3, None), (None, sentence(9, 50))], "item_id long, text string")


@pytest.mark.parametrize("name,stage", pipeline.STAGES)
def test_stages_take_odd_and_empty_tables(spark, odd, empty, name, stage):
    for docs in (odd, empty):
        out = stage(spark, docs, SF)
        assert out.columns[: len(docs.columns)] == docs.columns
        assert out.count() <= docs.count()
    kept = stage(spark, odd, SF).select("score", "host", "row", "rejected", "_source", "_found", "_clean", "_pii", "_host").distinct()
    assert [tuple(r) for r in kept.collect()] == [("x", "h", "r", "j", *"abcde")]


def test_near_duplicate_stage_keeps_one_row_of_each_group(spark, odd):
    kept = pipeline.drop_near_duplicates(spark, odd, SF).select("doc_id", "text").collect()
    # 1 stands for its repeated row and for 6, its other text for itself; 2 for all wordless rows, the one without an id too.
    want = {(1, sentence(1, 60)), (1, sentence(9, 50)), (2, None), (5, sentence(5, 30_000)), (None, sentence(7, 40)), (8, "123 456"), (9, "é")}
    want.add((12, "mail a@b.de general public license cc by"))
    assert len(kept) == len(want) and set(map(tuple, kept)) == want
    # An id with a copy and another text loses the copy only; of rows without an id one of each text stays.
    rows = [(1, sentence(1, 60)), (2, sentence(1, 60)), (2, sentence(2, 60)), (None, sentence(3, 60)), (None, sentence(3, 60))]
    kept = near_copies.keep_one_row(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted(map(tuple, kept), key=str) == sorted([rows[0], rows[2], rows[3]], key=str)


def test_components_of_chains_stars_and_rings(spark):
    chosen = random.Random(3)
    links = [(i, i + 1) for i in range(100, 400)] + [(7, i) for i in range(1000, 1500)] + [(2000 + i, 2000 + (i + 1) % 50) for i in range(50)]
    links += [(5, 5), (None, 3)]
    chosen.shuffle(links)
    got = dict(map(tuple, components.components(spark.createDataFrame(links, "a long, b long")).collect()))
    want = dict.fromkeys(range(101, 401), 100) | dict.fromkeys(range(1000, 1500), 7) | dict.fromkeys(range(2001, 2050), 2000)
    assert got == want


def test_ball_links_equal_brute_force(spark):
    chosen = random.Random(4)
    prints = {chosen.getrandbits(64) for _ in range(60)}
    for value in list(prints):
        for _ in range(4):
            value ^= 1 << chosen.randrange(64)
            prints.add(value ^ (1 << chosen.randrange(64)) * chosen.randrange(2))
    signed = sorted(p - (p >> 63 << 64) for p in prints)
    found = simhash.close_fingerprints(spark.createDataFrame([(p,) for p in signed], "simhash long"))
    got = dict(map(tuple, components.components(found).collect()))
    want = {p: p for p in signed}
    for a, b in sorted(itertools.combinations(signed, 2)):
        if ((a ^ b) & (1 << 64) - 1).bit_count() <= 2:
            low, high = sorted((want[a], want[b]))
            want = {p: low if r == high else r for p, r in want.items()}
    assert {p: got.get(p, p) for p in signed} == want


def jaccard(one, other):
    one, other = set(plain_grams(one)), set(plain_grams(other))
    return len(one & other) / len(one | other) if one | other else 1.0


def plain_grams(text):
    words = (text or "").encode().lower().split()
    return [b" ".join(words[i : i + 5]) for i in range(max(1, len(words) - 4))] if words else []


def plain_groups(texts, similarity=0.8):
    """Components of all pairs that are similar enough; texts by id."""
    root = {d: d for d in texts}

    def find(d):
        while root[d] != d:
            d = root[d]
        return d

    grams = {d: set(plain_grams(t)) for d, t in texts.items()}
    for a, b in itertools.combinations(sorted(texts), 2):
        both = len(grams[a] & grams[b])
        if both >= similarity * (len(grams[a]) + len(grams[b]) - both) - 1e-9:
            x, y = find(a), find(b)
            root[max(x, y)] = min(x, y)
    return {d: find(d) for d in texts}


def edited_texts():
    """Copies changed in ever more words, texts that share a passage alone, and short ones."""
    texts, passage = {}, sentence(99, 60)
    for i in range(10):
        words = sentence(i, 150).split()
        for j in range(6):
            texts[len(texts)] = " ".join(words)
            words[(37 * j + 11 * i) % 150] = f"other{i}{j}"
    for i in range(80):
        texts[100 + i] = f"{sentence(500 + i, 20)} {passage} {sentence(900 + i, 30)}"
    return texts | {200: "", 201: " ", 202: "one two", 203: "One  two", 204: "three", 205: None}


def test_near_copies_equal_all_pairs(spark):
    texts = edited_texts()
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    kept = {r["doc_id"] for r in near_copies.keep_one_row(docs).collect()}
    assert kept == set(plain_groups(texts).values())


def test_near_copies_divide_a_bucket_of_strangers(spark, monkeypatch):
    """With one shingle a sample, texts of a common passage fill buckets of strangers; pairs are found in later rounds."""
    texts = {i: t for i, t in edited_texts().items() if i >= 100}
    for i in range(0, 80, 4):
        texts[300 + i] = texts[100 + i].replace(" ", " new ", 1)
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    contents = near_copies.contents_of(docs, "doc_id", "text", 16, 1)
    found = components.components(near_copies.links(docs, contents, "text", 16, 0.8)).count()
    groups = plain_groups(texts)
    # Wordless texts are one content.
    pairs = sum(d != r for d, r in groups.items()) - 2
    assert 0.9 * pairs <= found <= pairs


def test_samples_are_simhashes_of_the_least_shingles():
    hashes = near_copies.different(sentence(3, 100).encode())
    for family, found in enumerate(near_copies.samples(hashes, 4, 5), 1):
        own = []
        for h in map(int, hashes):
            mask = (1 << 64) - 1
            h = (h + 0x9E3779B97F4A7C15 * family) & mask
            h = ((h ^ h >> 30) * 0xBF58476D1CE4E5B9) & mask
            h = ((h ^ h >> 27) * 0x94D049BB133111EB) & mask
            own.append(h ^ h >> 31)
        least = sorted(own)[:5]
        assert found & (1 << 64) - 1 == sum(1 << b for b in range(64) if sum(h >> b & 1 for h in least) > 2)


def test_fingerprints_of_few_words():
    for text in ("", "a", "a b", "A B c", "a b c d", "x " * 200_000):
        value = simhash.fingerprint(text.encode(), 3)
        assert value & (1 << 64) - 1 == plain_fingerprint(text)


def test_decontamination_of_odd_rows(odd, empty, items):
    found = {(r["doc_id"], r["item_id"]) for r in decontaminate.contaminated(odd, items).collect()}
    assert found == {(None, 1), (1, None)}
    assert decontaminate.contaminated(empty, items).count() == 0
    assert decontaminate.contaminated(odd, items.limit(0)).count() == 0


def test_decontamination_stage_drops_rows_not_ids(spark, odd, items, monkeypatch):
    monkeypatch.setattr(pipeline, "table", lambda *_: items)
    kept = pipeline.drop_benchmark(spark, odd, SF).select("doc_id", "text").collect()
    # The items' own texts go; the null row without an id, and the other rows of id 1, do not hold them.
    want = [tuple(r) for r in odd.select("doc_id", "text").collect() if r["text"] not in (sentence(7, 40), sentence(9, 50))]
    assert len(want) == 11 and sorted(map(tuple, kept), key=str) == sorted(want, key=str)


def test_decontamination_of_a_common_opening_grows_with_the_items(spark, monkeypatch):
    """Items and documents that share an opening and nothing else are no candidates of each other."""
    opening, sizes = sentence(77, 14), []
    plain = decontaminate._candidates

    def counted(*given):
        found = plain(*given)
        sizes.append(found.agg(F.coalesce(F.sum(F.size("sigs")), F.lit(0))).first()[0])
        return found

    monkeypatch.setattr(decontaminate, "_candidates", counted)
    for n in (60, 240):
        items = spark.createDataFrame([(i, f"{opening} {sentence(1000 + i, 30)}") for i in range(n)], "item_id long, text string")
        rows = [(i, f"{opening} {sentence(9000 + i, 40)}") for i in range(n)] + [(n, f"{opening} {sentence(1000, 30)}")]
        found = decontaminate.contaminated(spark.createDataFrame(rows, "doc_id long, text string"), items).collect()
        assert [(r["doc_id"], r["item_id"]) for r in found] == [(n, 0)]
    # A stranger may share the word after the opening too.
    assert max(sizes) < 10


def test_decontamination_in_the_middle_with_changes(spark):
    item = sentence(20, 60).split()
    changed = [*item[:30], "other", *item[31:]]
    docs = [
        (1, " ".join([sentence(21, 500), *item, sentence(22, 500)])), (2, " ".join([sentence(23, 77), *changed, sentence(24, 3)])),
        (3, " ".join(item[:25])), (4, ". ".join(w.upper() for w in item)), (5, " ".join(item * 50)), (6, sentence(26, 900)),
    ]
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    got = {r["doc_id"]: r for r in decontaminate.contaminated(frame, spark.createDataFrame([(9, " ".join(item))], "item_id long, text string")).collect()}
    assert set(got) == {1, 2, 4, 5}
    assert got[1]["first_word"] == 500 and got[1]["similarity"] == 1 and got[1]["distance"] == 0
    assert got[2]["first_word"] == 77 and got[2]["similarity"] == round(51 / 61, 6)


def test_decontamination_near_the_limit(spark):
    """Windows that share 50 of 56 shingles with their item, 0.806: fingerprints differ in about ten bits, some in more."""
    items = [(n, sentence(1000 + n, 60)) for n in range(150)]
    docs = [(n, " ".join([sentence(2000 + n, 40), *text.split()[:54], sentence(3000 + n, 40)])) for n, text in items]
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    known = spark.createDataFrame(items, "item_id long, text string")
    got = decontaminate.contaminated(frame, known).collect()
    assert {(r["doc_id"], r["item_id"]) for r in got} == {(n, n) for n, _ in items}
    # Rows that are there many times give what one of them gives.
    many = frame.filter("doc_id < 3").crossJoin(spark.range(200)).drop("id")
    again = decontaminate.contaminated(many, known).collect()
    assert sorted(again) == sorted(r for r in got if r["doc_id"] < 3)


def test_quality_rules_of_odd_rows(spark, odd, empty):
    labels = spark.createDataFrame([(1, 1), (2, 0), (5, 1), (5, 1), (8, None), (None, 0), (99, 0)], "doc_id long, quality int")
    for known in (labels, labels.limit(0)):
        rows = quality_rules.judge(odd, known).collect()
        assert len(rows) == odd.count()
        assert all(r["base_failed"] and not r["kept"] for r in rows if r["n_words"] < 10)
    assert quality_rules.judge(empty, labels).count() == 0


def test_isolation_paths_are_short_for_the_odd_one():
    import numpy as np

    rows = np.random.default_rng(1).normal(size=(500, 8))
    rows[0] = 9
    scores = quality_rules.Forest(rows).score(rows)
    assert scores.argmax() == 0 and 0 < scores.min() and scores.max() < 1


def test_language_of_odd_rows(odd, empty):
    model = language.fit(odd)
    rows = language.identify(odd, model).select("doc_id", "text", "lang_pred", "score", "rejected").collect()
    assert len(rows) == odd.count()
    for r in rows:
        if not any(map(str.isalpha, r["text"] or "")):
            assert (r["lang_pred"], r["score"], r["rejected"]) == ("und", 0.0, True)
    assert language.identify(odd, language.fit(empty)).filter("lang_pred != 'und'").count() == 0


def test_network_of_odd_rows(odd, empty):
    labels = odd.sparkSession.createDataFrame([(5, 0), (1, 1), (1, 1), (2, 0), (None, 1), (8, None), (99, 1)], "doc_id long, quality int")
    for known in (labels, labels.limit(0), labels.filter("quality = 1")):
        scores = [r[0] for r in byte_network.score(odd, byte_network.fit(odd, known)).select("score").collect()]
        assert len(scores) == odd.count() and all(0 <= s <= 1 for s in scores)
    assert byte_network.fit(empty, labels).prior == 0.5 and not byte_network.fit(empty, labels).fitted
    assert byte_network.score(empty, byte_network.Network()).count() == 0


def test_network_gradient_and_pieces():
    import numpy as np

    network = byte_network.Network()
    network.fitted = True
    text, label = b"some text of a few words " * 40, 1.0
    gradient, _ = network.gradients(text, label)

    def loss():
        return -np.log(network.probability(text))

    for name, at in (("head", 3), ("shift", 0), ("bias", 2), ("filters", (5, 1)), ("embedding", (ord("e"), 2)), ("embedding", (ord(" "), 0))):
        before = network.p[name].copy()
        # Windows are views of four-byte numbers, so the embedding stays as it is.
        step = 1e-3 if name == "embedding" else 1e-4
        network.p[name] = before.copy() if name == "embedding" else before.astype(np.float64)
        network.p[name][at] += step
        up = loss()
        network.p[name][at] -= 2 * step
        slope = (up - loss()) / (2 * step)
        network.p[name] = before
        assert abs(slope - gradient[name][at]) < 1e-2 + 0.05 * abs(slope)
    long = bytes(random.Random(2).choices(b"abc def", k=byte_network.PIECE * 2 + 77))
    codes = np.frombuffer(byte_network.padded(long), np.uint8)
    assert np.allclose(network.maxima(long), network.blocks(codes)[0], atol=1e-5)


def test_forest_scores_are_plain_path_lengths():
    """Every row walks every tree, node by node; and odd rows have short paths."""
    import numpy as np

    random_ = np.random.default_rng(3)
    rows = np.vstack([random_.normal(0, 1, (300, 5)), random_.normal(9, 1, (6, 5)), np.zeros((20, 5))])
    forest = quality_rules.Forest(rows)

    def path(row, tree):
        feature, cut, left, right, length = tree
        at = 0
        while feature[at] >= 0:
            at = left[at] if row[feature[at]] < cut[at] else right[at]
        return length[at]

    size = min(quality_rules.DEPTH_ROWS, len(rows))
    usual = 2 * sum(1 / i for i in range(1, size)) - 2 * (size - 1) / size
    plain = [2 ** -(sum(path(r, t) for t in forest.trees) / len(forest.trees) / usual) for r in rows]
    got = forest.score(rows)
    assert np.allclose(got, plain, atol=2e-3)
    assert got[300:306].min() > np.percentile(got[:300], 95)


def test_forest_sample_holds_copies_in_proportion(spark, monkeypatch):
    """A third of the rows are one text: it neither fills the sample nor is missing from it."""
    import numpy as np

    monkeypatch.setattr(quality_rules, "TREES", 2)
    monkeypatch.setattr(quality_rules, "DEPTH_ROWS", 150)
    samples = []
    monkeypatch.setattr(quality_rules, "Forest", lambda sample: samples.append(sample))
    rows = [(i, sentence(0, 77) if i % 3 == 0 else sentence(i, 20 + i % 40) + " #$" * (i % 13)) for i in range(3000)]
    counted = quality_rules.with_statistics(spark.createDataFrame(rows, "doc_id long, text string")).drop("text").withColumn("bad", F.lit(False))
    quality_rules.fit_forest(counted, "doc_id")
    kinds, counts = np.unique(samples[0].round(9), axis=0, return_counts=True)
    assert len(samples[0]) == 300 and 60 <= counts.max() <= 140 and len(kinds) > 50


def plain_vectors(texts):
    """TF-IDF of hashed byte trigrams, a dictionary per text."""
    def fold(text):
        return b" " + bytes(c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c > 127 else 32 for c in text.encode()) + b" "

    def slot(gram):
        return (int.from_bytes(gram, "big") * 2654435761 % 2**32) >> 20

    counts = []
    for text in texts:
        folded = fold(text)
        counts.append(collections.Counter(slot(folded[i : i + 3]) for i in range(len(folded) - 2) if folded[i : i + 3] != b"   "))
    df = collections.Counter(k for c in counts for k in c)
    idf = {k: math.log((1 + len(texts)) / (1 + n)) + 0.1 for k, n in df.items()}
    rows = [{k: math.log1p(n) * idf[k] for k, n in c.items()} for c in counts]
    norms = [math.sqrt(sum(x * x for x in r.values())) for r in rows]
    return [{k: x / n for k, x in r.items()} if n else r for r, n in zip(rows, norms, strict=True)]


def test_language_is_the_nearest_centroid(spark):
    """Vectors equal a plain TF-IDF, and the language predicted is that of the centroid with the greatest plain cosine."""
    import numpy as np

    stems = {"en": ("the", "ing", "tion", "and"), "fr": ("eau", "ment", "les", "que"), "de": ("sch", "ung", "der", "ich")}
    chosen = random.Random(5)
    rows = [(i, " ".join(chosen.choice(stems[lang]) + chosen.choice(stems[lang]) for _ in range(30)), lang) for i, lang in enumerate(list(stems) * 30)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = language.fit(docs)
    plain = plain_vectors([t for _, t, _ in rows])
    for (_, text, _), want in zip(rows, plain, strict=True):
        got = language.vector(language.gram_counts(text.encode()), model.idf)
        assert {int(k) for k in np.flatnonzero(got)} == {k for k, x in want.items() if x}
        assert all(abs(got[k] - x) < 1e-4 for k, x in want.items())
    found = {r["doc_id"]: r for r in language.identify(docs, model).collect()}
    for (i, _, lang), want in zip(rows, plain, strict=True):
        cosines = [sum(x * float(centre[k]) for k, x in want.items()) for centre in model.centres]
        best = max(range(len(cosines)), key=cosines.__getitem__)
        assert found[i]["lang_pred"] == model.languages[best] == lang
        assert abs(found[i]["score"] - cosines[best]) < 1e-3


def plain_probability(network, text):
    """The forward pass window by window."""
    p, width, stride, block = network.p, byte_network.WIDTH, byte_network.STRIDE, byte_network.BLOCK
    size = len(text) + width
    size += -size % (block * stride)
    codes = list(text) + [0] * (size + width)
    responses = []
    for w in range(size // stride):
        seen = [float(x) for code in codes[w * stride : w * stride + width] for x in p["embedding"][code]]
        responses.append([sum(x * float(p["filters"][i][f]) for i, x in enumerate(seen)) for f in range(byte_network.FILTERS)])
    blocks = [[max(r[f] for r in responses[a : a + block]) for f in range(byte_network.FILTERS)] for a in range(0, len(responses), block)]
    chunks = [[max(a, b) for a, b in zip(x, y, strict=True)] for x, y in itertools.pairwise(blocks)] if len(blocks) > 1 else blocks
    chunks = [[max(0.0, x + float(b)) for x, b in zip(c, p["bias"], strict=True)] for c in chunks]
    columns = list(zip(*chunks, strict=True))
    features = [sum(c) / len(c) for c in columns] + [max(c) for c in columns]
    logit = sum(x * float(h) for x, h in zip(features, p["head"], strict=True)) + float(p["shift"][0])
    return 1 / (1 + math.exp(-logit))


@pytest.mark.parametrize("text", [b"", b"a", b"some words of a text", b"x" * 255, b"ab cd " * 120, bytes(range(256)) * 3])
def test_network_forward_pass(text):
    network = byte_network.Network()
    network.fitted = True
    network.p["head"] = network.p["head"] * 20
    assert abs(network.probability(text) - plain_probability(network, text)) < 1e-4


def labelled_texts(n, length=40):
    """Good texts of words, bad ones of marks among them."""
    chosen = random.Random(12)
    for i in range(n):
        words = sentence(i, chosen.randrange(5, length)).split()
        if i % 3 == 0:
            words = [w + chosen.choice(["##", "$|", "%%"]) if chosen.random() < 0.5 else w for w in words]
        yield i, " ".join(words), int(i % 3 != 0)


def test_network_on_held_out_texts_and_labels_beyond_the_table(spark):
    rows = list(labelled_texts(500))
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(i, q) for i, _, q in rows if i < 350], "doc_id long, quality int")
    network = byte_network.fit(docs, labels)
    scores = {r["doc_id"]: r["score"] for r in byte_network.score(docs, network).collect()}
    right = [(scores[i] >= 0.5) == (q == 1) for i, _, q in rows if i >= 350]
    assert sum(right) / len(right) > 0.9
    # Labels of rows that are not there change nothing.
    others = spark.range(10_000, 60_000).select(F.col("id").alias("doc_id"), F.lit(0).alias("quality"))
    again = byte_network.fit(docs, labels.unionByName(others))
    assert again.prior == network.prior and all((again.p[k] == network.p[k]).all() for k in network.p)


def test_network_learns_from_long_texts_only(spark):
    rows = [(i, (t + " ") * (byte_network.FIT_BYTES * 2 // len(t)), q) for i, t, q in labelled_texts(24)]
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    network = byte_network.fit(docs, spark.createDataFrame([(i, q) for i, _, q in rows], "doc_id long, quality int"))
    assert network.fitted
    text = "".join(chr(97 + i % 26) for i in range(1000))
    cut = docs.limit(1).select(byte_network.excerpt(F.lit(text).cast("binary"), 100, 5).alias("e")).first()["e"]
    assert cut.decode() == "".join(text[a : a + 20] for a in (0, 245, 490, 735, 980))


def test_licenses_of_odd_rows(odd, empty):
    rows = {(r["doc_id"], r["n_words"]): r for r in licenses.scan(odd).collect()}
    assert licenses.scan(odd).count() == odd.count() and licenses.scan(empty).count() == 0
    assert rows[12, 9]["base_labels"] == "cc-by,gpl" and (rows[12, 9]["first_word"], rows[12, 9]["last_word"]) == (4, 7)
    assert rows[2, 0]["labels"] == "" and rows[2, 0]["score"] == 0 and rows[2, 0]["first_word"] is None


def test_license_with_a_word_left_out(spark):
    sentence = "This work is licensed under GNU General Public License, version 3. CC BY CC-BY"
    row = licenses.scan(spark.createDataFrame([(1, sentence)], "doc_id long, text string")).first()
    assert row["labels"] == "cc-by,gpl,gpl-3.0" and row["n_base"] == 3 and (row["first_word"], row["last_word"]) == (6, 13)


def test_reputation(spark):
    pages = [(i, u) for i, u in enumerate([
        "http://A.Example.com/en/x?q", "https://www.example.com/en/", "x://net/es/", "http://b.net/fr", None, "nothing", "http://solo", "http://bad.org/a#b://c", "://",
    ])] + [(100 + i, f"http://bad.org/{i}") for i in range(60)]
    frame = spark.createDataFrame(pages, "page_id long, url string").withColumn("domain", F.lit("kept"))
    outcomes = spark.createDataFrame([(u, 1) for _, u in pages[-60:]] + [("http://solo", 0)] * 60 + [(None, None)], "url string, bad int")
    rules = [("allow", "com/"), ("block", "example.com/en/"), ("allow", "www.example.com/en/"), ("block", "net/es/"), ("block", "net/fr/")]
    got = {r["page_id"]: r for r in reputation.judge(frame, outcomes, rules).collect()}
    assert [got[i]["rule"] for i in range(4)] == ["example.com/en/", "www.example.com/en/", "net/es/", None]
    assert [got[i]["verdict"] for i in (0, 1, 2, 6, 7)] == ["block", "allow", "block", "allow", "block"]
    assert [(got[i]["host"], got[i]["path"]) for i in (0, 4, 5, 7)] == [("a.example.com", "/en/x"), ("", ""), ("", ""), ("bad.org", "/a")]
    assert len(got) == len(pages) and got[0]["domain"] == "kept"
    nothing = reputation.judge(frame, outcomes.limit(0), rules)
    assert nothing.filter("rule is null and verdict = 'block'").count() == 0
    assert reputation.judge(frame.limit(0), outcomes, rules).count() == 0


def test_mixing_meets_its_targets(spark):
    chosen = random.Random(6)
    cells = [(s, lang, t, chosen.randrange(500, 3000)) for s in "abc" for lang in ("en", "fr", None) for t in "xy"]
    frame = spark.createDataFrame(cells, "source string, lang string, topic string, tokens long")
    raked = mixing.rake(frame, sweeps=16).collect()
    total = sum(c[3] for c in cells)
    for axis, power in mixing.TEMPERATURES.items():
        sums, weights = collections.Counter(), collections.Counter()
        for r in raked:
            sums[r[axis]] += r["tokens"]
            weights[r[axis]] += r["weight"]
        scale = sum(v**power for v in sums.values())
        for value, tokens in sums.items():
            assert tokens**power / scale * mixing.BUDGET * total < tokens
            assert abs(weights[value] / (mixing.BUDGET * total) - tokens**power / scale) < 1e-3
    assert all(0 <= r["weight"] <= r["tokens"] for r in raked)


def test_reputations_equal_plain_shrinkage(spark):
    chosen = random.Random(21)
    hosts = {f"{h}.{d}": (h, d) for d in ("a.com", "b.com", "c.co.uk", "d.co.uk", "e.org", "10.0.0.1") for h in ("x", "y:8080", "z")}
    rates = {h: chosen.choice([0.02, 0.1, 0.7]) for h in hosts}
    rows = [(h, int(chosen.random() < rates[h])) for h in hosts for _ in range(chosen.randrange(1, 60))] + [("new.b.com", None), ("solo", None), ("9.9.9.9", None)]
    frame = reputation.with_levels(spark.createDataFrame(rows, "host string, bad int"))
    levels = {r["host"]: (r["suffix"], r["domain"]) for r in frame.collect()}
    assert levels["x.c.co.uk"] == ("co.uk", "c.co.uk") and levels["y:8080.a.com"] == ("com", "a.com")
    assert levels["9.9.9.9"] == ("ip", "9.9.9.9") and levels["solo"] == ("solo", "solo")
    counts = collections.defaultdict(lambda: [0, 0])
    for host, bad in rows:
        if bad is not None:
            counts[host][0] += bad
            counts[host][1] += 1

    def totals(key):
        out = collections.defaultdict(lambda: [0, 0])
        for host in levels:
            for k in (0, 1):
                out[key(host)][k] += counts[host][k]
        return out

    def shrink(groups, prior):
        excess = sum((b - n * prior[g]) ** 2 - n * prior[g] * (1 - prior[g]) for g, (b, n) in groups.items())
        scale = sum(n * (n - 1) * prior[g] * (1 - prior[g]) for g, (_, n) in groups.items())
        worth = min(200, max(1, scale / excess - 1)) if excess > 0 else 200
        return {g: (b + worth * prior[g]) / (n + worth) for g, (b, n) in groups.items()}

    whole = sum(b for b, _ in counts.values()) / sum(n for _, n in counts.values())
    suffixes = totals(lambda h: levels[h][0])
    by_suffix = shrink(suffixes, dict.fromkeys(suffixes, whole))
    domains = totals(lambda h: levels[h])
    by_domain = shrink(domains, {d: by_suffix[d[0]] for d in domains})
    want = shrink(totals(lambda h: h), {h: by_domain[levels[h]] for h in levels})
    got = {r["host"]: (r["mean"], r["bound"]) for r in reputation.reputations(frame).collect()}
    assert got.keys() == want.keys() and all(abs(got[h][0] - want[h]) < 1e-9 and got[h][1] <= got[h][0] for h in want)


def plain_targets(held, power, budget):
    """Shares of the budget; what a value does not hold goes to the others."""
    left, goals, total = dict(held), {}, budget * sum(held.values())
    while left:
        scale = sum(h**power for h in left.values())
        room = total - sum(goals.values())
        full = {v: h for v, h in left.items() if room * h**power / scale > h}
        if not full:
            return goals | {v: room * h**power / scale for v, h in left.items()}
        goals |= full
        left = {v: h for v, h in left.items() if v not in full}
    return goals


def test_mixing_spreads_what_a_value_lacks(spark):
    """Rare values hold less than their shares of the budget; margins still meet their targets with the default sweeps."""
    chosen = random.Random(8)
    size = {"a": 40_000, "b": 3000, "c": 200, None: 50}
    cells = [(s, lang, t, max(1, int(n * k * chosen.uniform(0.5, 1.5)))) for s, n in size.items() for lang, k in (("en", 1), ("fr", 0.1)) for t in "xyz"]
    frame = spark.createDataFrame(cells, "source string, lang string, topic string, tokens long")
    raked = mixing.rake(frame)
    total = sum(c[3] for c in cells)
    found = {(r["axis"], r["value"]): (r["goal"], r["weight"]) for r in mixing.reached(raked).collect()}
    exhausted = 0
    for at, (axis, power) in enumerate(mixing.TEMPERATURES.items()):
        held = collections.Counter()
        for cell in cells:
            held[cell[at]] += cell[3]
        for value, goal in plain_targets(held, power, mixing.BUDGET).items():
            exhausted += goal == held[value]
            got = found[axis, value]
            assert abs(got[0] - goal / (mixing.BUDGET * total)) < 1e-9
            assert abs(got[1] - got[0]) < 0.01
    assert exhausted >= 2


def test_sampling_is_calibrated_without_ids_and_for_copies(spark, tmp_path):
    rows = [(None if i % 3 == 0 else i, f"text {i} " + "word " * (i % 7), f"s{i % 2}", "en") for i in range(6000)]
    rows += [(7, "the same text", "s0", "en")] * 3000
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string").repartition(6)
    docs.withColumns({"topic": F.lit("prose"), "n_tokens": mixing.token_count(F.col("text"))}).write.parquet(str(tmp_path / "docs"))
    mixed = mixing.mix(spark.read.parquet(str(tmp_path / "docs")))
    for group in ("doc_id is null", "doc_id = 7", "true"):
        sums = mixed.filter(group).agg(F.sum(F.col("n_tokens") * F.col("sampled").cast("int")), F.sum(F.col("n_tokens") * F.col("probability"))).first()
        assert abs(sums[0] / sums[1] - 1) < (0.02 if group == "true" else 0.08)
    again = mixing.mix(spark.read.parquet(str(tmp_path / "docs")))
    assert again.filter("sampled").count() == mixed.filter("sampled").count()


def test_mixing_of_odd_rows(odd, empty):
    counted = odd.withColumns({"topic": mixing.topic_of(F.col("text")), "n_tokens": mixing.token_count(F.col("text"))})
    rows = mixing.mix(counted).collect()
    assert len(rows) == odd.count() and all(0 <= r["probability"] <= 1 for r in rows)
    assert mixing.mix(counted.limit(0)).count() == 0 and mixing.mix(counted.filter("n_tokens = 0")).filter("sampled").count() == 0


def plain_cost(roles):
    """Least cost by trying every role for every turn."""
    best = None
    for after in itertools.product(range(3), repeat=len(roles)):
        costs = {(chat.START, 0)}
        for role, b in zip(roles, after, strict=True):
            step = set()
            for a, cost in costs:
                changed = cost + chat.RELABEL * (role != b)
                if a == b:
                    step.add((b, changed + chat.MERGE))
                if (a, b) in chat.WAYS:
                    step.add((b, changed + chat.INSERT * len(chat.WAYS[a, b])))
            costs = step
        for s, cost in costs:
            total = cost + chat.INSERT * len(chat.ENDINGS[s])
            best = total if best is None else min(best, total)
    return best


def legal(shown):
    roles = [part.split("\n", 1)[0] for part in shown.split("<|im_start|>")[1:]]
    turns = roles[1:] if roles[:1] == ["system"] else roles
    return bool(turns) and len(turns) % 2 == 0 and all(r == ("user", "assistant")[i % 2] for i, r in enumerate(turns))


@pytest.mark.parametrize("segment", [2048, 2])
def test_chats_are_legal_at_least_cost(spark, monkeypatch, segment):
    monkeypatch.setattr(chat, "SEGMENT", segment)
    chosen = random.Random(8)
    names = ["system", "user", "assistant", "tool", None]
    talks = {i: [chosen.randrange(5) for _ in range(chosen.randrange(1, 7))] for i in range(150)}
    rows = [(i, n, names[r], f"t{n}") for i, talk in talks.items() for n, r in enumerate(talk)]
    rows += [(None, None, None, None), (None, 0, "user", "x"), (None, 0, "user", "x")]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(5)
    got = collections.defaultdict(list)
    for r in chat.format_chats(frame.withColumn("part", F.lit("clash"))).collect():
        got[r["conv_id"]].append(r)
    assert sum(map(len, got.values())) == len(rows)
    for i, talk in talks.items():
        turns = sorted(got[i], key=lambda r: r["place"])
        assert [r["turn"] for r in turns] == list(range(len(talk)))
        assert sum(r["cost"] for r in turns) == plain_cost([r if r < 3 else -1 for r in talk])
        shown = "".join(r["rendered"] for r in turns)
        assert legal(shown) and all(f"t{n}" in shown for n in range(len(talk)))
    assert legal("".join(r["rendered"] for r in sorted(got[None], key=lambda r: r["place"])))
    assert chat.format_chats(frame.limit(0)).count() == 0


def test_personal_data_of_odd_rows(odd, empty):
    rows = pii.find(odd).select("text", "n_email", "spans").collect()
    assert all(r["spans"] == "" for r in rows if not r["text"]) and sum(r["n_email"] for r in rows) == 1
    assert pii.redact(odd).filter("text is null").count() == 2 and pii.redact(empty).count() == 0


def test_language_of_mostly_copies_is_learned(spark, monkeypatch):
    """Few different texts among many copies of one that the hash would not draw."""
    monkeypatch.setattr(language, "PER_LANGUAGE", 5)
    texts = [sentence(n, 12) for n in range(40)]
    hashed = spark.createDataFrame([(t,) for t in texts], "text string").select("text", F.pmod(F.xxhash64("text"), F.lit(1 << 20)).alias("at"))
    by_hash = [r["text"] for r in hashed.orderBy("at").collect()]
    rows = [(t, "xx") for t in by_hash[20:]] + [(by_hash[-1], "xx")] * 20_000 + [("bonjour le monde " + str(n), "fr") for n in range(4)]
    model = language.fit(spark.createDataFrame(rows, "text string, lang string"))
    assert set(model.languages) == {"xx", "fr"}
    assert model.predict(by_hash[20].encode())[0] == "xx"


@pytest.mark.parametrize("text,want", [
    ("IBAN DE89 3704 0044 0532 0130 00 BIC COBADEFFXXX", "IBAN <IBAN> BIC COBADEFFXXX"),
    ("Iban: NO93 8601 1117 947 OK", "Iban: <IBAN> OK"),
    ("IBAN DE89 3704 0044 0532 0130 01 BIC COBADEFFXXX", "IBAN DE89 3704 0044 0532 0130 01 BIC COBADEFFXXX"),
    ("Social Security 078-05-1120", "Social Security <NATIONAL_ID>"),
    ("National Id: X1234567", "National Id: <NATIONAL_ID>"),
    ("SSN Number: 078-05-1120", "SSN Number: <NATIONAL_ID>"),
    ("Account Number: 12345678", "Account Number: <ACCOUNT>"),
    ("ACCOUNT NO 12345678", "ACCOUNT NO <ACCOUNT>"),
    ("\u0130 Api_Key: k3yk3yk3yk3y", "\u0130 Api_Key: <SECRET>"),
])
def test_personal_data_after_cues_of_any_case(text, want):
    assert pii.redacted(text, pii.spans(text)) == want


def test_decontamination_sends_names_of_rows_and_cuts_texts_once(spark, monkeypatch):
    """No shingles of a row travel with each other, long rows are read a few at a time; what is found stays what it was."""
    plans, store = {}, decontaminate.materialize

    def noted(df, name="stage", *more):
        plans[name] = df._jdf.queryExecution().optimizedPlan().toString()
        return store(df, name, *more)

    monkeypatch.setattr(decontaminate, "materialize", noted)
    spark.conf.set("spark.sql.parquet.columnarReaderBatchSize", "4096")
    passage = " ".join(f"w{i}" for i in range(20))
    rows = [(1, f"before it {passage} after it"), (1, "nothing of it"), (None, passage), (None, passage), (2, None), (3, passage.upper()), (3, passage.upper())]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    items = spark.createDataFrame([(7, passage), (8, "a b c d")], "item_id long, text string")
    found = decontaminate.contaminated(docs, items).select("doc_id", "item_id", "similarity", "first_word").collect()
    assert sorted(map(tuple, found), key=str) == sorted([(1, 7, 1.0, 2), (None, 7, 1.0, 0), (3, 7, 1.0, 0)], key=str)
    left = decontaminate.without_contaminated_rows(docs, items)
    assert sorted(map(tuple, left.collect()), key=str) == [(1, "nothing of it"), (2, None)]
    assert plans["named"].count("split(") == 1 and "first(shingles" not in plans["named"]
    assert int(spark.conf.get("spark.sql.parquet.columnarReaderBatchSize")) <= 256
    assert spark.conf.get("parquet.hadoop.vectored.io.enabled") == "false"
    # Few of them are sent to every task, whatever the session's own bound, so that the documents are not shuffled.
    bound = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert "BroadcastHashJoin" in decontaminate.without_contaminated_rows(docs, items)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", bound)
