"""Training examples: vocabulary ids, label masks, batches and the train/eval split."""

from dataclasses import dataclass
from math import ceil
from typing import Any

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

from uttera import settings as S
from uttera.functions import arrays as A
from uttera.functions import text as T
from uttera.operators import filters
from uttera.operators.lookup import is_small
from uttera.operators.ranking import index_bucket, ranked
from uttera.session import ROW, bound_scans, materialize, with_row_id


@dataclass(frozen=True)
class Markers:
    """Ids of the pieces: markers, then speech tokens (token N has id ``speech_base + N``), then words without end."""

    turn_start: int = 0
    turn_end: int = 1
    newline: int = 2
    user: int = 3
    assistant: int = 4
    unknown: int = 5
    speech_base: int = 16
    speech_tokens: int = S.TOKEN_RANGE
    first_word: int = 16 + S.TOKEN_RANGE

    def __post_init__(self) -> None:
        last = max(self.turn_start, self.turn_end, self.newline, self.user, self.assistant, self.unknown)
        if not last < self.speech_base <= self.first_word - self.speech_tokens:
            raise ValueError("the id ranges of markers, speech tokens and words overlap")


def vocabulary(df: DataFrame, text: str = "text", markers: Markers = Markers(), known: DataFrame | None = None) -> DataFrame:
    """(word, word_id) of the distinct words, numbered in the order of their MD5 so that no task sorts them all.

    ``known`` is an earlier vocabulary: its words keep their ids, and only words it lacks are numbered, after its last id.
    What was encoded with it stays valid, and each corpus that is added appends.
    """
    found = df.select(F.explode(T.words(F.col(text))).alias("word")).where(F.col("word") != "").distinct()
    first = markers.first_word
    if known is not None:
        found = found.join(known, "word", "left_anti")
        last = known.agg(F.max("word_id")).first()[0]
        first = first if last is None else last + 1
    hashed = materialize(found.withColumn("_md5", F.md5("word")), "words")
    numbered = ranked(hashed, [], F.struct("_md5", "word"), F.substring("_md5", 1, 3), out="_rank")
    new = numbered.select("word", (F.col("_rank") + first).cast("bigint").alias("word_id"))
    return new if known is None else known.select("word", "word_id").unionByName(new)


def _look_up(pieces: DataFrame, vocab: DataFrame) -> DataFrame:
    """Join a large vocabulary: the most frequent words by a broadcast of bounded size, the others by a shuffle."""
    short = pieces.where(F.octet_length("word") <= S.FREQUENT_WORD_BYTES)
    most = short.groupBy("word").count().orderBy(F.desc("count"), "word").limit(S.FREQUENT_WORDS)
    frequent = most.join(vocab, "word", "left").select("word", "word_id", F.lit(True).alias("_frequent"))
    first = pieces.join(F.broadcast(frequent), "word", "left")
    rest = first.where(F.col("_frequent").isNull()).drop("word_id", "_frequent").join(vocab, "word", "left")
    return first.where("_frequent").drop("_frequent").unionByName(rest)


def encode_words(
    df: DataFrame,
    vocab: DataFrame,
    text: str = "text",
    unknown: int = Markers().unknown,
    max_broadcast_bytes: int = S.BROADCAST_BYTES,
) -> DataFrame:
    """Add ``word_ids``: the text's words as vocabulary ids, in order; null for a null text. Each row is encoded by itself.

    With a vocabulary checked to be small, the rows are shuffled once while they are still text; the words then meet
    the broadcast vocabulary and are gathered where they are.
    """
    rows = with_row_id(df)
    small = is_small(vocab, max_broadcast_bytes)
    source = rows.repartition(ROW) if small else rows
    # The rest of a row travels with its first word, so that it need not be joined back.
    others = [c for c in rows.columns if c != ROW]
    pieces = source.select(ROW, F.struct(*others).alias("_rest"), F.posexplode_outer(T.words(F.col(text))).alias("_pos", "word"))
    pieces = pieces.withColumn("_rest", F.when(F.coalesce("_pos", F.lit(0)) == 0, F.col("_rest")))
    found = pieces.join(F.broadcast(vocab), "word", "left") if small else _look_up(pieces, vocab)
    piece = F.when(F.col("_pos").isNotNull(), F.struct("_pos", F.coalesce("word_id", F.lit(unknown)).alias("id")))
    gathered = found.groupBy(ROW).agg(F.sort_array(F.collect_list(piece)).alias("_pieces"), F.first("_rest", ignorenulls=True).alias("_rest"))
    ids = F.when(F.size("_pieces") > 0, F.col("_pieces.id")).alias("word_ids")
    kept = [ROW] if ROW in df.columns else []
    return gathered.select(*[F.col("_rest")[c].alias(c) for c in others], ids, *kept)


def prompt_ids(word_ids: Column, markers: Markers = Markers()) -> Column:
    """The user turn and the opened assistant turn."""
    m = markers
    opened = F.array(*[F.lit(i) for i in (m.turn_start, m.user, m.newline)])
    closed = F.array(*[F.lit(i) for i in (m.turn_end, m.newline, m.turn_start, m.assistant, m.newline)])
    return F.concat(opened, word_ids, closed)


def full_ids(word_ids: Column, tokens: Column, markers: Markers = Markers()) -> Column:
    """The prompt, the speech tokens and the end of the assistant turn."""
    m = markers
    outside = F.raise_error(F.lit("a speech token lies outside the range of ids kept for them")).cast("bigint")
    speech = F.transform(
        tokens, lambda t: F.when((t >= 0) & (t < m.speech_tokens), t.cast("bigint") + m.speech_base).otherwise(outside)
    )
    return F.concat(prompt_ids(word_ids, m), speech, F.array(F.lit(m.turn_end), F.lit(m.newline)))


# Pieces besides words and speech tokens in an example: three, five and two markers.
FRAME_PIECES = 10


def mask_examples(
    df: DataFrame,
    prompt: str = "prompt_ids",
    full: str = "input_ids",
    max_seq_len: int = S.MAX_SEQ_LEN,
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """(input_ids, attention_mask, labels) from a prompt and the full ids of whatever tokenizer made them."""
    measured = df.select(*keep, F.col(full).alias("input_ids"), A.prompt_len(F.col(prompt), F.col(full)).alias("prompt_len"))
    fitting = filters.fits_context(measured, max_seq_len=max_seq_len)
    ids = F.col("input_ids")
    return fitting.select(
        *keep,
        "input_ids",
        A.attention_mask(ids).alias("attention_mask"),
        A.label_mask(ids, F.col("prompt_len")).alias("labels"),
    )


def fitting_rows(
    df: DataFrame, key: str = "id", text: str = "text", tokens: str = "speech_tokens", max_seq_len: int = S.MAX_SEQ_LEN
) -> DataFrame:
    """Rows with text and tokens whose example fits, and ``pieces``, its length, which is known before it is encoded."""
    kept = [ROW] if ROW in df.columns else []
    present = filters.examples_present(df.select(key, text, tokens, *kept), text, tokens)
    pieces = F.size(T.words(F.col(text))) + F.size(tokens) + FRAME_PIECES
    return present.withColumn("pieces", pieces).where(F.col("pieces") <= max_seq_len)


def encode_examples(
    df: DataFrame,
    vocab: DataFrame,
    key: str = "id",
    text: str = "text",
    tokens: str = "speech_tokens",
    max_seq_len: int = S.MAX_SEQ_LEN,
    markers: Markers = Markers(),
    max_broadcast_bytes: int = S.BROADCAST_BYTES,
) -> DataFrame:
    """Rows with text and tokens to training examples, each with its ``key``, which may repeat; what does not fit is dropped.

    An example's length is known before its words are looked up, so over-long rows leave before the shuffle and
    no more than ``max_seq_len`` words of a row are ever gathered.
    """
    fitting = fitting_rows(df, key, text, tokens, max_seq_len).drop("pieces")
    worded = encode_words(fitting, vocab, text, markers.unknown, max_broadcast_bytes)
    kept = [c for c in (key, ROW) if c in worded.columns]
    both = worded.select(
        *kept,
        prompt_ids(F.col("word_ids"), markers).alias("prompt_ids"),
        full_ids(F.col("word_ids"), F.col(tokens), markers).alias("input_ids"),
    )
    return mask_examples(both, max_seq_len=max_seq_len, keep=tuple(kept))


def pad_batches(
    examples: DataFrame,
    batch_rows: int = S.BATCH_ROWS,
    pad_id: int = 0,
    order: str = "id",
    bucket: Column | None = None,
    lengths: DataFrame | None = None,
) -> DataFrame:
    """Consecutive rows in the order of ``order``, padded to the longest of their batch; equal values keep stored order.

    An integer column is taken as an index. Any other is ordered by its MD5, which spreads it over buckets of its own.
    Batches and their lengths are worked out on (order, length) alone; the arrays are shuffled once, to meet them.
    ``bucket`` as in ``ranked``. ``lengths`` is a stored table (ROW, order, pieces) of the same rows, for examples that carry
    their row's number: then the examples themselves are read, or made, once.
    """
    bound_scans(examples.sparkSession)
    rows = with_row_id(examples)
    sizes = rows.select(ROW, order, F.size("input_ids").alias("_size")) if lengths is None else lengths.select(ROW, order, F.col("pieces").alias("_size"))
    place = [F.col(order), F.col(ROW)]
    if bucket is None and isinstance(examples.schema[order].dataType, IntegralType):
        bucket = index_bucket(order)
    elif bucket is None:
        hashed = F.md5(F.coalesce(F.col(order).cast("string"), F.lit("")))
        place, bucket = [hashed, *place], F.substring(hashed, 1, 4)
    numbered = ranked(sizes, [], F.struct(*place), bucket, out="_rank")
    batched = numbered.withColumn("batch_id", F.floor(F.col("_rank") / batch_rows)).withColumn(
        "_longest", F.max("_size").over(Window.partitionBy("batch_id"))
    )
    # The arrays stream past a hash of their partition's numbers, three to a row: they are shuffled, but never sorted.
    joined = rows.join(batched.select(ROW, "batch_id", "_longest").hint("shuffle_hash"), ROW)

    def padded(column: str, fill: int) -> Column:
        return A.pad_right(F.col(column), F.col("_longest"), fill).alias(column)

    return joined.select(
        "batch_id",
        order,
        padded("input_ids", pad_id),
        padded("attention_mask", 0),
        padded("labels", S.IGNORED_LABEL),
    )


def split_key(key: str | Column, seed: int = S.SEED) -> Column:
    """What the split orders rows by: the MD5 of the seed and the row's key."""
    column = F.col(key) if isinstance(key, str) else key
    return F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(column.cast("string"), F.lit(""))))


def _cut(rows: DataFrame, by: Column, take: int) -> tuple[Any, int]:
    """The value of ``by`` in which the row ``take`` lies, counted from 1, and how many rows of that value are taken.

    Only counts are put in order in one task, one for each value of ``by``.
    """
    counts = rows.groupBy(by.alias("_value")).agg(F.count(F.lit(1)).alias("_count"))
    upto = counts.withColumn("_upto", F.sum("_count").over(Window.orderBy("_value")))
    hit = upto.where(F.col("_upto") >= take).orderBy("_value").first()
    return hit["_value"], take - hit["_upto"] + hit["_count"]


def train_eval_split(df: DataFrame, ratio: float = S.EVAL_RATIO, seed: int = S.SEED, key: str = "id") -> DataFrame:
    """Add ``split``: exactly ``ceil(ratio * n)`` rows are ``test``, those first in MD5 order, then in stored order.

    Keys may repeat. Counts find the MD5 prefix the cut falls into, then the MD5, then the stretch of stored rows with
    that MD5; only the rows of that stretch are sorted. The table is stored once, scanned a few times, never shuffled.
    """
    rows = with_row_id(df)
    keys = rows.select(split_key(key, seed).alias("_md5"), ROW)
    wanted = ceil(round(ratio * keys.count(), 9))
    in_test = F.lit(False)
    if wanted:
        prefix, take = _cut(keys, F.substring("_md5", 1, 4), wanted)
        keys = keys.where(F.substring("_md5", 1, 4) == prefix)
        md5, take = _cut(keys, F.col("_md5"), take)
        keys = keys.where(F.col("_md5") == md5)
        stretch, take = _cut(keys, F.shiftright(ROW, 33), take)
        inside = keys.where(F.shiftright(ROW, 33) == stretch).orderBy(ROW).limit(take)
        last = inside.agg(F.max(ROW)).first()[0]
        mine = split_key(key, seed)
        in_test = (mine < md5) | ((mine == md5) & (F.col(ROW) <= last))
    split = rows.withColumn("split", F.when(in_test, F.lit("test")).otherwise(F.lit("train")))
    return split if ROW in df.columns else split.drop(ROW)


def hash_split(df: DataFrame, ratio: float = S.EVAL_RATIO, seed: int = S.SEED, key: str = "id") -> DataFrame:
    """As ``train_eval_split`` in one pass: each row is ``test`` with chance ``ratio``, so the size is approximate."""
    threshold = f"{min(ceil(ratio * 16**12), 16**12 - 1):012x}"
    in_test = F.substring(split_key(key, seed), 1, 12) < threshold
    return df.withColumn("split", F.when(in_test, F.lit("test")).otherwise(F.lit("train")))


def split_sizes(df: DataFrame) -> DataFrame:
    return df.groupBy("split").agg(F.count(F.lit(1)).alias("rows"))
