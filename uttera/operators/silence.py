"""Silent gaps of utterances, from sample arrays or from frame tables, and the pause tags they give."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from uttera import settings as S
from uttera.functions import signal
from uttera.functions import text as T
from uttera.operators.lookup import lookup_join
from uttera.session import bound_batches, materialize


def frame_energy(
    df: DataFrame,
    utterance: str,
    samples: Column,
    frame_length: int = S.FRAME_LENGTH,
    hop: int = S.HOP_LENGTH,
) -> DataFrame:
    """One row per frame: (utterance, frame, energy, peak, start, end), the edges in samples."""
    bound_batches(df.sparkSession)
    powers = df.select(utterance, signal.frame_power(samples, frame_length, hop).alias("_powers"))
    # The peak is taken before the explode: beside it, it would be worked out anew for every frame.
    peaked = powers.withColumn("peak", F.array_max("_powers"))
    frames = peaked.select(utterance, "peak", F.posexplode("_powers").alias("frame", "energy"))
    return frames.withColumn("start", F.col("frame") * hop).withColumn("end", (F.col("frame") + 1) * hop)


def piece_frames(
    df: DataFrame,
    utterance: str,
    start: Column,
    samples: Column,
    frame_length: int = S.FRAME_LENGTH,
    hop: int = S.HOP_LENGTH,
    frames_per_bucket: int = S.BUCKET_ROWS,
) -> DataFrame:
    """``frame_energy`` of recordings that lie in several rows, each with the number of its first sample, ``start``.

    A frame at a piece's edge needs its neighbour's samples. Squares are summed per hop where the samples are; what is
    exchanged are hops. Each piece sends its hops to the buckets of frames that they reach, beyond the bucket's edge by half a
    frame, and a bucket adds up what it gets; so neither a recording nor its longest piece must fit into one task.
    Pieces may come in any order and size and must not overlap; samples between them that no row holds are zero. Rows
    without samples hold none.
    """
    joined = _bucket_hops(df, utterance, start, samples, frame_length, hop, frames_per_bucket)
    powers = joined.select("_key", "_first", signal.joined_frames(F.col("_parts"), F.col("_first"), F.col("_here"), frame_length, hop).alias("_powers"))
    powers = materialize(powers, "powers")
    peaks = materialize(powers.groupBy("_key").agg(F.max(F.array_max("_powers")).alias("peak")), "peaks")
    peaked = lookup_join(powers, peaks, "_key").select(F.col("_key.utterance").alias(utterance), "peak", "_first", F.posexplode("_powers").alias("_place", "energy"))
    numbered = peaked.select(utterance, "peak", (F.col("_first") + F.col("_place")).cast("int").alias("frame"), "energy")
    return numbered.withColumn("start", F.col("frame") * hop).withColumn("end", (F.col("frame") + 1) * hop)


def piece_gaps(
    df: DataFrame,
    utterance: str,
    start: Column,
    samples: Column,
    sampling_rate: int,
    frame_length: int = S.FRAME_LENGTH,
    hop: int = S.HOP_LENGTH,
    top_db: float = S.TOP_DB,
    min_silence_ms: int = S.MIN_SILENCE_MS,
    frames_per_bucket: int = S.BUCKET_ROWS,
) -> DataFrame:
    """``frame_gaps`` of ``piece_frames``, (utterance, gaps), without a row per frame.

    What is exchanged are hops. A recording of one bucket is counted where its hops meet; only longer ones store their
    frames' powers, for the peak that their buckets have in common, and then their buckets' outer loud edges meet.
    """
    shortest = int(sampling_rate * min_silence_ms / 1000)
    joined = _bucket_hops(df, utterance, start, samples, frame_length, hop, frames_per_bucket)
    alone = F.col("_frames") <= frames_per_bucket
    found = signal.counted_or_powers(F.col("_parts"), F.col("_first"), F.col("_here"), alone, frame_length, hop, top_db, shortest)
    stored = materialize(joined.select("_key", "_first", "_here", found.alias("_found")).select("_key", "_first", "_here", "_found.*"), "gaps")
    short = stored.where(F.col("powers").isNull()).select(F.col("_key.utterance").alias(utterance), "gaps")

    long = stored.where(F.col("powers").isNotNull())
    peaks = materialize(long.groupBy("_key").agg(F.max(F.array_max("powers")).alias("_peak")), "peaks")
    edges = signal.loud_edges(F.col("powers"), F.col("_peak"), hop, top_db, shortest).alias("_edges")
    marked = lookup_join(long, peaks, "_key").select("_key", "_first", "_here", edges)
    pieces = marked.select(
        F.struct(F.col("_key.utterance").alias("utterance"), F.col("_first").alias("bucket")).alias("_piece"),
        F.col("_edges.inner").alias("_inner"),
        ((F.col("_first") + F.col("_edges.first")) * hop).alias("_first_start"),
        ((F.col("_first") + F.col("_edges.last") + 1) * hop).alias("_piece_end"),
        (F.col("_edges.first") > 0).alias("_leads_silent"),
        (F.col("_edges.last") < F.col("_here") - 1).alias("_trails_silent"),
    )
    return short.unionByName(_across_pieces(pieces, utterance, F.lit(shortest)))


def _bucket_hops(
    df: DataFrame, utterance: str, start: Column, samples: Column, frame_length: int, hop: int, frames_per_bucket: int
) -> DataFrame:
    """Per bucket of a recording's frames the hops that reach it: (_key, _first, _here, _frames, _parts).

    ``_first`` is the bucket's first frame, ``_here`` how many it has, ``_frames`` how many its recording has.
    """
    signal.check_frames(frame_length, hop)
    bound_batches(df.sparkSession)
    reach = frame_length // (2 * hop)
    pieces = df.select(F.struct(F.col(utterance).alias("utterance")).alias("_key"), start.cast("bigint").alias("_at"), samples.alias("_samples"))
    pieces = pieces.where(F.size("_samples") > 0)
    first = F.floor(F.col("_at") / hop)
    cut = pieces.select("_key", first.alias("begin"), (F.col("_at") + F.size("_samples")).alias("_end"), signal.piece_energies(F.col("_samples"), F.col("_at"), hop).alias("energies"))
    # Hops in place of samples are stored: far smaller, and read twice.
    cut = materialize(cut, "hops")
    low, high = F.col("begin") - reach, F.col("begin") + F.size("energies") - 1 + reach
    buckets = F.sequence(F.greatest(F.floor(low / frames_per_bucket), F.lit(0)), F.floor(high / frames_per_bucket))
    sent = cut.select("_key", "begin", "energies", F.explode(buckets).alias("_bucket"))
    # A long piece gives each bucket only the hops that reach it.
    skip = F.greatest(F.col("_bucket") * frames_per_bucket - reach - F.col("begin"), F.lit(0)).cast("int")
    part = F.slice("energies", skip + 1, F.lit(frames_per_bucket + 2 * reach))
    sent = sent.select("_key", "_bucket", F.struct((F.col("begin") + skip).alias("begin"), part.alias("energies")).alias("_part"))
    parts = sent.groupBy("_key", "_bucket").agg(F.sort_array(F.collect_list("_part")).alias("_parts"))

    frames = cut.groupBy("_key").agg((F.floor(F.max("_end") / hop) + 1).alias("_frames"))
    every = frames.select("_key", "_frames", F.explode(F.sequence(F.lit(0).cast("bigint"), F.floor((F.col("_frames") - 1) / frames_per_bucket))).alias("_bucket"))
    begun = F.col("_bucket") * frames_per_bucket
    here = F.least(F.col("_frames") - begun, F.lit(frames_per_bucket))
    return every.join(parts, ["_key", "_bucket"], "left").select("_key", begun.alias("_first"), here.alias("_here"), "_frames", "_parts")


def signal_gaps(
    df: DataFrame,
    samples: Column,
    sampling_rate: Column,
    frame_length: int = S.FRAME_LENGTH,
    hop: int = S.HOP_LENGTH,
    top_db: float = S.TOP_DB,
    min_silence_ms: int = S.MIN_SILENCE_MS,
) -> DataFrame:
    """Add ``gaps``, counted inside each row: neither frames nor samples are exploded or shuffled."""
    bound_batches(df.sparkSession)
    counted = signal.count_gaps(samples, sampling_rate, frame_length, hop, top_db, min_silence_ms)
    return df.withColumn("gaps", counted)


def silence_gaps(
    frames: DataFrame,
    utterance: str,
    order: str,
    energy: str,
    start: Column,
    end: Column,
    min_gap: float | Column,
    bucket: Column,
    top_db: float = S.TOP_DB,
    peak: str | None = None,
) -> DataFrame:
    """Per utterance, the gaps of at least ``min_gap`` between neighbouring loud stretches of its frames.

    ``bucket`` must never decrease along ``order``: it cuts an utterance into pieces, so a recording of any length
    is spread over tasks. Each piece counts its inner gaps and keeps its outer loud edges; the few rows per
    utterance that result are joined up in order. Frames are shuffled once, on (utterance, bucket). ``peak`` names a
    column that holds the utterance's largest energy already; without it one more pass finds it.
    """
    keyed = frames.select(
        # A struct key keeps frames whose utterance is null: a join on it would drop them.
        F.struct(F.col(utterance).alias("utterance"), bucket.alias("bucket")).alias("_piece"),
        F.col(order).alias("_order"),
        F.col(energy).alias("_energy"),
        start.alias("_start"),
        end.alias("_end"),
        *([F.col(peak).alias("_loudest")] if peak else []),
    )
    if not peak:
        peaks = keyed.groupBy("_piece").agg(F.max("_energy").alias("_peak"))
        whole = Window.partitionBy("_piece.utterance")
        keyed = keyed.join(peaks.select("_piece", F.max("_peak").over(whole).alias("_loudest")), "_piece")

    heard = keyed.select(
        "_piece", "_order", "_start", "_end", signal.is_loud(F.col("_energy"), F.col("_loudest"), top_db).alias("_loud")
    )
    loud = F.col("_loud")
    ordered = Window.partitionBy("_piece").orderBy("_order")
    before = ordered.rowsBetween(Window.unboundedPreceding, -1)
    marked = heard.withColumns({
        "_after_silence": ~F.lag(loud).over(ordered),
        "_last_end": F.last(F.when(loud, F.col("_end")), ignorenulls=True).over(before),
    })
    pieces = marked.groupBy("_piece").agg(
        F.count_if(loud & F.col("_after_silence") & (F.col("_start") - F.col("_last_end") >= min_gap)).alias("_inner"),
        F.min(F.when(loud, F.col("_start"))).alias("_first_start"),
        F.max(F.when(loud, F.col("_end"))).alias("_piece_end"),
        (F.min(F.when(loud, F.col("_order"))) > F.min("_order")).alias("_leads_silent"),
        (F.max(F.when(loud, F.col("_order"))) < F.max("_order")).alias("_trails_silent"),
    )
    return _across_pieces(pieces, utterance, min_gap)


def _across_pieces(pieces: DataFrame, utterance: str, min_gap: float | Column) -> DataFrame:
    """The gaps inside an utterance's pieces and those between their outer loud edges, joined up in order."""
    along = Window.partitionBy("_piece.utterance").orderBy("_piece.bucket")
    earlier = along.rowsBetween(Window.unboundedPreceding, -1)
    # A neighbouring piece without a loud frame, whose edges are null, is silent throughout.
    joined = pieces.withColumns({
        "_last_end": F.last("_piece_end", ignorenulls=True).over(earlier),
        "_between": F.col("_leads_silent") | F.coalesce(F.lag("_trails_silent").over(along), F.lit(True)),
    })
    across = F.col("_between") & (F.col("_first_start") - F.col("_last_end") >= min_gap)
    return joined.groupBy(F.col("_piece.utterance").alias(utterance)).agg(
        (F.sum("_inner") + F.count_if(across)).cast("int").alias("gaps")
    )


def frame_gaps(
    frames: DataFrame,
    utterance: str,
    sampling_rate: int,
    top_db: float = S.TOP_DB,
    min_silence_ms: int = S.MIN_SILENCE_MS,
    frames_per_bucket: int = S.BUCKET_ROWS,
) -> DataFrame:
    """``silence_gaps`` of a ``frame_energy`` table, without shuffling a row per frame.

    Whether a frame is loud is seen beside its peak. So frames are packed where they are into words of 64, a bit each for loud
    and silent ones, and the words are what is exchanged. Frames whose edges are not those of their neighbours' grid get words
    of their own.
    """
    bound_batches(frames.sparkSession)
    shortest = int(sampling_rate * min_silence_ms / 1000)
    width = (F.col("end") - F.col("start")).cast("bigint")
    seen = frames.select(
        F.col(utterance).alias("_utterance"),
        F.col("frame").cast("bigint").alias("_frame"),
        F.floor(F.col("frame") / frames_per_bucket).alias("_bucket"),
        width.alias("_width"),
        (F.col("start") - F.col("frame") * width).cast("bigint").alias("_origin"),
        signal.is_loud(F.col("energy"), F.col("peak"), top_db).alias("_loud"),
    )
    begun = F.col("_bucket") * frames_per_bucket
    at = begun + F.floor((F.col("_frame") - begun) / signal.WORD) * signal.WORD
    placed = seen.withColumn("_at", at)
    bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), (F.col("_frame") - F.col("_at")).cast("int"))
    none = F.lit(0).cast("bigint")
    words = placed.groupBy("_utterance", "_bucket", "_at", "_width", "_origin").agg(
        F.bit_or(F.when(F.col("_loud"), bit).otherwise(none)).alias("loud"),
        F.bit_or(F.when(F.col("_loud"), none).otherwise(bit)).alias("silent"),
    )
    word = F.struct(F.col("_at").alias("at"), F.col("_width").alias("width"), F.col("_origin").alias("origin"), "loud", "silent")
    packed = words.groupBy("_utterance", "_bucket").agg(F.collect_list(word).alias("_words"))
    edges = signal.word_edges(F.col("_words"), shortest).alias("_edges")
    pieces = packed.select(F.struct(F.col("_utterance").alias("utterance"), F.col("_bucket").alias("bucket")).alias("_piece"), edges)
    pieces = pieces.select(
        "_piece",
        F.col("_edges.inner").alias("_inner"),
        F.col("_edges.first_start").alias("_first_start"),
        F.col("_edges.last_end").alias("_piece_end"),
        F.col("_edges.leads").alias("_leads_silent"),
        F.col("_edges.trails").alias("_trails_silent"),
    )
    return _across_pieces(pieces, utterance, F.lit(shortest))


def add_pauses(
    df: DataFrame,
    gaps: DataFrame,
    key: str,
    text: str = "text",
    tag: str = S.PAUSE_TAG,
    enabled: bool = True,
    pause_tags: bool = True,
) -> DataFrame:
    """Tag each text with its utterance's gap count from ``gaps`` (key, gaps); an utterance without one gets none."""
    if not (enabled and pause_tags):
        return df
    counted = lookup_join(df, gaps.select(key, F.col("gaps").alias("_gaps")), key)
    return counted.withColumn(text, T.insert_pause_tags(F.col(text), F.col("_gaps"), tag)).drop("_gaps")
