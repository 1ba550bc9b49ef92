"""A corpus with a manifest of its files: an index that new files do not shift, and scans of only the files a range needs.

The manifest is a table (config, folder, file, rows, offset, batch). Files enter in batches, by name within a batch, and each
starts where the config ended before it; nothing that was written is ever changed, so a file that appears later, whatever its
name, gets numbers after all earlier ones. Rows of an entered file are counted from its footer; which files a range of the
index lies in is then known without opening any.

Files enter only as far as an index is asked for: ``FIRST_FILES`` of each folder, then four times as many, until the configs
reach it; where configs are no folders, all files. One run at a time extends a manifest; a file that was entered twice is an error. File names pass through the
driver, which holds them for any scan anyway; rows do not.
"""

from dataclasses import dataclass, field
from urllib.parse import unquote

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from uttera import settings as S
from uttera.operators.ranking import number_rows
from uttera.schemas import RAW_UTTERANCE
from uttera.session import materialize
from uttera.sources.corpus import reader
from uttera.sources.progress import is_absent

MANIFEST = T.StructType([
    T.StructField("config", T.StringType()),
    T.StructField("folder", T.StringType()),
    T.StructField("file", T.StringType()),
    T.StructField("rows", T.LongType()),
    T.StructField("offset", T.LongType()),
    T.StructField("batch", T.LongType()),
])
#: The last index of a config whose end is not known yet.
NO_END = (1 << 62) - 1


def _plain(name: Column) -> Column:
    """Local file names have one slash or three in front, depending on who gives them."""
    return F.regexp_replace(name, "^file:/+", "file:/")


def _folder(name: str) -> str:
    return name.rsplit("/", 1)[0]


@dataclass
class IndexedCorpus:
    """``files`` comes straight from the reader; ``path`` is the manifest's folder, which belongs to this corpus and split.

    ``configs``, if given, are the only ones that are read and entered.
    """

    files: DataFrame
    path: str
    configs: list[str] | None = None
    config_column: str = "config"
    first_files: int = S.FIRST_FILES
    _listed: list[str] = field(default_factory=list)

    def __post_init__(self) -> None:
        names = {name if not name.startswith("file:/") else "file:/" + name.removeprefix("file:").lstrip("/") for name in self.files.inputFiles()}
        mark = f"/{self.config_column}="
        # Only where configs are folders does a folder tell which configs its files belong to.
        self._by_folder = all(mark in _folder(name) for name in names)
        if self.configs and self._by_folder:
            wanted = set(self.configs)
            names = {name for name in names if unquote(unquote(name.split(mark, 1)[1].split("/", 1)[0])) in wanted}
        self._listed = sorted(names)

    @property
    def spark(self) -> SparkSession:
        return self.files.sparkSession

    def manifest(self) -> DataFrame:
        """What is entered so far."""
        try:
            return self.spark.read.schema(MANIFEST).parquet(self.path)
        except AnalysisException as failure:
            if not is_absent(failure):
                raise
            return self.spark.createDataFrame([], MANIFEST)

    def _pending(self) -> DataFrame:
        """(folder, file) of the files not entered, stored."""
        listed = self.spark.createDataFrame([(_folder(name), name) for name in self._listed], "folder string, file string")
        return materialize(listed.join(self.manifest(), "file", "left_anti"), "pending")

    def _scan(self, names: list[str]) -> DataFrame:
        """The rows of these files; a filter on names reaches the listing, so no other file is opened."""
        if len(names) == len(self._listed):
            return self.files
        return self.files.where(F.col("_metadata.file_path").isin(names))

    def _enter(self, chosen: DataFrame, batch: int) -> None:
        names = [r["file"] for r in chosen.select("file").collect()]
        # Numbers in the file, not counts: a filter on a column may leave gaps.
        end = (F.max("_metadata.row_index") + 1).alias("rows")
        held = self._scan(names).groupBy(F.col(self.config_column).cast("string").alias("config"), _plain(F.col("_metadata.file_path")).alias("file"))
        counts = materialize(chosen.join(held.agg(end), "file", "left"), "counts")
        if counts.groupBy("file").count().where("count > 1").limit(1).count():
            raise ValueError("a file holds rows of several configs")
        known = self.manifest().groupBy("config").agg(F.sum("rows").alias("_before"))
        counts = counts.join(known.withColumnRenamed("config", "_known"), F.col("config").eqNullSafe(F.col("_known")), "left")
        earlier = Window.partitionBy("config").orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
        offset = F.coalesce("_before", F.lit(0)) + F.coalesce(F.sum("rows").over(earlier), F.lit(0))
        new = counts.withColumns({"offset": offset, "batch": F.lit(batch).cast("long"), "rows": F.coalesce("rows", F.lit(0))})
        # Stored first: the table that is appended to is also read. One task writes, so a batch appears whole.
        new = materialize(new.select(MANIFEST.names), "entered")
        new.coalesce(1).write.mode("append").parquet(self.path)
        if self.manifest().groupBy("file").count().where("count > 1").limit(1).count():
            raise RuntimeError(f"{self.path} was extended by two runs at once")

    def extend(self, upto: int | None = None) -> None:
        """Enter files until every folder reaches the index ``upto``, or all of them."""
        pending, width = self._pending(), self.first_files
        while not pending.isEmpty():
            chosen = pending
            if upto is not None and self._by_folder:
                reached = self.manifest().groupBy("folder").agg(F.max(F.col("offset") + F.col("rows")).alias("end"))
                short = pending.join(reached.where(F.col("end") >= upto), "folder", "left_anti")
                place = F.row_number().over(Window.partitionBy("folder").orderBy("file"))
                chosen = short.withColumn("_place", place).where(F.col("_place") <= width).drop("_place")
            chosen = materialize(chosen, "chosen")
            if chosen.isEmpty():
                return
            last = self.manifest().agg(F.max("batch")).first()[0]
            self._enter(chosen, 0 if last is None else last + 1)
            pending = materialize(pending.join(chosen, "file", "left_anti"), "pending")
            width *= 4

    def _wanted(self, rows: DataFrame) -> DataFrame:
        return rows.where(F.col(self.config_column).isin(*self.configs)) if self.configs else rows

    def rows(self, first: int = 0, end: int | None = None) -> DataFrame:
        """The rows from index ``first`` to before ``end`` of every config, with ``source_index``; other files stay closed."""
        self.extend(end)
        entered = self.manifest().where((F.col("rows") > 0) & (F.col("offset") + F.col("rows") > first))
        if end is not None:
            entered = entered.where(F.col("offset") < end)
        names = [r["file"] for r in entered.select("file").distinct().collect()]
        here = set(names) & set(self._listed)
        if not here:
            return self.files.limit(0).withColumn("source_index", F.lit(None).cast("long"))
        offsets = entered.select(F.col("file").alias("_file"), F.col("offset").alias("_offset"))
        indexed = number_rows(self._scan(sorted(here)), offsets, _plain(F.col("_metadata.file_path")))
        inside = F.col("source_index") >= first
        return self._wanted(indexed.where(inside if end is None else inside & (F.col("source_index") < end)))

    def sizes(self) -> DataFrame:
        """(config, source_rows) as far as files are entered."""
        return self.manifest().where("rows > 0").groupBy("config").agg(F.sum("rows").alias("source_rows"))

    def extent(self) -> list[tuple[str, int]]:
        """(config, last index) per config; the last index is ``NO_END`` while files of its folder are not entered."""
        still = self._pending().select("folder").distinct().withColumn("_more", F.lit(True))
        known = self.manifest().where("rows > 0").join(still, "folder", "left")
        ends = known.groupBy("config").agg(F.sum("rows").alias("rows"), F.max(F.coalesce("_more", F.lit(False))).alias("more"))
        return [(r["config"], NO_END if r["more"] else r["rows"] - 1) for r in self._named(ends).collect()]

    def _named(self, table: DataFrame) -> DataFrame:
        return table.where(F.col("config").isin(*self.configs)) if self.configs else table


def open_corpus(
    spark: SparkSession,
    path: str,
    manifest: str,
    configs: list[str] | None = None,
    split: str | None = None,
    schema: T.StructType = RAW_UTTERANCE,
    config_column: str = "config",
) -> IndexedCorpus:
    """A corpus as ``read_corpus`` reads it, indexed by the manifest kept at ``manifest``."""
    return IndexedCorpus(reader(spark, path, split, schema, config_column), manifest, configs, config_column)
