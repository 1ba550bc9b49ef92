"""A Merkle manifest of a dataset: a tree per group, a tree over the groups' roots, and a proof per row.

Every level joins its nodes with themselves: a node computes the indices of its siblings (its own index with the last bit
flipped in a binary tree, otherwise its run's first index plus a shifted slot) and finds them by an equijoin. What a node
gets is its step of the proof, the hashes left and right of it; nodes in slot zero emit the parents. Proofs are then
handed down from level to level, so no row carries more than a path.

Leaves are placed by one range-partitioned sort of narrow rows and an offset per partition, so neither a group of any size
nor an id with many rows is sorted in one task.

Defined results. Rows are ordered by id, null first; rows of one id by their leaf, equal rows as stored. Rows without a
group are a group, the first. A lone leaf is its group's root, a lone group's root the dataset's. Null and empty values
differ. An empty table gives an empty one. The named columns are hashed; results take names of their own.
"""

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from uttera.llm.common import ascii_lower
from uttera.operators.lookup import lookup_join
from uttera.session import materialize

FANOUT = 8
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
#: The step of a proof at one level: the digests left and right of the node, side by side. Digests travel as 32 bytes.
STEP = "struct<left:binary,right:binary>"


def written(digests: Column) -> Column:
    """Digests as the hex text that is hashed and returned."""
    return F.lower(F.hex(digests))


def hashed(*digests: Column) -> Column:
    """The digest of digests, which are joined as hex text."""
    return F.unhex(F.sha2(written(F.concat(*digests)), 256))


def field(value: Column) -> Column:
    """UTF-8 byte count, a colon and the value; a dash for null."""
    written = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(written).cast("string"), F.lit(":"), written), F.lit("-"))


def leaf(columns: dict[str, Column]) -> Column:
    return F.unhex(F.sha2(F.concat(*[field(c) for c in columns.values()]), 256))


def tampered(key: Column, text: Column) -> Column:
    """The text as a tamperer leaves it: lower-cased in rows whose key's CRC-32 is a multiple of three."""
    chosen = F.coalesce(F.crc32(key.cast("string").cast("binary")) % 3 == 0, F.lit(False))
    return F.when(chosen, ascii_lower(text)).otherwise(text)


def placed(rows: DataFrame, by: str, order: list[str]) -> DataFrame:
    """The rows, stored, with ``idx``: their position, from 0, among those of the same ``by`` (null too) in ``order``.

    The sort spreads equal keys over partitions by the number that a stored row has. A row's number in the sorted table
    gives its position in its partition; what comes before is a sum over one count per partition and group.
    """
    numbered = rows.withColumn("_stored", F.monotonically_increasing_id())
    spread = numbered.orderBy(F.asc_nulls_first(by), *[F.asc_nulls_first(c) for c in order], "_stored").drop("_stored")
    at = materialize(spread.withColumn("_at", F.monotonically_increasing_id()), "sorted")
    # The upper bits number the partitions.
    run = F.struct(F.shiftright("_at", 33).alias("part"), F.col(by).alias("by"))
    runs = at.groupBy(run.alias("_run")).agg(F.min("_at").alias("_first"), F.count("*").alias("_count"))
    earlier = Window.partitionBy("_run.by").orderBy("_run.part").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.select("_run", "_first", F.coalesce(F.sum("_count").over(earlier), F.lit(0)).alias("_before"))
    found = lookup_join(at.withColumn("_run", run), materialize(runs, "runs"), "_run")
    return found.withColumn("idx", F.col("_before") + F.col("_at") - F.col("_first")).drop("_run", "_at", "_first", "_before")


def siblings(idx: Column, fanout: int) -> Column:
    """The indices of a node's siblings, from the next slot of its run on."""
    if fanout == 2:
        return F.array(idx.bitwiseXOR(F.lit(1)))
    slot = idx % fanout
    return F.transform(F.sequence(F.lit(1), F.lit(fanout - 1)), lambda shift: idx - slot + (slot + shift) % fanout)


def climb(nodes: DataFrame, fanout: int) -> DataFrame:
    """``nodes`` (tree, idx, n, hash), n being the nodes of the tree at this level, each with its siblings in ``run``.

    A node is sent to its siblings' indices and met there; what is then gathered per node is where the join left it.
    """
    sent = nodes.select("tree", F.explode(siblings(F.col("idx"), fanout)).alias("idx"), F.struct(F.col("idx").alias("sibling"), "hash").alias("sent"))
    # Both sides grow with the data; a merge join holds neither in memory.
    met = nodes.join(sent.hint("merge"), ["tree", "idx"], "left")
    return met.groupBy("tree", "idx").agg(F.any_value("n").alias("n"), F.any_value("hash").alias("hash"), F.sort_array(F.collect_list("sent")).alias("run"))


def _joined(run: Column, which: Callable[[Column], Column]) -> Column:
    """The digests of some of a run, side by side."""
    return F.aggregate(F.filter(run, which), F.lit(b""), lambda acc, s: F.concat(acc, s["hash"]))


def _levels(leaves: DataFrame, fanout: int) -> tuple[list[DataFrame], DataFrame]:
    """The stored levels of all trees from the leaves up, each node with its step, and the roots (tree, hash).

    A tree ends at the level where it has one node.
    """
    nodes, levels, roots = leaves.select("tree", "idx", "n", "hash"), [], []
    widest = leaves.agg(F.max("n")).first()[0] or 0
    while widest > 1:
        roots.append(nodes.filter("n = 1").select("tree", "hash"))
        met = climb(nodes.filter("n > 1"), fanout)
        left, right = (_joined(F.col("run"), test) for test in (lambda s: s["sibling"] < F.col("idx"), lambda s: s["sibling"] > F.col("idx")))
        level = met.select("tree", "idx", "n", "hash", left.alias("left"), right.alias("right"))
        # Slot zero of every run emits the parent.
        parent = F.when(F.col("idx") % fanout == 0, hashed(F.col("hash"), F.col("right")))
        level = materialize(level.select("tree", "idx", "n", F.struct("left", "right").alias("step"), parent.alias("parent")), "level")
        levels.append(level)
        up = _parent(level.filter("parent is not null"), fanout)
        up = up.select("tree", F.col("up").alias("idx"), F.expr(f"(n + {fanout - 1}) div {fanout}").alias("n"), F.col("parent").alias("hash"))
        nodes, widest = materialize(up, "nodes"), -(-widest // fanout)
    roots.append(nodes.filter("n = 1").select("tree", "hash"))
    return levels, materialize(reduce(DataFrame.unionByName, roots), "roots")


def _paths(levels: list[DataFrame], above: DataFrame, fanout: int) -> DataFrame:
    """(tree, up, path) of the parents of the leaves: the steps from there up. ``above`` (tree, n, path) has what follows
    a tree's root, n being its leaves; it is handed to the level at which the tree's nodes are one run.
    """

    def tops(level: int) -> DataFrame:
        return above.filter(F.col("n") <= F.lit(fanout ** (level + 1))).select("tree", F.lit(0).cast("long").alias("up"), "path")

    paths = tops(max(len(levels) - 1, 0))
    for level in range(len(levels) - 1, 0, -1):
        below = _parent(levels[level], fanout).join(paths, ["tree", "up"])
        below = materialize(below.select("tree", F.col("idx").alias("up"), F.concat(F.array("step"), "path").alias("path")), "paths")
        paths = below.unionByName(tops(level - 1))
    return paths


def _parent(nodes: DataFrame, fanout: int) -> DataFrame:
    return nodes.withColumn("up", F.expr(f"idx div {fanout}"))


def _proved(leaves: DataFrame, levels: list[DataFrame], above: DataFrame, fanout: int) -> DataFrame:
    """The leaves with ``path``; a path is put together where it is used, and only parents' paths are shuffled."""
    rows = _parent(leaves, fanout)
    if levels:
        rows = rows.join(levels[0].select("tree", "idx", "step"), ["tree", "idx"], "left")
    else:
        rows = rows.withColumn("step", F.lit(None).cast(STEP))
    own = F.when(F.col("step").isNull(), F.array().cast(f"array<{STEP}>")).otherwise(F.array("step"))
    found = rows.join(_paths(levels, above, fanout).withColumnRenamed("path", "_above"), ["tree", "up"])
    return found.withColumn("path", F.concat(own, "_above")).drop("step", "up", "_above")


def folded(path: Column, start: Column) -> Column:
    """The root that a leaf and the hashes of a path lead to."""
    return F.aggregate(path, start, lambda acc, step: hashed(step["left"], acc, step["right"]))


def proof(path: Column) -> Column:
    """The hash of all siblings on the path, level by level."""
    return hashed(F.aggregate(path, F.lit(b""), lambda acc, step: F.concat(acc, step["left"], step["right"])))


def manifest(
    rows: DataFrame, key: str = "doc_id", by: str = "lang", text: str = "text", fields: tuple[str, ...] = FIELDS, fanout: int = FANOUT
) -> tuple[DataFrame, bytes | None]:
    """A row per row of ``rows``: (key, ``by``, idx, leaf, changed, subroot, path), and the root of the whole; digests as bytes.

    ``changed`` is the leaf as tampering makes it. A reader checks a row with ``folded(path, leaf) == root``.
    """
    columns = {c: F.col(c) for c in fields}
    changed = leaf(columns | {text: tampered(F.col(key), F.col(text))})
    narrow = materialize(rows.select(F.col(key).alias("key"), F.col(by).alias("by"), leaf(columns).alias("leaf"), changed.alias("changed")), "leaves")
    counts = materialize(narrow.groupBy("by").agg(F.count("*").alias("n")), "groups").withColumn("_all", F.lit(0))
    trees = placed(counts, "_all", ["by"]).select(F.struct("by").alias("_by"), "n", F.col("idx").alias("tree"))
    trees = materialize(trees, "trees")
    at = lookup_join(placed(narrow, "by", ["key", "leaf"]).withColumn("_by", F.struct("by")), trees, "_by").drop("_by")
    leaves = materialize(at, "placed")
    levels, roots = _levels(leaves.withColumnRenamed("leaf", "hash"), fanout)

    number = trees.count()
    tops = materialize(roots.select(F.lit(0).cast("long").alias("tree"), F.col("tree").alias("idx"), F.lit(number).cast("long").alias("n"), "hash"), "tops")
    upper, whole = _levels(tops, fanout)
    root = whole.first()
    nothing = tops.filter("idx = 0").select("tree", "n", F.array().cast(f"array<{STEP}>").alias("path"))
    above = _proved(tops, upper, nothing, fanout).select(F.col("idx").alias("tree"), F.col("hash").alias("subroot"), "path")
    above = materialize(above.join(trees.select("tree", "n"), "tree"), "tops")
    found = _proved(leaves, levels, above.select("tree", "n", "path"), fanout)
    named = lookup_join(found, above.select("tree", "subroot"), "tree")
    result = named.select(F.col("key").alias(key), F.col("by").alias(by), "idx", "leaf", "changed", "subroot", "path")
    return result, bytes(root["hash"]) if root else None


def verified(rows: DataFrame, key: str = "doc_id", by: str = "lang", text: str = "text", fields: tuple[str, ...] = FIELDS, fanout: int = FANOUT) -> DataFrame:
    """Per row its leaf, roots, the hash of its proof, and whether what a tamperer left of it still leads to the root."""
    found, root = manifest(rows, key, by, text, fields, fanout)
    digests = {
        "leaf": F.col("leaf"), "subroot": F.col("subroot"), "root": F.lit(root).cast("binary"),
        "proof_sha256": proof(F.col("path")), "folded_root": folded(F.col("path"), F.col("changed")),
    }
    return found.select(key, *[written(d).alias(name) for name, d in digests.items()]).withColumn("verified", F.col("folded_root") == F.col("root"))
