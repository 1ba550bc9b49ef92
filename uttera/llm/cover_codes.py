"""Vector code compression: product codes whose codebooks Lloyd rounds refine over partition-local cover trees.

Components become integers and a vector is cut into ``PARTS`` equal parts. Per part position a chunk of up to ``CHUNK``
vectors of one partition is put into a cover tree once: a node is a point, a radius that covers its subtree, and a run of
points with cumulative sums, so that the sum of any subtree is one subtraction. In a round an entry takes a whole subtree
if no other entry can be as near to any of its points (triangle inequality); what stays ambiguous descends with the entries
still possible, and at the leaves points are compared exactly. Whatever the chunks, the results are exact.

The trees are written once and read in every round; a task sends one sum per entry, and the driver holds the codebooks
alone, whose size is fixed.

Defined results. Vectors that are null, empty, or hold a null or a component that is not finite are left out, and so are
those whose length is not the table's commonest (of equally common ones the greatest), which must be a multiple of
``PARTS``. Codebooks start from the smallest different ids, a null id last; of several vectors with one id from the smallest.
Repeated rows and ids are coded each by itself. Fewer ids than entries make a shorter codebook. Components so large that
squared distances leave 64 bits are an error. An empty table gives an empty one. Other columns are not read.
"""

import hashlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from uttera.operators.lookup import lookup_join
from uttera.session import materialize

SCALE, PARTS, ENTRIES, ROUNDS = 1024, 4, 256, 4
#: Vectors of one tree, points of one leaf, and by how much radii shrink from a node to its children.
CHUNK, LEAF, SHRINK = 4096, 8, 1.4


def exact(points: np.ndarray) -> np.ndarray:
    """The integers in a type in which squared distances are exact: floats below 2^53, or 64-bit integers."""
    greatest = int(np.abs(points).max(initial=0))
    widest = 4 * greatest * greatest * max(points.shape[-1], 1)
    if widest >= 1 << 63:
        raise ValueError("components are too large for squared distances in 64 bits")
    return points.astype(np.float64 if widest < 1 << 52 else np.int64)


def squared(points: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Squared distances of all points to all entries."""
    return (points * points).sum(1)[:, None] - 2 * (points @ entries.T) + (entries * entries).sum(1)


@dataclass
class CoverTree:
    """``order`` puts the points so that every node is a run of them that begins with its centre.

    ``nodes`` has a row (start, end, first child, last child + 1) per node, children side by side, ``radii`` its radius.
    """

    order: np.ndarray
    nodes: np.ndarray
    radii: np.ndarray

    @classmethod
    def build(cls, points: np.ndarray) -> "CoverTree":
        order = np.arange(len(points), dtype=np.int32)
        nodes, radii, at = [[0, len(points), 0, 0]], [0.0], 0
        while at < len(nodes):
            start, end, _, _ = nodes[at]
            mine = points[order[start:end]]
            gap = mine - mine[0]
            near = (gap * gap).sum(1)
            radii[at] = float(np.sqrt(float(near.max(initial=0)))) * (1 + 1e-12)
            if end - start > LEAF and radii[at] > 0:
                # The centre is its own child; further ones are the farthest points, until all lie within the next radius.
                owner = np.zeros(end - start, np.int32)
                while float(near[far := int(near.argmax())]) > (radii[at] / SHRINK) ** 2:
                    gap = mine - mine[far]
                    other = (gap * gap).sum(1)
                    closer = other < near
                    owner[closer] = owner[far] = owner.max() + 1
                    near = np.where(closer, other, near)
                sort = np.lexsort((near, owner))
                order[start:end] = order[start:end][sort]
                cuts = start + np.flatnonzero(np.r_[True, np.diff(owner[sort]) > 0, True])
                nodes[at][2:] = len(nodes), len(nodes) + len(cuts) - 1
                nodes += [[int(a), int(b), 0, 0] for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
                radii += [0.0] * (len(cuts) - 1)
            at += 1
        return cls(order, np.array(nodes, np.int32), np.array(radii))

    def assigned(self, points: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Runs (starts, ends, entry) of ``points``, which are in ``order``; ties go to the first entry."""
        starts, ends, codes = [], [], []
        todo = [(0, 1, np.arange(len(entries)))] if len(points) else []
        while todo:
            low, high, possible = todo.pop()
            begin, end = self.nodes[low:high, 0], self.nodes[low:high, 1]
            distance = squared(points[begin], entries[possible])
            root = np.sqrt(distance.astype(np.float64))
            reach = (root.min(1) + 2 * self.radii[low:high]) * (1 + 1e-9) + 1e-9
            # Subtrees of a single point or of equal points are compared exactly here.
            sure = (self.radii[low:high] == 0) | ((root <= reach[:, None]).sum(1) == 1)
            starts.append(begin[sure])
            ends.append(end[sure])
            codes.append(possible[distance[sure].argmin(1)])
            for i in np.flatnonzero(~sure):
                left = possible[root[i] <= reach[i]]
                first, last = self.nodes[low + i, 2:]
                if first < last:
                    todo.append((first, last, left))
                else:
                    inside = np.arange(begin[i], end[i])
                    starts.append(inside)
                    ends.append(inside + 1)
                    codes.append(left[squared(points[inside], entries[left]).argmin(1)])
        empty = [np.zeros(0, np.int64)]
        return np.concatenate(starts or empty), np.concatenate(ends or empty), np.concatenate(codes or empty)


def sums(tree: CoverTree, points: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Count and sum of the points of each entry: whole subtrees by their cumulative sums."""
    starts, ends, codes = tree.assigned(points, entries)
    upto = np.zeros((len(points) + 1, points.shape[1]), np.int64)
    np.cumsum(points.astype(np.int64), axis=0, out=upto[1:])
    count, total = np.zeros(len(entries), np.int64), np.zeros(entries.shape, np.int64)
    np.add.at(count, codes, ends - starts)
    np.add.at(total, codes, upto[ends] - upto[starts])
    return count, total


def integers(vectors: pa.Array, scale: int) -> np.ndarray:
    """floor(scale * x) of equally long vectors."""
    flat = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    whole = np.floor(flat * scale).reshape(len(vectors), -1)
    if np.abs(whole).max(initial=0) >= 2.0**62:
        raise ValueError("components are too large for squared distances in 64 bits")
    return whole.astype(np.int64)


def usable(vectors: DataFrame, vector: str) -> DataFrame:
    sound = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return vectors.filter(F.col(vector).isNotNull() & (F.size(vector) > 0) & sound)


def first_ids(kept: DataFrame, count: int) -> list:
    """The smallest different ids, null last: every partition sends no more than are wanted."""
    name = kept.columns[0]

    def smallest(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = None
        for batch in batches:
            ids = batch.column(0) if best is None else pa.concat_arrays([best, batch.column(0)])
            ids = pc.unique(ids)
            best = ids.take(pc.sort_indices(ids, null_placement="at_end")[:count])
        if best is not None:
            yield pa.RecordBatch.from_arrays([best], [name])

    found = kept.select(name).mapInArrow(smallest, kept.select(name).schema).distinct()
    return [row[0] for row in found.orderBy(F.asc_nulls_last(name)).limit(count).collect()]


def first_codebooks(kept: DataFrame, parts: int, entries: int, scale: int) -> np.ndarray:
    """(parts, entries, width) integers from the vectors of the smallest ids."""
    key, vector = kept.columns[:2]
    ids = first_ids(kept, entries)
    wanted = F.col(key).isin([i for i in ids if i is not None]) | (F.col(key).isNull() if None in ids else F.lit(False))
    seeds = kept.filter(wanted).groupBy(key).agg(F.min(vector).alias("v")).orderBy(F.asc_nulls_last(key)).select("v").collect()
    whole = np.floor(np.array([row[0] for row in seeds], np.float64) * scale).astype(np.int64)
    return whole.reshape(len(seeds), parts, -1).swapaxes(0, 1)


def plant(kept: DataFrame, parts: int, scale: int, chunk: int = CHUNK) -> DataFrame:
    """A row per chunk: ids, labels, integer vectors and a tree per part; arrays are kept as bytes."""
    key, _, label = kept.columns

    def trees(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def planted(table: pa.Table) -> pa.RecordBatch:
            ids, vectors, labels = (table.column(i).combine_chunks() for i in range(3))
            whole = integers(vectors, scale)
            offsets = pa.array([0, len(whole)], pa.int32())
            grown = [CoverTree.build(exact(part)) for part in np.split(whole, parts, axis=1)]
            columns = [
                pa.ListArray.from_arrays(offsets, ids), pa.ListArray.from_arrays(offsets, labels), pa.array([whole.tobytes()], pa.binary()),
                *(pa.array([[getattr(t, f).tobytes() for t in grown]], pa.list_(pa.binary())) for f in ("order", "nodes", "radii")),
            ]
            return pa.RecordBatch.from_arrays(columns, ["ids", "labels", "vectors", "orders", "nodes", "radii"])

        for batch in batches:
            held.append(batch)
            while sum(map(len, held)) >= chunk:
                table = pa.Table.from_batches(held)
                yield planted(table.slice(0, chunk))
                held = table.slice(chunk).to_batches()
        if sum(map(len, held)):
            yield planted(pa.Table.from_batches(held))

    kinds = dict(kept.dtypes)
    shape = "vectors binary, orders array<binary>, nodes array<binary>, radii array<binary>"
    return kept.mapInArrow(trees, f"ids array<{kinds[key]}>, labels array<{kinds[label]}>, {shape}")


def grown(batches: Iterable[pa.RecordBatch], parts: int) -> Iterator[tuple[pa.RecordBatch, int, list[tuple[CoverTree, np.ndarray]]]]:
    """Per stored chunk its batch, its row there, and tree and ordered points of every part."""
    for batch in batches:
        for i in range(len(batch)):
            vectors, orders, nodes, radii = (batch.column(n)[i].as_py() for n in ("vectors", "orders", "nodes", "radii"))
            whole = np.frombuffer(vectors, np.int64).reshape(len(batch.column("ids")[i]), -1)
            chunk = []
            for part, order, node, radius in zip(np.split(whole, parts, axis=1), orders, nodes, radii, strict=True):
                tree = CoverTree(np.frombuffer(order, np.int32), np.frombuffer(node, np.int32).reshape(-1, 4), np.frombuffer(radius))
                chunk.append((tree, part[tree.order]))
            yield batch, i, chunk


def same_type(points: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    both = exact(np.concatenate([points, entries]))
    return both[: len(points)], both[len(points) :]


def refined(trees: DataFrame, codebooks: np.ndarray) -> np.ndarray:
    """The codebooks after one round; entries that no part takes stay as they are."""
    parts, entries, width = codebooks.shape

    def partial(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count, total = np.zeros((parts, entries), np.int64), np.zeros(codebooks.shape, np.int64)
        for _, _, chunk in grown(batches, parts):
            for p, (tree, points) in enumerate(chunk):
                n, s = sums(tree, *same_type(points, codebooks[p]))
                count[p] += n
                total[p] += s
        part, entry = np.nonzero(count)
        yield pa.RecordBatch.from_pydict(
            {"part": pa.array(part, pa.int32()), "entry": pa.array(entry, pa.int32()), "n": pa.array(count[part, entry]),
             "total": pa.array(list(total[part, entry]), pa.list_(pa.int64()))}
        )

    sent = trees.mapInArrow(partial, "part int, entry int, n bigint, total array<bigint>")
    totals = [F.sum(F.col("total")[i].cast("decimal(38,0)")).cast("string") for i in range(width)]
    out = codebooks.copy()
    for row in sent.groupBy("part", "entry").agg(F.sum("n").alias("n"), F.array(*totals).alias("total")).collect():
        out[row["part"], row["entry"]] = [int(t) // row["n"] for t in row["total"]]
    return out


def coded(trees: DataFrame, codebooks: np.ndarray) -> DataFrame:
    """(id, label, code, error) per vector under the codebooks."""
    parts = len(codebooks)
    kinds = dict(trees.dtypes)

    def codes(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, i, chunk in grown(batches, parts):
            n = len(chunk[0][1])
            code, error = np.zeros((n, parts), np.uint8 if len(codebooks[0]) <= 256 else np.uint16), np.zeros(n, np.int64)
            for p, (tree, points) in enumerate(chunk):
                points, entries = same_type(points, codebooks[p])
                starts, ends, found = tree.assigned(points, entries)
                taken = np.zeros(n, np.int64)
                runs = np.argsort(starts)
                taken[:] = np.repeat(found[runs], (ends - starts)[runs])
                code[tree.order, p] = taken
                gap = points - entries[taken]
                error[tree.order] += (gap * gap).sum(1).astype(np.int64)
            digits = code.byteswap().tobytes().hex() if code.itemsize > 1 else code.tobytes().hex()
            size = 2 * parts * code.itemsize
            texts = pa.array([digits[a : a + size] for a in range(0, n * size, size)], pa.string())
            ids, labels = (batch.column(name)[i].values for name in ("ids", "labels"))
            yield pa.RecordBatch.from_arrays([ids, labels, texts, pa.array(error)], ["id", "label", "code", "error"])

    kind = {c: kinds[c].removeprefix("array<").removesuffix(">") for c in ("ids", "labels")}
    return trees.mapInArrow(codes, f"id {kind['ids']}, label {kind['labels']}, code string, error bigint")


def digest(codebooks: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, codebooks.reshape(-1).tolist())).encode()).hexdigest()


def compress(
    vectors: DataFrame,
    key: str = "vec_id",
    vector: str = "embedding",
    label: str = "label",
    parts: int = PARTS,
    entries: int = ENTRIES,
    rounds: int = ROUNDS,
    scale: int = SCALE,
) -> tuple[DataFrame, np.ndarray]:
    """A row (key, code, error, label_error) per usable vector, and the final codebooks (parts, entries, width)."""
    kept = usable(vectors.select(F.col(key).alias("id"), F.col(vector).alias("vector"), F.col(label).alias("label")), "vector")
    sizes = kept.groupBy(F.size("vector").alias("size")).count().orderBy(F.desc("count"), F.desc("size")).first()
    width = sizes["size"] if sizes else parts
    if width % parts:
        raise ValueError(f"vectors of {width} components cannot be cut into {parts} equal parts")
    kept = kept.filter(F.size("vector") == width)
    books = first_codebooks(kept, parts, entries, scale) if sizes else np.zeros((parts, 0, width // parts), np.int64)
    trees = materialize(plant(kept, parts, scale), "trees")
    for _ in range(rounds):
        books = refined(trees, books)
    found = materialize(coded(trees, books), "codes")
    # A struct keeps rows without a label: a join on the label itself would not find theirs.
    found = found.withColumn("label", F.struct("label"))
    by_label = materialize(found.groupBy("label").agg(F.sum("error").alias("label_error")), "labels")
    both = lookup_join(found, by_label, "label")
    return both.select(F.col("id").alias(key), "code", "error", "label_error"), books
