"""Vector codes, the Merkle manifest and document sketches against plain versions."""

import hashlib
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm.test_contracts import result, rows_of
from uttera.llm import cover_codes, merkle, sketch

RNG = np.random.default_rng(3)


def plain_codes(rows, parts=4, entries=256, rounds=4, scale=1024):
    """(id, code, error) by comparing every part with every entry in Python integers."""
    kept = [(i, [int(np.floor(np.float64(x) * scale)) for x in v]) for i, v, _ in rows]
    width = len(kept[0][1]) // parts
    piece = [[tuple(v[p * width : (p + 1) * width]) for _, v in kept] for p in range(parts)]
    seeds = sorted({i for i, _ in kept})[:entries]
    first = [min(n for n, (i, _) in enumerate(kept) if i == s) for s in seeds]
    books = [[piece[p][n] for n in first] for p in range(parts)]

    def near(x, book):
        gaps = [sum((a - b) ** 2 for a, b in zip(x, e, strict=True)) for e in book]
        return min(range(len(book)), key=lambda e: (gaps[e], e)), min(gaps)

    for _ in range(rounds):
        for p in range(parts):
            taken = {}
            for x in piece[p]:
                taken.setdefault(near(x, books[p])[0], []).append(x)
            for e, xs in taken.items():
                books[p][e] = tuple(sum(column) // len(xs) for column in zip(*xs, strict=True))
    found = [[near(piece[p][n], books[p]) for p in range(parts)] for n in range(len(kept))]
    return [(kept[n][0], "".join(f"{e:02x}" for e, _ in f), sum(d for _, d in f)) for n, f in enumerate(found)], books


def vectors(n, width=8, copies=0):
    rows = [(int(i), RNG.normal(0, 0.3, width).astype(np.float32).tolist(), int(i) % 3 if i % 5 else None) for i in RNG.permutation(n)]
    return rows + rows[:1] * copies


def coded(spark, rows, **how):
    table = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>, label int").repartition(3)
    return cover_codes.compress(table, **how)


@pytest.mark.parametrize("rows", [vectors(120), vectors(90, copies=40), [(1, [0.5] * 8, None)] * 20, vectors(3)])
def test_codes_equal_plain_lloyd(spark, rows):
    found, books = coded(spark, rows, entries=16)
    want, plain = plain_codes(rows, entries=16)
    assert books.tolist() == [[list(e) for e in book] for book in plain]
    got = [tuple(r) for r in found.select("vec_id", "code", "error").collect()]
    assert sorted(got) == sorted(want)
    by_label = {}
    for (_, _, label), (_, _, error) in zip(rows, want, strict=True):
        by_label[label] = by_label.get(label, 0) + error
    labels = {i: label for i, _, label in rows}
    assert all(r["label_error"] == by_label[labels[r["vec_id"]]] for r in found.collect())


def test_codes_leave_out_what_is_no_vector(spark):
    good = vectors(40)
    nan, inf = float("nan"), float("inf")
    bad = [(100, None, 1), (101, [], 1), (102, [nan] * 8, 1), (103, [inf] + [0.0] * 7, 1), (104, [None] + [0.0] * 7, 1), (105, [0.1] * 6, 1)]
    found, books = coded(spark, good + bad)
    assert sorted(r["vec_id"] for r in found.collect()) == sorted(i for i, _, _ in good)
    assert books.shape == (4, 40, 2)
    with_null, _ = coded(spark, [*good, (None, [0.2] * 8, None)])
    assert with_null.filter("vec_id is null").count() == 1
    empty, books = coded(spark, [])
    assert empty.collect() == [] and books.shape[1] == 0
    with pytest.raises(ValueError):
        coded(spark, [(1, [0.5] * 6, 1)])


def test_codes_take_clashing_columns(spark):
    table = spark.createDataFrame(vectors(20), "vec_id bigint, embedding array<float>, label int")
    odd = table.withColumns({c: F.lit("x") for c in ("code", "error", "id", "vector", "label_error", "size")})
    assert cover_codes.compress(odd)[0].columns == ["vec_id", "code", "error", "label_error"]
    assert cover_codes.compress(odd)[0].count() == 20


@pytest.mark.parametrize("points", [RNG.integers(-50, 50, (300, 2)), RNG.integers(0, 3, (200, 4)), RNG.integers(-900, 900, (500, 16)), np.zeros((50, 3), int)])
def test_cover_tree_gives_nearest_entries(points):
    points = cover_codes.exact(points)
    tree = cover_codes.CoverTree.build(points)
    assert sorted(tree.order.tolist()) == list(range(len(points)))
    placed = points[tree.order]
    for (start, end, low, high), radius in zip(tree.nodes.tolist(), tree.radii, strict=True):
        assert np.sqrt(((placed[start:end] - placed[start]) ** 2).sum(1)).max() <= radius
        if low < high:
            assert tree.nodes[low:high, 0].tolist() + [end] == [start] + tree.nodes[low:high, 1].tolist()
    entries = points[:20] + 1
    starts, ends, codes = tree.assigned(placed, entries)
    got = np.empty(len(points), int)
    for a, b, c in zip(starts, ends, codes, strict=True):
        got[a:b] = c
    assert (got == cover_codes.squared(placed, entries).argmin(1)).all()
    count, total = cover_codes.sums(tree, placed, entries)
    assert count.tolist() == np.bincount(got, minlength=len(entries)).tolist()
    assert all((total[c] == placed[got == c].sum(0)).all() for c in range(len(entries)))


def test_whole_subtrees_are_taken_at_once():
    groups = np.concatenate([RNG.integers(-5, 5, (400, 4)) + 1000 * k for k in range(3)])
    points = cover_codes.exact(groups)
    tree = cover_codes.CoverTree.build(points)
    starts, _, _ = tree.assigned(points[tree.order], cover_codes.exact(np.array([[1000 * k] * 4 for k in range(3)])))
    assert len(starts) < 40


def test_large_integers_stay_exact():
    points = cover_codes.exact(RNG.integers(-(1 << 28), 1 << 28, (60, 4)))
    assert points.dtype == np.int64
    tree = cover_codes.CoverTree.build(points)
    _, _, codes = tree.assigned(points[tree.order], points[:9])
    assert len(codes)
    with pytest.raises(ValueError):
        cover_codes.exact(np.array([[1 << 40]]))


def sha(*inputs):
    return hashlib.sha256("".join(inputs).encode()).hexdigest()


def field(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def lowered(text):
    return None if text is None else "".join(c.lower() if "A" <= c <= "Z" else c for c in text)


def grow(hashes, fanout):
    """The root, and per leaf its list of (slot, siblings)."""
    paths, at = [[] for _ in hashes], list(range(len(hashes)))
    while len(hashes) > 1:
        for leaf, i in enumerate(at):
            run = hashes[i // fanout * fanout : i // fanout * fanout + fanout]
            paths[leaf].append((i % fanout, run[: i % fanout] + run[i % fanout + 1 :]))
        hashes = [sha(*hashes[a : a + fanout]) for a in range(0, len(hashes), fanout)]
        at = [i // fanout for i in at]
    return hashes[0], paths


def plain_manifest(rows, fanout=8):
    """Per row (doc_id, leaf, subroot, root, proof, folded root), in Python."""
    leaves = [(r, sha(*map(field, r)), r[4]) for r in rows]
    by = {}
    for r, leaf, _ in leaves:
        by.setdefault(r[2], []).append((r[0] is not None, r[0] or 0, leaf, r))
    order = sorted(by, key=lambda k: (k is not None, (k or "").encode()))
    trees = {k: (sorted(by[k], key=lambda x: x[:3]), *grow([x[2] for x in sorted(by[k], key=lambda x: x[:3])], fanout)) for k in order}
    root, above = grow([trees[k][1] for k in order], fanout)
    out = []
    for k, upper in zip(order, above, strict=True):
        members, subroot, paths = trees[k]
        for (_, _, leaf, r), path in zip(members, paths, strict=True):
            chosen = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 3 == 0
            at = sha(*map(field, [*r[:4], lowered(r[4]) if chosen else r[4]]))
            for slot, others in path + upper:
                at = sha(*others[:slot], at, *others[slot:])
            out.append((r[0], leaf, subroot, root, sha(*[h for _, others in path + upper for h in others]), at, at == root))
    return out


MANIFEST = "doc_id bigint, source string, lang string, n_chars bigint, text string"


def documents(n, langs=3):
    return [(i, f"s{i % 4}", f"l{i % langs}" if i % 7 else None, i * 3, f"Tëxt {i} A" if i % 5 else None) for i in range(n)]


@pytest.mark.parametrize("rows,fanout", [
    (documents(150), 8), (documents(40), 2), (documents(65, 1), 8), (documents(30, 30), 3), (documents(1), 8), (documents(9, 1)[1:], 8),
    ([*documents(20), *documents(20), (None, None, None, None, None), (None, None, None, None, None), (None, "", "", 0, "")], 8),
])
def test_manifest_equals_plain_trees(spark, rows, fanout):
    docs = spark.createDataFrame(rows, MANIFEST).repartition(4).withColumns({c: F.lit("x") for c in ("idx", "leaf", "tree", "n", "hash")})
    found = merkle.verified(docs, fanout=fanout)
    got = [tuple(r) for r in found.select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified").collect()]
    assert sorted(map(repr, got)) == sorted(map(repr, plain_manifest(rows, fanout)))


def test_manifest_of_nothing(spark):
    assert merkle.verified(spark.createDataFrame([], MANIFEST)).collect() == []


def plain_edits(rows):
    """Per row what the query returns, from whole sets of shingles instead of sketches where these are whole."""
    order = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0)))
    return [(a, text or "", (b or "")) for (a, text), (_, b) in zip(order, order[1:] + order[:1], strict=True)]


def plain_shingles(text):
    words = text.encode().lower().split()
    return {b" ".join(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def test_sketches_of_whole_table(spark):
    rows = rows_of("documents", "doc_id, text")
    got = {r["doc_id"]: r for r in result(spark, "op13_sketch")}
    assert len(got) == len(rows)
    errors = []
    for doc, text, following in plain_edits(rows):
        r, cut = got[doc], len(text) // 3
        changed = text[: len(text) - cut] + following[:cut]
        assert r["n_chars"] == len(text) and r["edited_sha256"] == hashlib.sha256(changed.encode()).hexdigest()
        for name, other in (("near_edited", changed), ("near_next", following)):
            mine, theirs = plain_shingles(text), plain_shingles(other)
            share = len(mine & theirs) / len(mine) if mine else float(not theirs)
            if len(mine) < sketch.FLOOR and len(theirs) < sketch.FLOOR:
                assert abs(r[name] - share) < 1e-12
            errors.append(r[name] - share)
        assert r["fingerprint"] == sketch.written(sketch.sketch(text.encode()))
    assert np.abs(errors).mean() < 0.04 and abs(np.mean(errors)) < 0.01
    assert np.mean([got[d]["near_edited"] > got[d]["near_next"] for d in got]) > 0.95


@pytest.mark.parametrize("rows", [
    [], [(1, "a b c d e f")], [(1, None), (2, ""), (3, " \n"), (None, "Ünï cöde wörds thät äre lông"), (None, None)],
    [(5, "one two three four five six seven")] * 30 + [(7, "x " * 5000), (6, None)], [(i, f"w{i} " * (i % 9)) for i in range(200)],
])
def test_edits_meet_the_next_row(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(5).withColumns({c: F.lit(0) for c in ("part", "key", "edge", "fingerprint")})
    got = [(r["doc_id"], r["n_chars"], r["edited_sha256"], r["near_edited"], r["near_next"]) for r in sketch.edit_check(docs).collect()]
    want = []
    for doc, text, following in plain_edits(sorted(rows, key=lambda r: r[0] is None)):
        row = sketch.Row(doc, text.encode()).beside(sketch.Row(None, following.encode()))
        want.append((doc, len(text), row["edited_sha256"], row["near_edited"], row["near_next"]))
    if sum(r[0] is None for r in rows) < 2:
        assert sorted(map(repr, got)) == sorted(map(repr, want))
    else:
        assert sorted(repr(g[:2]) for g in got) == sorted(repr(w[:2]) for w in want)
    assert all(0 <= g[3] <= 1 and 0 <= g[4] <= 1 for g in got)


def test_sketches_merge_and_estimate():
    words = [f"w{i}" for i in range(4000)]
    one, other = " ".join(words[:3000]).encode(), " ".join(words[2900:]).encode()
    a, b = sketch.sketch(one), sketch.sketch(other)
    both = sketch.retained(np.union1d(sketch.shingle_hashes(one), sketch.shingle_hashes(other)))
    assert sketch.merge(a, b).tolist() == both.tolist()
    assert sketch.read(sketch.written(a)).tolist() == a.tolist()
    small = " ".join(words[100:140]).encode()
    assert sketch.containment(sketch.sketch(small), a) > 0.95
    assert sketch.containment(a, sketch.sketch(small)) < 0.1
    assert sketch.resemblance(a, a) == 1.0 and sketch.containment(sketch.sketch(b""), a) == 0.0
    assert sketch.containment(sketch.sketch(b""), sketch.sketch(b" ")) == 1.0
