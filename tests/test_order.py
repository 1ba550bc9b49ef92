"""Positions, shards, limits, resuming and splits, with buckets small enough to be crossed often."""

import random
from collections import defaultdict
from math import ceil

import pytest
from pyspark.sql import functions as F

from uttera.operators import examples as E
from uttera.operators import filters
from uttera.operators import shards as H
from uttera.operators.lookup import lookup_join
from uttera.operators.ranking import index_bucket, ranked
from uttera.sources.progress import load_progress, save_progress

SCHEMA = "config string, worker int, source_index long"


@pytest.fixture(scope="module")
def accepted():
    """A third of the rows in one config; one group has no name."""
    draw = random.Random(7)
    names = ["hot"] * 3 + ["a", "b", "c", None]
    seen = {(draw.choice(names), i) for i in range(0, 900) if draw.random() < 0.7}
    return [(c, i % 2, i) for c, i in seen]


def grouped(rows):
    groups = defaultdict(list)
    for config, worker, index in sorted(rows, key=lambda r: r[2]):
        groups[config, worker].append(index)
    return groups


def test_ranked_matches_brute_force(spark, accepted):
    df = spark.createDataFrame(accepted, SCHEMA).repartition(5)
    got = ranked(df, ["config", "worker"], F.col("source_index"), index_bucket("source_index", 16)).collect()
    want = {(c, w, i): at for (c, w), group in grouped(accepted).items() for at, i in enumerate(group)}
    assert {(r.config, r.worker, r.source_index): r["rank"] for r in got} == want
    below = ranked(df, ["config", "worker"], F.col("source_index"), index_bucket("source_index", 16), below=20)
    assert {(r.config, r.worker, r.source_index) for r in below.collect()} == {k for k, v in want.items() if v < 20}


def test_assign_shards_crosses_buckets(spark, accepted):
    df = spark.createDataFrame(accepted, SCHEMA)
    got = H.assign_shards(df, rows_per_shard=10, bucket_rows=16).collect()
    want = {(c, w, i): at // 10 for (c, w), group in grouped(accepted).items() for at, i in enumerate(group)}
    assert {(r.config, r.worker, r.source_index): r.shard for r in got} == want
    assert {r.shard_name for r in got if r.config == "a" and r.worker == 1 and r.shard == 0} == {"a_w1_s0"}


@pytest.mark.parametrize("rows,shards", [(0, 0), (499, 1), (500, 1), (501, 2)])
def test_shard_edges(spark, rows, shards):
    df = spark.range(rows).select(F.lit("c").alias("config"), F.lit(0).alias("worker"), F.col("id").alias("source_index"))
    assert H.assign_shards(df).select("shard").distinct().count() == shards


def test_limit_counts_across_configs_in_their_order(spark, accepted):
    named = [r for r in accepted if r[0]]
    df = spark.createDataFrame(named, SCHEMA)
    order = ["c", "hot", "a", "b"]
    got = H.limit_accepted(df, 120, order, bucket_rows=16).collect()
    for worker in (0, 1):
        mine = sorted((r for r in named if r[1] == worker), key=lambda r: (order.index(r[0]), r[2]))[:120]
        assert sorted(tuple(r) for r in got if r.worker == worker) == sorted(mine)
    assert H.limit_accepted(df, None) is df and H.limit_accepted(df, 0) is df
    with pytest.raises(ValueError):
        H.limit_accepted(df, -1)


def test_resumed_run_gives_what_a_single_run_gives(spark, accepted, tmp_path):
    df = spark.createDataFrame([r for r in accepted if r[0]], SCHEMA)
    whole = H.assign_shards(df, 10, bucket_rows=16).select(*SCHEMA.split()[::2], "shard")
    path = str(tmp_path / "progress")
    assert load_progress(spark, path).count() == 0
    parts = []
    for stop in (2, 5, None):
        left = H.skip_consumed(df, load_progress(spark, path))
        part = H.assign_shards(left, 10, stop, "first_shard", bucket_rows=16)
        parts += part.select("config", "worker", "source_index", "shard").collect()
        save_progress(H.progress_of(part, 10), path)
    assert sorted(map(tuple, parts)) == sorted(map(tuple, whole.collect()))


def test_progress_of_partial_full_and_stopped_runs(spark):
    rows = [("a", 0, i) for i in range(5)] + [("b", 0, i) for i in (1, 4, 9)]
    df = spark.createDataFrame(rows, SCHEMA)
    sizes = spark.createDataFrame([("a", 50), ("b", 60)], "config string, source_rows long")

    def state(limit=None, rows_per_shard=5):
        sharded = H.assign_shards(df, rows_per_shard)
        return {r.config: (r.completed_shards, r.streamed_consumed) for r in H.progress_of(
            sharded, rows_per_shard, sizes, limit).collect()}

    # A full shard ends at its last row; a partial one at the end of the source, unless the limit stopped the run.
    assert state() == {"a": (1, 5), "b": (1, 60)}
    assert state(limit=8) == {"a": (1, 5), "b": (1, 10)}
    assert state(limit=9) == {"a": (1, 5), "b": (1, 60)}
    assert state(rows_per_shard=4) == {"a": (2, 50), "b": (1, 60)}


def test_worker_split_counts_all_rows(spark):
    df = spark.range(10).withColumnRenamed("id", "source_index")
    split = filters.worker_split(df, 3)
    assert [r.worker for r in split.orderBy("source_index").collect()] == [i % 3 for i in range(10)]
    assert [r.source_index for r in filters.worker_split(df, 3, 1).orderBy("source_index").collect()] == [1, 4, 7]


@pytest.mark.parametrize("n", [0, 1, 19, 20, 21, 500])
def test_split_size_and_repeatability(spark, n):
    def test_rows(partitions):
        df = E.train_eval_split(spark.range(n).repartition(partitions))
        return {r.id for r in df.where("split = 'test'").collect()}, df.count()

    first, total = test_rows(1)
    assert len(first) == ceil(0.05 * n) and total == n
    assert test_rows(7) == (first, total)


def test_hash_split_is_near_its_ratio(spark):
    sizes = {r.split: r.rows for r in E.split_sizes(E.hash_split(spark.range(20000), 0.05)).collect()}
    assert abs(sizes["test"] - 1000) < 150 and sum(sizes.values()) == 20000


def test_pad_batches(spark):
    lengths = [3, 1, 4, 1, 5, 9, 2]
    rows = [(10 * i, list(range(1, n + 1)), [1] * n, list(range(1, n + 1))) for i, n in enumerate(lengths)]
    df = spark.createDataFrame(rows, "id long, input_ids array<int>, attention_mask array<int>, labels array<int>")
    got = E.pad_batches(df, 2, pad_id=0, bucket=F.floor(F.col("id") / 30)).orderBy("id").collect()
    longest = [3, 3, 4, 4, 9, 9, 2]
    for row, n, m, at in zip(got, lengths, longest, range(7)):
        assert row.batch_id == at // 2
        assert row.input_ids == list(range(1, n + 1)) + [0] * (m - n)
        assert row.attention_mask == [1] * n + [0] * (m - n)
        assert row.labels == list(range(1, n + 1)) + [-100] * (m - n)


def test_pad_batches_shuffles_arrays_without_sorting_them(spark):
    rows = [(i, [i] * (1 + i % 5), [1] * (1 + i % 5), [i] * (1 + i % 5)) for i in range(30)]
    df = spark.createDataFrame(rows, "id long, input_ids array<int>, attention_mask array<int>, labels array<int>")
    spark.conf.set("spark.sql.parquet.columnarReaderBatchSize", "4096")
    padded = E.pad_batches(df, 4, order="id")
    plan = padded._jdf.queryExecution().sparkPlan().toString()
    assert "ShuffledHashJoin" in plan and "BuildRight" in plan.split("ShuffledHashJoin")[1].split("\n")[0]
    assert int(spark.conf.get("spark.sql.parquet.columnarReaderBatchSize")) <= 256
    got = sorted((r.batch_id, r.id, len(r.input_ids)) for r in padded.collect())
    assert got == [(i // 4, i, max(1 + j % 5 for j in range(i // 4 * 4, min(30, i // 4 * 4 + 4)))) for i in range(30)]


def test_lookup_join_is_the_same_shuffled_and_broadcast(spark):
    rows = spark.range(600).withColumn("key", F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.col("id").cast("string")))
    table = spark.createDataFrame([("hot", 1), ("1", 2), ("unused", 3)], "key string, v int")
    small = lookup_join(rows, table, "key").collect()
    large = lookup_join(rows, table, "key", max_broadcast_bytes=2).collect()
    assert sorted(map(str, small)) == sorted(map(str, large)) and len(large) == 600
    assert sum(r.v == 1 for r in large) == 200


def test_split_is_exact_with_repeated_keys(spark):
    df = spark.range(400).select(F.when(F.col("id") < 300, F.lit("hot")).otherwise(F.col("id").cast("string")).alias("id"))
    for ratio in (0.01, 0.3, 0.5, 0.999, 1.0):
        sizes = {r.split: r.rows for r in E.split_sizes(E.train_eval_split(df.repartition(5), ratio)).collect()}
        assert sizes["test"] == -(-400 * round(ratio * 1000) // 1000)


def test_pad_batches_with_its_defaults_and_repeated_ids(spark):
    rows = [(None if i == 0 else f"k{i // 3}", [i] * (1 + i % 4), [1] * (1 + i % 4), [i] * (1 + i % 4)) for i in range(11)]
    df = spark.createDataFrame(rows, "id string, input_ids array<int>, attention_mask array<int>, labels array<int>")
    got = E.pad_batches(df).collect()
    assert sorted((str(r.id), r.input_ids[0]) for r in got) == sorted((str(r[0]), r[1][0]) for r in rows)
    batches = {}
    for r in got:
        batches.setdefault(r.batch_id, []).append(r)
        assert len(r.input_ids) == len(r.labels) == len(r.attention_mask) and sum(r.attention_mask) == 1 + r.labels[0] % 4
    assert sorted(map(len, batches.values())) == [1, 2, 2, 2, 2, 2]
    assert all(len({len(r.input_ids) for r in b}) == 1 for b in batches.values())
