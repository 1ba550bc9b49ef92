"""The corpus manifest: an index that files appearing later do not shift, and scans of only the files that are wanted."""

from pathlib import Path

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import types as T

from uttera.operators.ranking import with_source_index
from uttera.plans.curation import Curation, Model, curate_corpus
from uttera.sources.manifest import IndexedCorpus, open_corpus
from uttera.sources.shards import read_processed

SCHEMA = T.StructType([
    T.StructField("UtteranceSequenceID", T.StringType()), T.StructField("speakerID", T.StringType()), T.StructField("gender", T.StringType()),
    T.StructField("district", T.StringType()), T.StructField("state", T.StringType()), T.StructField("language", T.StringType()),
    T.StructField("duration", T.DoubleType()),
    T.StructField("audio", T.StructType([T.StructField("array", T.ArrayType(T.FloatType())), T.StructField("sampling_rate", T.IntegerType())])),
])
SPEC = Curation(language="la", state=None, keep_class="a-z ", script="a-z", pauses_enabled=False, rows_per_shard=5)


def load():
    return None


def transcribe(_, batch):
    return pd.DataFrame({"transcript": ["row " + "abcdefghij"[int(a["array"][0]) % 10] for a in batch["audio"]]})


def encode(_, batch):
    return pd.DataFrame({"speech_tokens": [np.array([1, 2], np.int32) for _ in batch["audio"]], "global_embedding": [np.array([0.5], np.float32)] * len(batch)})


MODELS = Model(load, transcribe), Model(load, encode)


def put(spark, root, config, name, ids, split="train"):
    """One file of a chosen name."""
    rows = [(str(i), "s", "f", "d", "st", "la" if i % 3 else "other", 2.0, ([float(i)] * 4, 16000)) for i in ids]
    folder = Path(root) / f"split={split}" / f"config={config}"
    folder.mkdir(parents=True, exist_ok=True)
    made = Path(root).parent / f"made-{config}-{name}-{split}"
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.parquet(str(made))
    (folder / f"{name}.parquet").write_bytes(next(made.glob("part-*.parquet")).read_bytes())


def ids_of(df):
    return sorted(r["id"] for r in df.select("id").collect())


def accepted(ids):
    return sorted(f"{i}_s" for i in ids if i % 3)


def test_index_is_that_of_the_whole_table(spark, tmp_path):
    root = tmp_path / "a b%c"
    for config, name, ids in (("x", "b", range(10)), ("x", "a", range(10, 25)), ("y z", "c", range(25, 30))):
        put(spark, root, config, name, ids)
    put(spark, root, "x", "a", range(100, 110), split="test")
    corpus = open_corpus(spark, str(root), str(tmp_path / "files"), split="train", schema=SCHEMA)
    got = {(r["config"], r["source_index"]): r["UtteranceSequenceID"] for r in corpus.rows().collect()}
    whole = with_source_index(spark.read.schema(T.StructType([*SCHEMA.fields, T.StructField("config", T.StringType())])).parquet(str(root)).where("split = 'train'"), by="config")
    assert got == {(r["config"], r["source_index"]): r["UtteranceSequenceID"] for r in whole.collect()}
    assert {r["config"]: r["source_rows"] for r in corpus.sizes().collect()} == {"x": 25, "y z": 5}
    part = open_corpus(spark, str(root), str(tmp_path / "one"), ["y z"], "train", SCHEMA)
    assert sorted(r["source_index"] for r in part.rows(2, 4).collect()) == [2, 3]
    assert part.manifest().select("config").distinct().count() == 1


def test_later_files_do_not_shift_the_index(spark, tmp_path):
    root, files = tmp_path / "corpus", str(tmp_path / "files")
    put(spark, root, "x", "m", range(6))
    first = {r["UtteranceSequenceID"]: r["source_index"] for r in open_corpus(spark, str(root), files, split="train", schema=SCHEMA).rows().collect()}
    put(spark, root, "x", "a", range(6, 9))
    put(spark, root, "x", "z", range(9, 11))
    again = {r["UtteranceSequenceID"]: r["source_index"] for r in open_corpus(spark, str(root), files, split="train", schema=SCHEMA).rows().collect()}
    assert {k: again[k] for k in first} == first
    assert sorted(again.values()) == list(range(11))
    assert again["6"] == 6


def test_a_small_range_opens_few_files(spark, tmp_path):
    root = tmp_path / "corpus"
    for n in range(40):
        put(spark, root, "x", f"f{n:03}", range(10 * n, 10 * n + 10))
    # Whatever would be opened beyond the first files cannot be read.
    for n in range(20, 40):
        (root / "split=train" / "config=x" / f"f{n:03}.parquet").write_bytes(b"no parquet")
    corpus = open_corpus(spark, str(root), str(tmp_path / "files"), split="train", schema=SCHEMA)
    assert corpus.rows(0, 30).count() == 30
    assert corpus.manifest().count() == 4
    run = curate_corpus(corpus, *MODELS, "", spec=SPEC, limit=8, dry_run=True)
    assert ids_of(run.shards) == accepted(range(12))
    assert corpus.manifest().count() == 8
    assert curate_corpus(corpus, *MODELS, "", spec=SPEC, max_shards=2, dry_run=True).shards.count() == 10


@pytest.mark.parametrize("limit", [None, 7])
def test_a_resumed_run_takes_new_files_once(spark, tmp_path, limit):
    root, out, progress, files = (str(tmp_path / n) for n in ("corpus", "out", "progress", "files"))

    def run():
        corpus = open_corpus(spark, root, files, split="train", schema=SCHEMA)
        curate_corpus(corpus, *MODELS, out, progress=progress, spec=SPEC, limit=limit)

    put(spark, root, "x", "m", range(20))
    put(spark, root, "y", "m", range(100, 110))
    run()
    put(spark, root, "x", "a", range(20, 33))
    put(spark, root, "z", "a", range(200, 204))
    for _ in range(5 if limit else 1):
        run()
    assert ids_of(read_processed(spark, out)) == accepted([*range(33), *range(100, 110), *range(200, 204)])


def test_odd_corpora(spark, tmp_path):
    root = tmp_path / "corpus"
    put(spark, root, "x", "empty", [])
    corpus = open_corpus(spark, str(root), str(tmp_path / "files"), split="train", schema=SCHEMA)
    assert corpus.rows().collect() == [] and corpus.rows(3, 9).collect() == []
    assert curate_corpus(corpus, *MODELS, "", spec=SPEC, limit=3, dry_run=True).shards.collect() == []
    mixed = str(tmp_path / "mixed")
    spark.createDataFrame([("1", "a"), ("2", "b")], "id string, config string").coalesce(1).write.parquet(mixed)
    with pytest.raises(ValueError):
        IndexedCorpus(spark.read.parquet(mixed), str(tmp_path / "mixed_files")).rows()


def test_two_runs_that_extend_at_once_are_noticed(spark, tmp_path):
    root, files = tmp_path / "corpus", str(tmp_path / "files")
    put(spark, root, "x", "a", range(3))
    corpus = open_corpus(spark, str(root), files, split="train", schema=SCHEMA)
    pending = corpus._pending()
    corpus.extend()
    with pytest.raises(RuntimeError):
        corpus._enter(pending, 1)
