"""Sources, inference, whole flows and streams."""

import re
import tracemalloc

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as Y

from registry.models import encode_and_return
from uttera import settings as S
from uttera.functions import text as T
from uttera.operators import examples as E
from uttera.operators import filters
from uttera.operators.infer import infer, quarantine
from uttera.operators.presets import speaker_presets, vector_means
from uttera.operators.shards import assign_shards
from uttera.plans.curation import Curation, Model, curate_corpus
from uttera.plans.training import training_set
from uttera.schemas import PROCESSED, RAW_UTTERANCE
from uttera.session import materialize, shared_dir
from uttera.sources.corpus import read_corpus, stream_corpus
from uttera.sources.progress import load_progress
from uttera.sources.shards import read_processed, write_shards
from uttera.streaming import flows as W


def test_read_corpus_prunes_configs_and_numbers_rows_across_files(spark, tmp_path):
    path = str(tmp_path / "corpus")
    rows = [("a" if i % 3 else "b", "train" if i < 80 else "dev", float(i)) for i in range(90)]
    df = spark.createDataFrame(rows, "config string, split string, duration double")
    df.orderBy("duration").repartitionByRange(4, "duration").write.partitionBy("config", "split").parquet(path)
    corpus = read_corpus(spark, path, ["a"], "train")
    assert corpus.columns == [*RAW_UTTERANCE.names, "config", "split"]
    plan = corpus.select("duration")._jdf.queryExecution().toString()
    pruned = re.search(r"DataFilters: \[\].*PartitionFilters: \[(.*?)\],", plan).group(1)
    assert "config" in pruned and "split" in pruned and "ReadSchema: struct<duration:double>" in plan
    indexed = read_corpus(spark, path, None, "train", indexed=True).collect()
    for config in "ab":
        mine = sorted((r.duration, r.source_index) for r in indexed if r.config == config)
        assert [i for _, i in mine] == list(range(len(mine))) and len(mine) > 20


def test_shards_are_replaced_by_name_and_bad_ones_skipped(spark, tmp_path):
    path = str(tmp_path / "shards")

    def shard(n, text):
        rows = [("c", 0, n, text)]
        full = spark.createDataFrame(rows, "config string, worker int, shard int, text string")
        missing = [F.lit(None).cast(f.dataType).alias(f.name) for f in PROCESSED.fields if f.name != "text"]
        write_shards(full.select("*", *missing), path)

    shard(0, "old"), shard(1, "kept"), shard(0, "new")
    assert sorted(r.text for r in read_processed(spark, path).collect()) == ["kept", "new"]
    broken = tmp_path / "shards" / "config=c" / "worker=0" / "shard=2"
    broken.mkdir()
    (broken / "part-0.parquet").write_bytes(b"PAR1 this is not a table PAR1")
    assert read_processed(spark, [path, str(tmp_path / "nothing")]).count() == 2
    with pytest.raises(RuntimeError):
        read_processed(spark, [str(tmp_path / "nothing")])
    with pytest.raises(RuntimeError):
        read_processed(spark, [])


def test_filters_on_edge_rows(spark):
    rows = [("Gujarati", "Gujarat", 1.0), ("gujarati", "Gujarat", 20.0), (" Gujarati", None, 0.999), (None, "x", 20.001),
            ("Gujarati", None, None), ("Gujarati", "Gujarat", float("nan"))]
    df = spark.createDataFrame(rows, "language string, state string, duration double")
    assert filters.language_is(df).count() == 3
    assert filters.state_is(df).count() == 3
    assert filters.state_is(df, value=None) is df
    kept = [r.duration for r in filters.duration_between(df).collect()]
    assert sorted(d for d in kept if d is not None) == [1.0, 20.0] and len(kept) == 3
    assert filters.transcript_valid(df, "state", drop_empty=False) is df


def test_shared_dir_is_the_sessions(spark):
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    assert shared_dir(spark) == named


LENGTHS = Y.StructType([Y.StructField("n", Y.IntegerType())])


def test_infer_isolates_failing_rows(spark, tmp_path):
    loads = str(tmp_path)

    def load():
        import tempfile

        tempfile.mkstemp(dir=loads)
        return {}

    def apply(model, batch):
        if (batch["text"] == "bad").any():
            raise ValueError("unreadable")
        return pd.DataFrame({"n": batch["text"].str.len().to_numpy()})

    rows = [(i, "bad" if i in (3, 50, 51) else "x" * (i % 5)) for i in range(200)]
    df = spark.createDataFrame(rows, "id int, text string").repartition(4, "id")
    out = infer(df, load, apply, LENGTHS, ["text"], ["id"], "hear", batch_rows=16)
    got = {r.id: (r.n, r.error) for r in out.collect()}
    assert got == {i: (None, "hear: unreadable") if t == "bad" else (len(t), None) for i, t in rows}
    assert len(list(tmp_path.iterdir())) == 4
    renamed = out.withColumnRenamed("n", "before").withColumn("text", F.lit("abc"))
    chained = {r.id: (r.before, r.n, r.error) for r in infer(renamed, load, apply, LENGTHS, ["text"], ["id", "before"]).collect()}
    assert chained == {i: (n, None, e) if e else (n, 3, None) for i, (n, e) in got.items()}
    done, rejected = quarantine(out)
    assert done.count() == 197 and {r.id for r in rejected.collect()} == {3, 50, 51}
    assert infer(df.where("id < 0"), load, apply, LENGTHS, ["text"], ["id"]).count() == 0


def load_nothing():
    return None


def hear(model, batch):
    texts = [bytes(np.asarray(a["array"]).astype(np.uint8)).decode("latin-1") for a in batch["audio"]]
    if any("!" in t for t in texts):
        raise ValueError("noise")
    return pd.DataFrame({"transcript": texts})


def encode(model, batch):
    arrays = [np.asarray(a["array"]) for a in batch["audio"]]
    if any(len(a) == 13 for a in arrays):
        raise ValueError("thirteen")
    tokens = [a.astype(np.int32) if a[0] != ord("z") else np.array([], dtype=np.int32) for a in arrays]
    return pd.DataFrame({"speech_tokens": tokens, "global_embedding": [np.float32([len(a), 1]) for a in arrays]})


SPEC = Curation(script="a-z", frame_length=4, hop=1, rows_per_shard=3, bucket_rows=8, batch_rows=4, min_silence_ms=20)


def raw(spark, n=120):
    words = ["hello there", "one\x00\x00\x00\x00\x00\x00\x00\x00two six", "bad!", "zero tokens", "thirteenchars", "123", "last one here"]
    rows = []
    for i in range(n):
        audio = None if i % 11 == 0 else ([float(b) for b in words[i % 7].encode("latin-1")], 100)
        rows.append((i, "c1" if i % 4 else "c2", str(i), f"s{i % 5}", "g", "d", "Gujarat", "Gujarati", 2.0 if i % 9 else 50.0, audio))
    schema = "source_index long, config string, " + ", ".join(
        f"{f.name} {f.dataType.simpleString()}" for f in RAW_UTTERANCE.fields
    )
    return spark.createDataFrame(rows, schema)


def accepted_by_hand(n=120):
    good = {0: "hello there", 1: "one two <pause> six"}
    return {f"{i}_s{i % 5}": good[i % 7] for i in range(n) if i % 11 and i % 9 and i % 7 in good}


def curate(spark, df, out, **options):
    return curate_corpus(df, Model(load_nothing, hear), Model(load_nothing, encode), out, spec=SPEC, **options)


def test_curation_flow(spark, tmp_path):
    out = str(tmp_path / "out")
    run = curate(spark, raw(spark), out, num_workers=2)
    stored = read_processed(spark, out)
    rows = stored.collect()
    assert {r.id: r.text for r in rows} == accepted_by_hand()
    assert {r.error for r in run.rejected.collect()} == {"transcribe: noise", "encode: thirteen"}
    assert max(stored.groupBy("config", "worker", "shard").count().toPandas()["count"]) == 3
    assert all(r.num_speech_tokens == len(r.speech_tokens) and r.transcript == r.text for r in rows)


def test_curation_dry_run_limit_and_resume(spark, tmp_path):
    df, out, progress = raw(spark), str(tmp_path / "out"), str(tmp_path / "progress")
    dry = curate(spark, df, out, dry_run=True)
    assert not (tmp_path / "out").exists()
    whole = {(r.id, r.config, r.shard) for r in dry.shards.collect()}
    assert curate(spark, df, out, dry_run=True, limit=4).shards.count() == 4
    for stop in (1, 3, None):
        curate(spark, df, out, progress=progress, max_shards=stop)
    assert {(r.id, r.config, r.shard) for r in read_processed(spark, out).collect()} == whole
    ends = {r.config: r.streamed_consumed for r in load_progress(spark, progress).collect()}
    assert set(ends) == {"c1", "c2"} and max(ends.values()) <= 120
    again = curate(spark, df, out, progress=progress)
    assert {(r.id, r.config, r.shard) for r in read_processed(spark, out).collect()} >= whole and again is not None


def test_curation_keeps_audio(spark, tmp_path):
    from dataclasses import replace

    run = curate_corpus(raw(spark, 20), Model(load_nothing, hear), Model(load_nothing, encode), str(tmp_path / "o"),
                        spec=replace(SPEC, keep_audio=True), dry_run=True)
    row = run.shards.orderBy("source_index").first()
    assert row.audio.sampling_rate == 100 and len(row.audio.array) == row.num_speech_tokens


def test_training_set(spark):
    rows = [(str(i), f"w{i % 7} common unseen{i}", list(range(i % 30))) for i in range(100)] + [("n", None, [1]), ("e", "", [1])]
    df = spark.createDataFrame(rows, "id string, text string, speech_tokens array<int>")
    vocab = E.vocabulary(spark.createDataFrame([("common w1 w2 w3",)], "text string"))
    m = E.Markers()
    made = training_set(df, vocab, max_seq_len=30)
    got = {r.id: r for part in (made.train, made.evaluation) for r in part.collect()}
    assert set(got) == {str(i) for i in range(100) if 0 < i % 30 <= 17}
    assert made.evaluation.count() == -(-len(got) // 20)
    for r in got.values():
        n = int(r.id) % 30
        assert r.labels == [-100] * 11 + [m.speech_base + t for t in range(n)] + [m.turn_end, m.newline]
        assert r.input_ids[11:] == r.labels[11:] and r.attention_mask == [1] * len(r.input_ids)
        assert r.input_ids[5] == m.unknown and r.input_ids[4] >= m.first_word
    salted = E.encode_examples(df, vocab, max_seq_len=30, max_broadcast_bytes=1)
    assert {r.id: r for r in salted.collect()} == got


def test_mask_examples_at_the_limit(spark):
    rows = [(1, [1, 2], [1, 2, 3, 4]), (2, [1, 2], [1, 2, 3, 4, 5]), (3, [1, 2], [1, 2]), (4, [7], [1, 2]), (5, [], [])]
    df = spark.createDataFrame(rows, "id int, prompt_ids array<int>, input_ids array<int>")
    got = {r.id: r.labels for r in E.mask_examples(df, max_seq_len=4, keep=("id",)).collect()}
    assert got == {1: [-100, -100, 3, 4], 4: [1, 2]}


def write_part(spark, path, lo, hi):
    rows = [(i, f"s{i % 3}", f"text {i}", [float(i % 4), 1.0, -2.0]) for i in range(lo, hi)]
    schema = "source_index long, config string, text string, v array<float>"
    spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(path)
    return schema


def test_streams_resume_where_they_stopped(spark, tmp_path):
    path, out, offsets = (str(tmp_path / n) for n in ("in", "out", "offsets"))
    transform = lambda df: df.where("source_index % 2 = 0").withColumn("text", T.clean_transcript(F.col("text")))
    for lo, hi in ((0, 20), (20, 50)):
        schema = write_part(spark, path, lo, hi)
        W.run_available(W.stream_curate(stream_corpus(spark, path, schema), transform, out, offsets))
        got = sorted(r.source_index for r in spark.read.parquet(out).collect())
        assert got == list(range(0, hi, 2))


def test_stream_shards_and_replayed_batches(spark, tmp_path):
    path, out, offsets = (str(tmp_path / n) for n in ("in", "out", "offsets"))
    for lo, hi in ((0, 20), (20, 50)):
        schema = write_part(spark, path, lo, hi)
        rows = stream_corpus(spark, path, schema).withColumn("worker", F.lit(0)).drop("v")
        W.run_available(W.stream_shards(rows, out, offsets, rows_per_shard=4))
    stored = spark.read.parquet(out).withColumn("name", W.batch_shard_name())
    assert sorted(r.source_index for r in stored.collect()) == list(range(50))
    assert stored.where("batch = 0").select("name").distinct().count() == 6
    # The second batch again, as after a crash before its end was recorded.
    batch = spark.read.schema(schema).parquet(path).where("source_index >= 20").withColumn("worker", F.lit(0)).drop("v")
    W.write_batch(batch, 1, out, f"{offsets}/rows", 4)
    assert spark.read.parquet(out).count() == 50
    # Over both batches the shards are those of one run.
    every = spark.read.schema(schema).parquet(path).withColumn("worker", F.lit(0))
    want = {(r.config, r.source_index): r.shard for r in assign_shards(every, 4).collect()}
    assert {(r.config, r.source_index): r.shard for r in spark.read.parquet(out).collect()} == want
    sizes = spark.read.parquet(out).groupBy("config", "shard").count().collect()
    assert sum(r["count"] < 4 for r in sizes) <= len({r.config for r in sizes})


def test_stream_presets_follow_the_batch_form(spark, tmp_path):
    path, out, offsets = (str(tmp_path / n) for n in ("in", "out", "offsets"))
    for lo, hi in ((0, 20), (20, 50), (50, 53)):
        schema = write_part(spark, path, lo, hi)
        rows = stream_corpus(spark, path, schema, files_per_batch=1)
        W.run_available(W.stream_means(rows, "config", "v", out, offsets))
    running = {r.speakerID: (r.n, r.embedding) for r in W.running_presets(spark, out, "config").collect()}
    whole = speaker_presets(spark.read.parquet(path), "config", "v").collect()
    assert running == {r.speakerID: (r.n, pytest.approx(r.embedding)) for r in whole}
    state = vector_means(stream_corpus(spark, path, schema), "config", "v")
    assert "Generate" not in state._jdf.queryExecution().analyzed().toString()


def test_running_sums_are_compacted(spark, tmp_path):
    path, out, offsets = (str(tmp_path / n) for n in ("in", "out", "offsets"))
    for lo in range(0, 50, 10):
        schema = write_part(spark, path, lo, lo + 10)
        rows = stream_corpus(spark, path, schema, files_per_batch=1)
        W.run_available(W.stream_means(rows, "config", "v", out, offsets, compact_every=2))
    stored = spark.read.parquet(out)
    # Batch 4 came after batches 0 to 3 were folded.
    assert sorted(r.part for r in stored.select("part").distinct().collect()) == [8, 9]
    whole = {r.speakerID: (r.n, pytest.approx(r.embedding)) for r in speaker_presets(spark.read.parquet(path), "config", "v").collect()}
    assert {r.speakerID: (r.n, r.embedding) for r in W.running_presets(spark, out, "config").collect()} == whole
    # A run lost after the folded part was written: what it left is only deleted.
    W._write_part(W.newest_means(stored, "config").withColumn("mean", F.array(F.lit(0.0))), 7, out)
    W.compact_means(spark, out, "config", 8)
    assert {r.speakerID: (r.n, r.embedding) for r in W.running_presets(spark, out, "config").collect()} == whole
    W.compact_means(spark, str(tmp_path / "none"), "config", 2)


HEARER, SPEAKER = Model(load_nothing, hear), Model(load_nothing, encode)


def test_command_line(spark, tmp_path, capsys):
    from uttera.__main__ import main

    corpus, out, progress = (str(tmp_path / n) for n in ("corpus", "out", "progress"))
    raw(spark).drop("source_index").withColumn("split", F.lit("train")).coalesce(1).write.partitionBy(
        "config", "split").parquet(corpus)
    base = ["curate", "--corpus", corpus, "--out", out, "--transcriber", "tests.test_flows:HEARER",
            "--encoder", "tests.test_flows:SPEAKER"]
    # The models write Latin text, which the default script does not accept: nothing is left.
    main([*base, "--no-push", "--limit", "3"], spark)
    assert "shard_name" in capsys.readouterr().out and not (tmp_path / "out").exists()

    df = raw(spark)
    curate(spark, df, out)
    (next((tmp_path / "out").rglob("*.parquet")).parent / "bad.parquet").write_text("broken")
    main(["presets", "--processed", out, "--out", str(tmp_path / "presets"), "--top", "2"], spark)
    said = capsys.readouterr().out
    assert "speakerID" in said and "skipped" in said and "bad.parquet" in said
    main(["training-set", "--processed", out, "--out", str(tmp_path / "set")], spark)
    made = sum(spark.read.parquet(str(tmp_path / "set" / part)).count() for part in ("train", "eval"))
    assert made == read_processed(spark, out).count() > 0
    first = str(tmp_path / "set" / "vocabulary")
    main(["training-set", "--processed", out, "--out", str(tmp_path / "more"), "--vocabulary", first], spark)
    assert sorted(spark.read.parquet(first).collect()) == sorted(spark.read.parquet(str(tmp_path / "more" / "vocabulary")).collect())
    requests = spark.createDataFrame([(1, "hi", "s1", None), (2, "hi", "nobody", None)],
                                     "request_id int, text string, speaker string, ref_embedding array<float>")
    requests.write.parquet(str(tmp_path / "requests"))
    main(["prompts", "--requests", str(tmp_path / "requests"), "--presets", str(tmp_path / "presets"),
          "--out", str(tmp_path / "prompts")], spark)
    got = {r.request_id: r.error for r in spark.read.parquet(str(tmp_path / "prompts")).collect()}
    assert got == {1: None, 2: "unknown speaker"}
    spark.createDataFrame([("<|s_3|>",), ("x",)], "generated string").write.parquet(str(tmp_path / "generated"))
    main(["parse", "--generated", str(tmp_path / "generated"), "--out", str(tmp_path / "parsed")], spark)
    assert {r.error for r in spark.read.parquet(str(tmp_path / "parsed")).collect()} == {None, "no speech tokens"}
    outputs = [("x", [[0.0, 1.0], [1.0, 0.0]], [-100, 1], 0.0), ("y", [[1.0, 0.0], [1.0, 0.0]], [-100, 1], 0.0)]
    spark.createDataFrame(outputs, "kind string, logits array<array<double>>, labels array<int>, loss double").write.parquet(str(tmp_path / "outputs"))
    main(["evaluate", "--outputs", str(tmp_path / "outputs"), "--out", str(tmp_path / "report"), "--by", "kind"], spark)
    assert {r.kind: r.audio_token_accuracy for r in spark.read.parquet(str(tmp_path / "report")).collect()} == {"x": 1.0, "y": 0.0}


def test_vocabularies_grow_at_their_end(spark):
    def words(*texts):
        return spark.createDataFrame([(t,) for t in texts], "text string")

    first = {r.word: r.word_id for r in E.vocabulary(words("a b c", "c d")).collect()}
    known = materialize(E.vocabulary(words("a b c", "c d")), "known")
    grown = {r.word: r.word_id for r in E.vocabulary(words("e a", "0 f e", None, ""), known=known).collect()}
    assert {w: grown[w] for w in first} == first and grown.keys() == set("abcdef0")
    assert sorted(grown.values()) == list(range(E.Markers().first_word, E.Markers().first_word + 7))
    assert {r.word: r.word_id for r in E.vocabulary(words("a"), known=known.limit(0)).collect()} == {"a": E.Markers().first_word}


def test_a_training_flow_stores_its_rows_once(spark):
    from uttera.plans.training import padded_batches, training_set
    from uttera.session import STORED

    rows = [(f"id{i % 5}", f"w{i} w{i % 3}", [i, i + 1]) for i in range(40)]
    df = spark.createDataFrame(rows, "id string, text string, speech_tokens array<int>").repartition(4)
    vocab = materialize(E.vocabulary(df), "vocabulary")
    before = len(STORED)
    made = training_set(df, vocab, eval_ratio=0.1)
    batches = padded_batches(made, 4)
    assert [name.rsplit("/", 1)[1].split("-")[0] for name in STORED[before:]] == ["rows"]
    assert [made.train.count(), made.evaluation.count()] == [36, 4] and {r.split: r.rows for r in made.sizes.collect()} == {"train": 36, "test": 4}
    assert sorted(len(b.input_ids) for b in batches[0].collect()) == [14] * 36 and batches[1].select("batch_id").distinct().count() == 1


def test_examples_of_repeated_ids_keep_their_own_words(spark):
    rows = [("None_S", "a b", [1]), ("None_S", "c d", [2]), (None, "b", [3]), ("None_S", "a b", [1])]
    df = spark.createDataFrame(rows, "id string, text string, speech_tokens array<int>")
    vocab = E.vocabulary(df)
    ids = {r.word: r.word_id for r in vocab.collect()}
    m = E.Markers()
    for bound in (1, 1 << 20):
        got = sorted((str(r.id), r.input_ids[3:-10 + 3], r.input_ids[-3] - m.speech_base)
                     for r in E.encode_examples(df, vocab, max_broadcast_bytes=bound).collect())
        want = sorted((str(i), [ids[w] for w in t.split()], s[0]) for i, t, s in rows)
        assert [(i, w[: len(x[1])], s) for (i, w, s), x in zip(got, want)] == want


def test_id_ranges_do_not_overlap(spark):
    with pytest.raises(ValueError):
        E.Markers(first_word=100)
    df = spark.createDataFrame([("1", "a", [S.TOKEN_RANGE])], "id string, text string, speech_tokens array<int>")
    with pytest.raises(Exception, match="outside the range"):
        E.encode_examples(df, E.vocabulary(df)).collect()


def counting(path, model):
    def apply(loaded, batch):
        with open(path, "a") as log:
            log.write(f"{len(batch)}\n")
        return model(loaded, batch)

    return apply


def test_a_limit_bounds_what_the_models_run_on(spark, tmp_path):
    df = raw(spark, 3000)
    # Slices of 64 and 256 rows are enough of the 3000; batches with a failing row are heard again in halves.
    for options in ({"limit": 8}, {"max_shards": 2}, {"limit": 8, "config_order": ["c2", "c1"]}, {}):
        log = tmp_path / "-".join(["log", *options])
        heard = Model(load_nothing, counting(str(log), hear))
        run = curate_corpus(df, heard, Model(load_nothing, encode), "", spec=SPEC, dry_run=True, **options)
        whole = curate_corpus(df, Model(load_nothing, hear), Model(load_nothing, encode), "", spec=SPEC, dry_run=True)
        got = {(r.config, r.source_index, r.shard) for r in run.shards.collect()}
        every = sorted((r.config, r.source_index, r.shard) for r in whole.shards.collect())
        if "max_shards" in options:
            every = [r for r in every if r[2] < 2]
        if "config_order" in options:
            every.sort(key=lambda r: (options["config_order"].index(r[0]), r[1]))
        assert got == set(every[: options.get("limit")])
        heard_rows = sum(map(int, log.read_text().split()))
        assert heard_rows <= 2 * (64 + 256) if options else heard_rows > 2000
        if not options:
            report = {r.config: (r.accepted, r.failed) for r in run.report().collect()}
            assert sum(a for a, _ in report.values()) == len(got) and all(f for _, f in report.values())


def test_a_funnel_adds_up(spark, tmp_path):
    for options in ({}, {"limit": 8}):
        run = curate(spark, raw(spark), "", dry_run=True, **options)
        funnel = run.funnel().first().asDict()
        assert funnel["seen"] == sum(n for name, n in funnel.items() if name != "seen") > 0
        assert funnel["dropped_transcribe"] + funnel["dropped_encode"] == run.rejected.count()
        assert funnel["accepted"] == run.shards.count() or options


def test_another_number_of_workers_is_refused(spark, tmp_path):
    out, progress = str(tmp_path / "out"), str(tmp_path / "progress")
    curate(spark, raw(spark), out, progress=progress, num_workers=3, worker_id=0, quarantine=str(tmp_path / "bad"))
    assert spark.read.parquet(str(tmp_path / "bad")).count() > 0
    with pytest.raises(ValueError, match="3 workers"):
        curate(spark, raw(spark), out, progress=progress, num_workers=2)


def test_unreadable_progress_is_not_a_first_run(spark, tmp_path):
    (tmp_path / "progress").mkdir()
    (tmp_path / "progress" / "part-0.parquet").write_text("broken")
    with pytest.raises(Exception):
        load_progress(spark, str(tmp_path / "progress")).collect()


def test_a_model_that_breaks_its_contract_fails_the_job(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b")], "id int, text string")
    for broken in (lambda m, b: pd.DataFrame({"other": [1] * len(b)}), lambda m, b: pd.DataFrame({"n": [1]})):
        with pytest.raises(Exception, match="are wanted"):
            infer(df.coalesce(1), load_nothing, broken, LENGTHS, ["text"], ["id"]).collect()


def test_stereo_is_averaged(spark):
    df = raw(spark)
    channels = F.transform("audio.array", lambda x: F.array(x - 2, x + 2))
    stereo = df.withColumn("audio", F.when(F.col("audio").isNotNull(), F.struct(channels.alias("array"), F.col("audio.sampling_rate").alias("sampling_rate"))))
    got = [curate(spark, d, "", dry_run=True).shards.select("id", "text", "speech_tokens").collect() for d in (df, stereo)]
    assert sorted(map(tuple, got[0])) == sorted(map(tuple, got[1])) and got[0]


def test_requests_without_text_and_turns_without_content(spark):
    from uttera.plans.synthesis import prepare_requests

    presets = spark.createDataFrame([("s", [1.0])], "speakerID string, embedding array<float>")
    asked = spark.createDataFrame([(1, None, "s", None), (2, "hi", "s", None)], "request_id int, text string, speaker string, ref_embedding array<float>")
    got = {r.request_id: r for r in prepare_requests(asked, presets).collect()}
    assert got[1].error == "no text" and got[1].prompt is None and got[2].error is None and "hi" in got[2].prompt
    shown = spark.range(1).select(T.chatml(T.build_messages(F.lit(None).cast("string"), F.lit("x"))).alias("c")).first().c
    assert shown.count("<|im_start|>") == 2


def test_ragged_vectors_are_an_error(spark):
    df = spark.createDataFrame([("s", [1.0, 2.0]), ("s", [1.0])], "speakerID string, global_embedding array<float>")
    with pytest.raises(Exception):
        speaker_presets(df).collect()


def test_skipped_files_are_named(spark, tmp_path):
    from uttera.sources.shards import skipped_files

    path = str(tmp_path / "shards")
    df = spark.createDataFrame([("c", 0, i, f"x{i}") for i in range(2)], "config string, worker int, shard int, id string")
    write_shards(df, path)
    broken = tmp_path / "shards" / "config=c" / "worker=0" / "shard=1" / "part-bad.parquet"
    broken.write_text("broken")
    assert [r.path.rsplit("/", 1)[1] for r in skipped_files(spark, path).collect()] == ["part-bad.parquet"]


def test_shards_that_share_a_folder_are_replaced_one_by_one(spark, tmp_path):
    path = str(tmp_path / "shards")

    def rows(shards, mark):
        listed = [("c", w, s, f"{mark}{i}") for s in shards for w in (0, 1) for i in range(3)]
        return spark.createDataFrame(listed, "config string, worker int, shard int, id string")

    for shards, mark in ((range(6), "a"), ([5, 6], "b"), ([9], "c"), ([5], "d")):
        write_shards(rows(shards, mark), path, per_folder=4)
    got = {(r.worker, r.shard): set() for r in read_processed(spark, path).collect()}
    for r in read_processed(spark, path).collect():
        got[r.worker, r.shard].add(r.id[0])
    marks = dict.fromkeys(range(5), "a") | {5: "d", 6: "b", 9: "c"}
    assert got == {(w, s): {m} for s, m in marks.items() for w in (0, 1)}
    assert read_processed(spark, path).count() == 2 * 3 * len(marks)
    assert {p.name for p in (tmp_path / "shards" / "config=c" / "worker=0").iterdir()} == {"shards=0", "shards=1", "shards=2"}


def test_stored_folders_are_discarded(spark):
    from pathlib import Path

    from uttera.session import STORED, discard, discard_since, materialize

    mark = len(STORED)
    kept = [materialize(spark.range(n), "stage") for n in (3, 4, 5)]
    discard_since(spark, mark)
    assert len(STORED) == mark + 1 and kept[-1].count() == 5
    assert not any(Path(p.inputFiles()[0].removeprefix("file://")).exists() for p in kept[:-1])
    materialize(spark.range(3), "gone")
    path = STORED.pop()
    assert Path(path.removeprefix("file:")).exists()
    discard(spark, path)
    assert not Path(path.removeprefix("file:")).exists()


def test_models_get_rows_in_bounded_batches(spark):
    """Also where the session allows Spark's own ten thousand rows and 64 MB; a batch of the model's stays whole."""
    made = Y.StructType([Y.StructField("n", Y.LongType())])

    def count(model, batch):
        return pd.DataFrame({"n": [len(batch)] * len(batch)})

    df = spark.range(0, 1000, 1, 1)
    for rows, sizes in ((64, {64, 40}), (300, {300, 100})):
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "10000")
        spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", "67108864")
        got = {r.n for r in infer(df, dict, count, made, ["id"], ["id"], batch_rows=rows).collect()}
        assert got == sizes
        assert int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")) <= max(256, rows)
        assert int(spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch").rstrip("b")) <= 16 << 20


def test_a_returned_signal_takes_no_more_than_a_few_times_its_bytes():
    """With its samples in a list it took nine times."""
    signals = [np.arange(200_000, dtype=np.float32) + i for i in range(4)]
    batch = pd.DataFrame({"audio": [{"array": s, "sampling_rate": 16000} for s in signals]})
    tracemalloc.start()
    made = encode_and_return({"range": S.TOKEN_RANGE}, batch)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 4 * sum(s.nbytes for s in signals)
    for i, row in enumerate(made.itertuples()):
        assert row.speech_tokens.tolist() == [(x + i + 32) % S.TOKEN_RANGE for x in range(200_000)]
        assert row.global_embedding.tolist() == [200_000, 199_999 + i]
        assert np.array_equal(row.audio["array"], signals[i]) and row.audio["sampling_rate"] == 8000
