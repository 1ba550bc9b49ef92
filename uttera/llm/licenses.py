"""License scan by diagonal voting, in DataFrame operations only.

All rolling word pairs of a text are hashed and joined with the pairs of the templates. A hit votes for its template's
diagonal, the pair's place in the text less its place in the template. The words themselves are compared at each hit, so
no vote rests on a hash alone. A phrase stands at a diagonal that has all its votes. For templates, diagonals no more than
``GAP`` apart are merged, so a few words put in or left out cost only their own votes.

Defined results. Null and empty texts have no words and score 0. Every row gives a row, whatever its id; repeated rows
repeat. Other columns are not read. A text of one word has no pair.
"""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from uttera.functions.binding import let
from uttera.llm.common import PUNCTUATION, ascii_lower, words

# Phrases whose every place counts, and template sentences that are matched with gaps, with their labels.
PHRASES = {
    "cc by": "cc-by",
    "general public license": "gpl",
    "all rights reserved": "reserved",
}
TEMPLATES = {
    "licensed under the apache license version 2 0": "apache-2.0",
    "released under the mit license": "mit",
    "permission is hereby granted free of charge to any person obtaining a copy of this software": "mit",
    "this work is licensed under the gnu general public license version 3": "gpl-3.0",
    "licensed under cc by nc 4 0": "cc-by-nc",
    "licensed under cc by sa 4 0": "cc-by-sa",
    "licensed under cc by 4 0": "cc-by",
    "redistribution and use in source and binary forms with or without modification are permitted": "bsd",
    "subject to the terms of the mozilla public license": "mpl",
    "this is free and unencumbered software released into the public domain": "unlicense",
}
GAP = 2
#: Share of a template's pairs that its merged diagonals must hold.
COVERAGE = 0.8
#: Stands before a text's pairs and joins with a row of its own, so that texts without a hit come through the join.
MARKER = -1


def template_pairs(spark: SparkSession) -> DataFrame:
    """One row per word pair of each phrase and template, and the marker; bounded by the constants above."""
    rows = []
    for phrase, source in ((True, PHRASES), (False, TEMPLATES)):
        for sentence, label in source.items():
            split = sentence.split()
            rows += [(a, b, f"{sentence}/{phrase}", at, len(split) - 1, phrase, label) for at, (a, b) in enumerate(zip(split, split[1:], strict=False))]
    rows.append((None, None, "", 0, 0, False, None))
    kinds = {"first": "string", "second": "string", "template": "string", "at": "int", "pairs": "int", "phrase": "boolean", "label": "string"}
    literal = F.array(*[F.struct(*[F.lit(v).cast(kind).alias(name) for v, (name, kind) in zip(row, kinds.items(), strict=True)]) for row in rows])
    pairs = spark.range(1).select(F.explode(literal).alias("row")).select("row.*")
    marked = F.when(F.col("template") == "", F.lit(MARKER).cast("long")).otherwise(F.xxhash64("first", "second"))
    return pairs.withColumn("h", marked)


def pair_hashes(found: Column) -> Column:
    places = F.sequence(F.lit(0), F.size(found) - 2)
    hashes = F.transform(places, lambda i: F.xxhash64(F.get(found, i), F.get(found, i + 1)))
    marker = F.array(F.lit(MARKER).cast("long"))
    return F.when(F.size(found) >= 2, F.concat(marker, hashes)).otherwise(marker)


def votes(docs: DataFrame, key: str, text: str) -> DataFrame:
    """Verified hits by row, template and diagonal; per row one more, with an empty template."""
    both = let(words(ascii_lower(F.col(text)), PUNCTUATION), lambda w: F.struct(w.alias("words"), pair_hashes(w).alias("hashes")))
    read = docs.select(F.col(key).alias("key"), F.monotonically_increasing_id().alias("row"), both.alias("t"))
    read = read.select("key", "row", F.col("t.words").alias("words"), F.size("t.words").alias("n_words"), F.posexplode("t.hashes").alias("pos", "h"))
    hits = read.join(F.broadcast(template_pairs(docs.sparkSession)), "h")
    real = (F.col("template") != "") & (F.col("pos") > 0)
    same = (F.get("words", F.col("pos") - 1) == F.col("first")) & (F.get("words", F.col("pos")) == F.col("second"))
    hits = hits.filter((~real & (F.col("template") == "") & (F.col("pos") == 0)) | (real & same))
    diagonal = (F.col("pos") - 1 - F.col("at")).alias("diagonal")
    hits = hits.select("key", "row", "n_words", "template", "pairs", "phrase", "label", diagonal, "at")
    return hits.groupBy("key", "row", "n_words", "template", "pairs", "phrase", "label", "diagonal").agg(F.collect_set("at").alias("ats"))


def scan(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """A row per row: word count, phrase places with their first and last word, labels and the best coverage."""
    by_row = Window.partitionBy("key", "row", "template").orderBy("diagonal")
    placed = votes(docs, key, text)
    apart = F.coalesce((F.col("diagonal") - F.lag("diagonal").over(by_row) > GAP).cast("int"), F.lit(0))
    merged = placed.withColumn("apart", apart).withColumn("region", F.when(~F.col("phrase"), F.sum("apart").over(by_row)).otherwise(F.col("diagonal")))
    region = ["key", "row", "n_words", "template", "pairs", "phrase", "label", "region"]
    spans = merged.groupBy(*region).agg(F.size(F.array_distinct(F.flatten(F.collect_list("ats")))).alias("held"), F.min("diagonal").alias("start"))
    spans = spans.withColumn("cover", F.when(F.col("pairs") > 0, F.col("held") / F.col("pairs")).otherwise(0.0))
    stands = F.col("phrase") & (F.col("held") == F.col("pairs"))
    labelled = stands | (~F.col("phrase") & (F.col("cover") >= COVERAGE))
    base, every = F.collect_set(F.when(stands, F.col("label"))), F.collect_set(F.when(labelled, F.col("label")))
    found = spans.groupBy("key", "row").agg(
        F.max("n_words").cast("long").alias("n_words"),
        F.count(F.when(stands, 1)).alias("n_base"),
        F.min(F.when(stands, F.col("start"))).cast("long").alias("first_word"),
        F.max(F.when(stands, F.col("start"))).cast("long").alias("last_word"),
        F.array_join(F.sort_array(base), ",").alias("base_labels"),
        F.array_join(F.sort_array(every), ",").alias("labels"),
        F.round(F.max("cover"), 6).alias("score"),
    )
    return found.drop("row").withColumnRenamed("key", key)
