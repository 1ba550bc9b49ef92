"""Vocabulary ids and training examples."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from registry import tables as R
from registry.base import collector
from uttera import settings as S
from uttera.operators import examples as E
from uttera.plans.training import padded_batches, training_set
from uttera.session import materialize

query, QUERIES, ORACLES = collector()

M = E.Markers()
VOCAB = f"""vocab AS (SELECT word, CAST({M.first_word} + row_number() OVER (ORDER BY md5(word)) - 1 AS BIGINT) AS word_id
  FROM (SELECT DISTINCT unnest({R.sql_words('text')}) AS word FROM conversations)
  WHERE word <> '')"""
WORD_IDS = f"""pieces AS (SELECT id, unnest(w) AS word, generate_subscripts(w, 1) AS pos
    FROM (SELECT id, {R.sql_words('text')} AS w FROM pairs)),
  word_ids AS (SELECT p.id, list(coalesce(v.word_id, {M.unknown}) ORDER BY p.pos) AS ids
    FROM pieces p LEFT JOIN vocab v ON v.word = p.word GROUP BY p.id)"""


def vocab(spark: SparkSession, sf: str) -> DataFrame:
    """The words of all turns."""
    return materialize(E.vocabulary(R.table(spark, sf, "conversations")), "vocabulary")


@query("vocabulary", f"WITH {VOCAB} SELECT word, word_id FROM vocab")
def vocabulary(spark: SparkSession, sf: str) -> DataFrame:
    return vocab(spark, sf)


@query("extend_vocabulary", f"""WITH {VOCAB}, new AS (SELECT DISTINCT unnest({R.sql_words('text')}) AS word FROM documents),
  more AS (SELECT word, CAST((SELECT coalesce(max(word_id) + 1, {M.first_word}) FROM vocab) + row_number() OVER (ORDER BY md5(word)) - 1
    AS BIGINT) AS word_id FROM new WHERE word <> '' AND word NOT IN (SELECT word FROM vocab))
  SELECT * FROM vocab UNION ALL SELECT * FROM more""")
def extend_vocabulary(spark: SparkSession, sf: str) -> DataFrame:
    """The documents' words after those of the turns, whose ids stay."""
    return E.vocabulary(R.table(spark, sf, "documents"), known=vocab(spark, sf))


@query("encode_ids", f"WITH {R.PAIRS}, {VOCAB}, {WORD_IDS} SELECT id, {R.sql_joined('ids')} AS word_ids FROM word_ids")
def encode_ids(spark: SparkSession, sf: str) -> DataFrame:
    encoded = E.encode_words(R.pairs(spark, sf).select("id", "text"), vocab(spark, sf))
    return encoded.select("id", R.joined("word_ids").alias("word_ids"))


EXAMPLES = f"""{R.PAIRS}, {VOCAB}, {WORD_IDS}, prompts AS (
    SELECT p.id, [{M.turn_start}, {M.user}, {M.newline}] || w.ids
        || [{M.turn_end}, {M.newline}, {M.turn_start}, {M.assistant}, {M.newline}] AS prompt,
      list_transform({R.sql_tokens('p.answer')}, lambda t: t + {M.speech_base})
        || [{M.turn_end}, {M.newline}] AS answered
    FROM pairs p JOIN word_ids w ON w.id = p.id WHERE p.text <> '' AND length(p.answer) > 0),
  examples AS (SELECT id, prompt || answered AS input_ids,
      list_transform(prompt, lambda x: {S.IGNORED_LABEL}) || answered AS labels
    FROM prompts WHERE len(prompt) + len(answered) <= {S.MAX_SEQ_LEN})"""


def spoken_pairs(spark: SparkSession, sf: str) -> DataFrame:
    return R.pairs(spark, sf).select("id", "text", R.tokens("answer").alias("speech_tokens"))


@query("encode_examples", f"""WITH {EXAMPLES} SELECT id, {R.sql_joined('input_ids')} AS input_ids,
    {R.sql_joined('labels')} AS labels, len(input_ids) AS attended FROM examples""")
def encode_examples(spark: SparkSession, sf: str) -> DataFrame:
    examples = E.encode_examples(spoken_pairs(spark, sf), vocab(spark, sf))
    attended = F.aggregate("attention_mask", F.lit(0), lambda a, x: a + x).cast("bigint")
    return examples.select(
        "id", R.joined("input_ids").alias("input_ids"), R.joined("labels").alias("labels"), attended.alias("attended")
    )


@query("training_set", f"""WITH {EXAMPLES} SELECT id, len(input_ids) AS n, CASE WHEN row_number() OVER (
    ORDER BY md5('{S.SEED}:' || id)) <= ceil(CAST({S.EVAL_RATIO} AS DOUBLE) * count(*) OVER ())
    THEN 'test' ELSE 'train' END AS split FROM examples""")
def whole_training_set(spark: SparkSession, sf: str) -> DataFrame:
    made = training_set(spoken_pairs(spark, sf), vocab(spark, sf))
    train = made.train.withColumn("split", F.lit("train"))
    both = train.unionByName(made.evaluation.withColumn("split", F.lit("test")))
    return both.select("id", F.size("input_ids").cast("bigint").alias("n"), "split")


BATCH = 4


@query("training_batches", f"""WITH {EXAMPLES}, split AS (SELECT *, row_number() OVER (ORDER BY md5('{S.SEED}:' || id))
      > ceil(CAST({S.EVAL_RATIO} AS DOUBLE) * count(*) OVER ()) AS train FROM examples),
  placed AS (SELECT *, (row_number() OVER (ORDER BY md5(id), id) - 1) // {BATCH} AS batch_id FROM split WHERE train),
  longest AS (SELECT *, max(len(input_ids)) OVER (PARTITION BY batch_id) - len(input_ids) AS pad FROM placed)
  SELECT batch_id, id, md5({R.sql_joined("input_ids || list_transform(range(pad), lambda x: 0)")}) AS ids,
    md5({R.sql_joined(f"labels || list_transform(range(pad), lambda x: {S.IGNORED_LABEL})")}) AS labels,
    len(input_ids) AS attended FROM longest""")
def training_batches(spark: SparkSession, sf: str) -> DataFrame:
    """Pairs to padded training batches in one flow."""
    train, _ = padded_batches(training_set(spoken_pairs(spark, sf), vocab(spark, sf)), BATCH)
    return train.select(
        "batch_id",
        "id",
        F.md5(R.joined("input_ids")).alias("ids"),
        F.md5(R.joined("labels")).alias("labels"),
        F.aggregate("attention_mask", F.lit(0), lambda a, x: a + x).cast("bigint").alias("attended"),
    )
