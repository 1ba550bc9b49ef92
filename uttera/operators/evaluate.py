"""Scores of model output."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from uttera import settings as S
from uttera.functions.sums import exact_mean


def argmax_pred(logits: DataFrame, keys: list[str], token: str = "token", logit: str = "logit") -> DataFrame:
    """Best token per position of a long table (keys, token, logit); ties go to the lowest token."""
    best = F.max_by(F.col(token), F.struct(F.col(logit), -F.col(token)))
    return logits.groupBy(*keys).agg(best.cast("int").alias("pred"))


def token_accuracy(
    pairs: DataFrame,
    by: tuple[str, ...] = (),
    preds: str = "preds",
    labels: str = "labels",
    ignored: int = S.IGNORED_LABEL,
) -> DataFrame:
    """Shifted next-token accuracy over scored positions, 0.0 when there are none.

    The prediction at t is compared with the label at t + 1. Positions are exploded and counted in the same stage:
    each task sends its two counts per group.
    """
    positions = pairs.select(*by, labels, F.posexplode_outer(preds).alias("_at", "_pred"))
    target = F.try_element_at(labels, (F.col("_at") + 2).cast("int"))
    scored = F.coalesce(target != ignored, F.lit(False))
    totals = positions.groupBy(*by).agg(
        F.count_if(scored & (F.col("_pred") == target)).alias("correct"), F.count_if(scored).alias("scored")
    )
    accuracy = F.when(F.col("scored") > 0, F.col("correct") / F.col("scored")).otherwise(F.lit(0.0))
    return totals.withColumn("audio_token_accuracy", accuracy)


def perplexity(losses: DataFrame, loss: str = "loss", by: tuple[str, ...] = ()) -> DataFrame:
    """exp of the mean loss, which no partitioning changes; infinite on overflow, null without a loss."""
    return losses.groupBy(*by).agg(F.exp(exact_mean(F.col(loss))).alias("eval_perplexity"))
