"""Model output to one report."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from uttera.functions import arrays as A
from uttera.operators import evaluate as E


def evaluation_report(
    outputs: DataFrame, logits: str = "logits", labels: str = "labels", loss: str = "loss", by: tuple[str, ...] = ()
) -> DataFrame:
    """Token accuracy of the best-scored tokens and perplexity of the losses, per ``by`` or in all."""
    best = outputs.select(*by, A.argmax_each(F.col(logits)).alias("preds"), labels)
    accuracy = E.token_accuracy(best, by, labels=labels)
    perplexity = E.perplexity(outputs, loss, by)
    if by:
        same = [accuracy[b].eqNullSafe(perplexity[b]) for b in by]
        return accuracy.join(perplexity, same).select(accuracy["*"], "eval_perplexity")
    # One row each.
    return accuracy.withColumn("eval_perplexity", perplexity.scalar())
