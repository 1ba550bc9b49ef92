"""Mixing to target weights by iterative proportional fitting, in DataFrame operations only.

Tokens are summed up per cell, a combination of the axes' values. Each value of an axis has a target; what a value cannot give,
because it holds fewer tokens, is spread over the axis' other values beforehand. Cell weights are raked: per axis in turn a
factor for each value is set so that the axis' sums meet their targets, where a cell never weighs more than the tokens it
has. ``reached`` tells how near the sums came.

A document is sampled with its cell's weight over its cell's tokens as probability, by a hash of its id and text, so the
same row and seed give the same decision anywhere. Rows that repeat another's id and text draw by their place in the stored
table as well, each for itself.

Defined results. A null on an axis is a value like any other. Null and empty texts have no tokens; they take their
cell's probability, and a cell without tokens has probability 0. Rows without an id draw by their text. An empty table
gives an empty one. Columns of the input stay; results replace columns of their names.
"""

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from uttera.llm.common import WHITESPACE, spare, words
from uttera.operators.lookup import lookup_join
from uttera.session import materialize

AXES = ("source", "lang", "topic")
#: Target shares are the observed ones to this power, made to add up to one: small groups gain.
TEMPERATURES = {"source": 0.5, "lang": 0.7, "topic": 0.7}
BUDGET = 0.5
SWEEPS = 8
SEED = "mix"


def token_count(text: Column) -> Column:
    return F.size(words(text, WHITESPACE)).cast("long")


def topic_of(text: Column) -> Column:
    """A coarse kind of content from marks in the whole text; an address that was redacted still counts as one."""
    shown = F.coalesce(text, F.lit(""))
    return (
        F.when(shown.contains(" | "), "table")
        .when(shown.contains("License") | shown.contains("rights reserved"), "licensed")
        .when(shown.contains("@") | shown.contains("<EMAIL>") | shown.contains("<OBFUSCATED_EMAIL>"), "contact")
        .otherwise("prose")
    )


def draw(key: Column, mark: Column, copy: Column, seed: str = SEED) -> Column:
    """A number in [0, 1) from the first 32 bits of the MD5 of seed, key, the text's mark and the copy's number."""
    name = F.concat_ws(":", F.lit(seed), F.coalesce(key.cast("string"), F.lit("null")), mark, copy.cast("string"))
    return F.conv(F.substring(F.md5(name.cast("binary")), 1, 8), 16, 10).cast("long") / F.lit(4294967296.0)


def targets(cells: DataFrame, axis: str, power: float, budget: float) -> DataFrame:
    """Stored: (``axis``, held, goal), tokens to take from each value of an axis.

    Goals are the shares of the budget up to what a value holds. The level at which they add up to the budget is found by
    raising it until no further value is exhausted; a round is one sum over the axis' values.
    """
    share = F.pow(F.sum("tokens").cast("double"), F.lit(power))
    axes = materialize(cells.groupBy(axis).agg(F.sum("tokens").cast("double").alias("held"), share.alias("share")), "axis")
    held, shares = axes.agg(F.sum("held"), F.sum("share")).first()
    level = budget * held / shares if shares else 0.0
    while True:
        beyond = F.col("share") * level > F.col("held")
        full, rest = axes.agg(F.sum(F.when(beyond, F.col("held")).otherwise(0.0)), F.sum(F.when(beyond, 0.0).otherwise(F.col("share")))).first()
        if not rest or (budget * held - full) / rest <= level:
            break
        level = (budget * held - full) / rest
    return materialize(axes.select(axis, "held", F.least(F.col("share") * level, "held").alias("goal")), "targets")


def rake(cells: DataFrame, temperatures: dict[str, float] = TEMPERATURES, budget: float = BUDGET, sweeps: int = SWEEPS) -> DataFrame:
    """``cells`` (the axes, tokens), a stored table, with ``weight``: tokens to take.

    ``raw`` is what the factors make of a cell; it weighs that or, if it has fewer, its tokens. A step sums up one axis,
    joins the sums back and stores the cells, of which there are at most the product of the axes' numbers of values.
    """
    raked = cells.withColumn("raw", budget * F.col("tokens"))
    for axis, power in temperatures.items():
        goal = targets(cells, axis, power, budget).select(F.col(axis).alias("_value"), F.col("goal").alias(f"_{axis}_goal"))
        raked = raked.join(goal, raked[axis].eqNullSafe(goal["_value"])).drop("_value")
    raked = materialize(raked, "raked")
    weight = F.least("raw", F.col("tokens").cast("double"))
    for _ in range(sweeps):
        for axis in temperatures:
            held = raked.groupBy(F.col(axis).alias("_value")).agg(F.sum(weight).alias("_held"))
            raw = F.when(F.col("_held") > 0, F.col("raw") * F.col(f"_{axis}_goal") / F.col("_held")).otherwise(0.0)
            raked = materialize(raked.join(held, raked[axis].eqNullSafe(held["_value"])).withColumn("raw", raw).drop("_value", "_held"), "raked")
    return raked.select(*temperatures, "tokens", weight.alias("weight"))


def reached(raked: DataFrame, temperatures: dict[str, float] = TEMPERATURES, budget: float = BUDGET) -> DataFrame:
    """(axis, value, goal, weight): the targets of every axis and what the raked cells add up to, as shares of the budget."""
    parts = []
    for axis, power in temperatures.items():
        sums = raked.groupBy(F.col(axis).alias("_value")).agg(F.sum("weight").alias("weight"))
        goal = targets(raked, axis, power, budget)
        both = goal.join(sums, goal[axis].eqNullSafe(F.col("_value")))
        wanted = budget * (goal.agg(F.sum("held")).first()[0] or 0.0)
        parts.append(both.select(F.lit(axis).alias("axis"), F.col(axis).cast("string").alias("value"), *[F.try_divide(F.col(c), F.lit(wanted)).alias(c) for c in ("goal", "weight")]))
    return reduce(DataFrame.unionByName, parts)


def mix(
    docs: DataFrame,
    tokens: str = "n_tokens",
    key: str = "doc_id",
    mark: Column | None = None,
    temperatures: dict[str, float] = TEMPERATURES,
    budget: float = BUDGET,
) -> DataFrame:
    """Adds ``probability`` and ``sampled`` to the rows of a stored table that has the axes and their token counts.

    ``mark`` tells texts apart, by default the MD5 of the column ``text``.
    """
    mark = F.md5(F.coalesce("text", F.lit(""))) if mark is None else mark
    cells = materialize(docs.groupBy(*temperatures).agg(F.sum(tokens).alias("tokens")), "cells")
    rates = rake(cells, temperatures, budget)
    rate = F.when(F.col("tokens") > 0, F.round(F.col("weight") / F.col("tokens"), 6)).otherwise(0.0)
    own = {a: spare(docs, f"_{a}") for a in temperatures}
    rates = materialize(rates.select(*[F.col(a).alias(name) for a, name in own.items()], rate.alias("probability")), "rates")
    same = [docs[a].eqNullSafe(rates[name]) for a, name in own.items()]
    kind, stored, again = (spare(docs, name) for name in ("_kind", "_stored", "_again"))
    # Only rows that are there several times need a number to draw by; their kinds are few or folded before they are sent.
    kinds = docs.select(F.xxhash64(F.col(key), mark).alias(kind)).groupBy(kind).count().filter("count > 1")
    kinds = materialize(kinds.select(kind, F.lit(True).alias(again)), "kinds")
    numbered = docs.drop("probability").withColumns({kind: F.xxhash64(F.col(key), mark), stored: F.monotonically_increasing_id()})
    joined = lookup_join(numbered.join(rates, same).drop(*own.values()), kinds, kind)
    copy = F.when(F.col(again), F.col(stored)).otherwise(F.lit(0))
    return joined.withColumn("sampled", draw(F.col(key), mark, copy) < F.col("probability")).drop(kind, stored, again)
