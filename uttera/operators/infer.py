"""Distributed batch inference with a caller's model, and the rows it fails on."""

from collections.abc import Callable, Iterator
from typing import Any

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from uttera import settings as S
from uttera.session import bound_batches, materialize


def infer(
    df: DataFrame,
    load: Callable[[], Any],
    apply: Callable[[Any, pd.DataFrame], pd.DataFrame],
    outputs: T.StructType,
    inputs: list[str],
    keep: list[str],
    stage: str = "infer",
    batch_rows: int = 64,
) -> DataFrame:
    """Add the ``outputs`` columns that ``apply(model, batch)`` returns for the ``inputs`` columns, and ``error``.

    ``load`` runs once per task. ``apply`` sees up to ``batch_rows`` rows; if it raises, the batch is repeated in
    halves, so that only the failing rows end up with an ``error`` and null outputs. Wrong columns or a wrong number of
    rows fail the job. Rows that an earlier stage gave an error
    pass through untouched. Rows reach Python a few of these batches at a time, bounded in bytes. ``keep`` lists the columns to carry along: select no more than is needed, since they all
    cross into Python.
    """
    bound_batches(df.sparkSession, batch_rows * max(1, S.MODEL_ROWS // batch_rows), S.MODEL_BYTES)
    chained = "error" in df.columns
    carried = [c for c in dict.fromkeys([*keep, *inputs]) if c != "error"]
    names = [f.name for f in outputs.fields]
    kept_fields = [df.schema[c] for c in keep if c != "error"]
    result = T.StructType([*kept_fields, *outputs.fields, T.StructField("error", T.StringType())])
    columns = [f.name for f in result.fields]

    def run(model: Any, batch: pd.DataFrame) -> tuple[pd.DataFrame, list[str | None]]:
        try:
            made = apply(model, batch[inputs])
        except Exception as failure:
            if len(batch) == 1:
                empty = pd.DataFrame({n: [None] for n in names}, index=batch.index, dtype=object)
                return empty, [f"{stage}: {failure}"]
        else:
            # A function that breaks its contract fails the job: its rows are not at fault.
            if len(made) != len(batch) or not set(names) <= set(made.columns):
                got = f"{len(made)} rows of {sorted(made.columns)}"
                raise TypeError(f"{stage} returned {got} for {len(batch)} rows; {sorted(names)} are wanted")
            return made[names].set_axis(batch.index), [None] * len(batch)
        half = len(batch) // 2
        first, first_errors = run(model, batch.iloc[:half])
        second, second_errors = run(model, batch.iloc[half:])
        return pd.concat([first.astype(object), second.astype(object)]), first_errors + second_errors

    def task(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = None
        loaded = False
        for arrived in batches:
            for first in range(0, len(arrived), batch_rows):
                batch = arrived.iloc[first : first + batch_rows].reset_index(drop=True)
                todo = batch[batch["error"].isna()] if chained else batch
                done = batch.reindex(columns=[c for c in columns if c not in names and c != "error"])
                done["error"] = batch["error"] if chained else None
                for name in names:
                    done[name] = pd.Series([None] * len(batch), dtype=object)
                if len(todo):
                    if not loaded:
                        model, loaded = load(), True
                    made, errors = run(model, todo)
                    for name in names:
                        done.loc[todo.index, name] = pd.Series(list(made[name]), index=todo.index, dtype=object)
                    done.loc[todo.index, "error"] = pd.Series(errors, index=todo.index, dtype=object)
                yield done[columns]

    selected = [*carried, "error"] if chained else carried
    return df.select(*selected).mapInPandas(task, result)


def quarantine(inferred: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows that went through, rows set aside). The model's output is written once and read twice."""
    written = materialize(inferred, "inferred")
    return written.where(F.col("error").isNull()).drop("error"), written.where(F.col("error").isNotNull())
