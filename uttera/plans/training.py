"""Processed rows to padded training and evaluation batches."""

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from uttera import settings as S
from uttera.operators import examples as E
from uttera.session import ROW, with_row_id


@dataclass
class TrainingSet:
    """``numbered`` holds the training and the evaluation examples with their rows' numbers, ``rows`` the stored rows they
    are made of, with their lengths and split."""

    numbered: tuple[DataFrame, DataFrame]
    rows: DataFrame

    @property
    def train(self) -> DataFrame:
        return self.numbered[0].drop(ROW)

    @property
    def evaluation(self) -> DataFrame:
        return self.numbered[1].drop(ROW)

    @property
    def sizes(self) -> DataFrame:
        return E.split_sizes(self.rows)


def training_set(
    processed: DataFrame,
    vocab: DataFrame,
    key: str = "id",
    max_seq_len: int = S.MAX_SEQ_LEN,
    eval_ratio: float = S.EVAL_RATIO,
    seed: int = S.SEED,
    markers: E.Markers = E.Markers(),
) -> TrainingSet:
    """Drop what does not fit, split, encode. ``key`` need not be unique: rows are numbered once, where they are stored.

    Whether a row fits and which split it is in are known before it is encoded, so that is all that is stored.
    """
    rows = with_row_id(E.fitting_rows(processed, key, max_seq_len=max_seq_len))
    split = E.train_eval_split(rows, eval_ratio, seed, key)
    parts = (split.where(F.col("split") == name).drop("split") for name in ("train", "test"))
    train, evaluation = (E.encode_examples(part, vocab, key, max_seq_len=max_seq_len, markers=markers) for part in parts)
    return TrainingSet((train, evaluation), split)


def padded_batches(
    made: TrainingSet, batch_rows: int = S.BATCH_ROWS, pad_id: int = 0, order: str = "id"
) -> tuple[DataFrame, DataFrame]:
    """Training and evaluation rows in batches, each padded to its longest row."""
    lengths = (made.rows.where(F.col("split") == name) for name in ("train", "test"))
    train, evaluation = (E.pad_batches(part, batch_rows, pad_id, order, lengths=of) for part, of in zip(made.numbered, lengths))
    return train, evaluation
