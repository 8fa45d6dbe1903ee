"""Latest row of a key, and what follows from attempts over time."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def latest(df: DataFrame, keys: list[str], order: list[str], columns: list[str]) -> DataFrame:
    """The row of each key with the greatest ``order``: one aggregation with partial maxima, no sort.

    ``order`` must be total within a key (end it with an id); rows whose first
    order column is null count as earlier than all others.
    """
    row = F.max_by(F.struct(*columns), F.struct(*(F.coalesce(F.col(order[0]).cast("timestamp"), F.lit("0001-01-01").cast("timestamp")) if k == 0 and dict(df.dtypes)[order[0]].startswith(("timestamp", "date")) else F.col(c) for k, c in enumerate(order))))
    return df.groupBy(*keys).agg(row.alias("_row")).select(*keys, "_row.*")


def ranked(df: DataFrame, keys: list[str], order: list[Column], most: int, name: str = "rank") -> DataFrame:
    """The first ``most`` rows of each key; Spark limits each partition before the shuffle."""
    return df.withColumn(name, F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where(F.col(name) <= most)


def unanswered(attempts: DataFrame, answers: DataFrame, keys: list[str], at: str = "completed_at") -> DataFrame:
    """Attempts with no later answer for their key: an anti join with an inequality,
    as a join with each key's latest answer, so that a busy key is no hot pair."""
    last = answers.groupBy(*keys).agg(F.max(at).alias("_last"))
    return attempts.join(last, keys, "left").where(F.col("_last").isNull() | (F.col("_last") <= F.col(at))).drop("_last")


def as_of(df: DataFrame, keys: list[str], at: str, value: str, cutoff: Column) -> DataFrame:
    """Each key's latest value at or before a cutoff; keys without one are left out."""
    return df.where(F.col(at) <= cutoff).groupBy(*keys).agg(F.max_by(value, F.struct(at, value)).alias(value))
