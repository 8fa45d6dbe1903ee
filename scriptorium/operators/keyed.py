"""Keyed state: upserts as one join of a stored version with ordered incoming rows.

Parquet tables have no MERGE; a new version is the full outer join of the old
one with the incoming rows, folded by key beforehand. An ordinal says in which
order the incoming rows were met.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Fold:
    """How one column of several incoming rows, and of the stored one, becomes one value."""

    incoming: Callable[[str, str], Column]  # (column, ordinal) -> aggregate
    merge: Callable[[Column, Column], Column]  # (stored, incoming) -> value


def _last(c: str, ordinal: str) -> Column:
    return F.max_by(c, ordinal)


def _last_known(c: str, ordinal: str) -> Column:
    return F.max_by(c, F.when(F.col(c).isNotNull(), F.col(ordinal)))


#: The last row's value, even if null.
LAST = Fold(_last, lambda old, new: new)
#: The last value that is not null.
KNOWN = Fold(_last_known, lambda old, new: F.coalesce(new, old))
#: The first row's value, and the stored one if there is one.
FIRST = Fold(lambda c, o: F.min_by(c, o), lambda old, new: old)
#: Fills what is null, and changes nothing else.
FILL = Fold(lambda c, o: F.min_by(c, F.when(F.col(c).isNotNull(), F.col(o))), lambda old, new: F.coalesce(old, new))


def fold(incoming: DataFrame, key: str, ordinal: str, folds: dict[str, Fold]) -> DataFrame:
    """One row per key of the incoming rows: partial aggregation, no window."""
    return incoming.groupBy(key).agg(*(f.incoming(c, ordinal).alias(c) for c, f in folds.items()))


def upsert(stored: DataFrame, incoming: DataFrame, key: str, ordinal: str, folds: dict[str, Fold], guard: Callable[[str, str], Column] | None = None) -> DataFrame:
    """The next version of ``stored``. Columns without a fold keep their stored value and are null in new rows.

    ``guard(old, new)`` gets the aliases of both sides; stored rows for which it
    does not hold stay as they are.
    """
    new = fold(incoming, key, ordinal, folds).alias("new")
    old = stored.withColumn("_held", F.lit(True)).alias("old")
    joined = old.join(new, F.col(f"old.{key}") == F.col(f"new.{key}"), "full")
    held, given = F.col("old._held").isNotNull(), F.col(f"new.{key}").isNotNull()
    change = held & given
    if guard:
        change = change & F.coalesce(guard("old", "new"), F.lit(False))
    columns = []
    for c in stored.columns:
        if c == key:
            columns.append(F.coalesce(f"old.{key}", f"new.{key}").alias(key))
        elif c in folds:
            merged = F.when(change, folds[c].merge(F.col(f"old.{c}"), F.col(f"new.{c}"))).when(held, F.col(f"old.{c}")).otherwise(F.col(f"new.{c}"))
            columns.append(merged.alias(c))
        else:
            columns.append(F.col(f"old.{c}").alias(c))
    return joined.select(*columns)


def ignore_existing(stored: DataFrame, incoming: DataFrame, key: str, ordinal: str, columns: list[str]) -> DataFrame:
    """Incoming rows whose key is new, the first of each key."""
    firsts = incoming.groupBy(key).agg(F.min_by(F.struct(*columns), ordinal).alias("_row")).select(key, "_row.*")
    return firsts.join(stored.select(key), key, "left_anti")


def replace_children(stored: DataFrame, parents: DataFrame, children: DataFrame, key: str) -> DataFrame:
    """Children of the given parents replaced, all others kept."""
    return stored.join(parents.select(key).distinct(), key, "left_anti").unionByName(children.join(parents.select(key).distinct(), key, "left_semi"))


def best_by_rank(column: str, order: list[str]) -> Column:
    """Aggregate: the value that comes last in ``order``; nulls come before all."""
    rank = F.lit(0)
    for k, v in enumerate(order, 1):
        rank = F.when(F.col(column) == v, k).otherwise(rank)
    return F.max_by(column, rank)
