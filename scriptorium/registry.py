"""All registered queries of the engine and the SQL each is checked against."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from .plans import aggregates, joins, nested, ranking, reports, rules, search, selection, sources, state, texts
from .plans.frames import Tables, with_frames
from .plans.query import FOUND
from .workers import reach

__all__ = ["ORACLES", "QUERIES", "aggregates", "joins", "nested", "ranking", "reports", "rules", "search", "selection", "sources", "state", "texts"]


def _bound(plan: Callable[[Tables], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf_dir: plan(Tables(reach(spark), sf_dir))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {name: _bound(plan) for name, (plan, _) in FOUND.items()}
ORACLES: dict[str, str] = {name: with_frames(sql) for name, (_, sql) in FOUND.items() if sql}
