"""How a plan is registered: its function, and the SQL it must agree with."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame

from .frames import Tables

FOUND: dict[str, tuple[Callable[[Tables], DataFrame], str | None]] = {}


def query(sql: str | None = None) -> Callable:
    def add(plan: Callable[[Tables], DataFrame]) -> Callable[[Tables], DataFrame]:
        FOUND[plan.__name__] = plan, sql
        return plan

    return add
