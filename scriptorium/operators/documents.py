"""Work within nested documents, in the row: no unnesting where a fold will do."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

ORDER_GROUPS = "array<struct<status:string,lines:array<struct<number:int,part:long,supplier:long,quantity:double,flag:string>>>>"


def drop_where(array: Column, bad: Callable[[Column], Column]) -> tuple[Column, Column]:
    """The array without the elements that are bad, and how many these are."""
    kept = F.filter(array, lambda x: ~bad(x))
    return kept, F.size(array) - F.size(kept)


def first_by(array: str | Column, field: str) -> Column:
    """The first element of each value of a field, in order."""
    a = F.col(array) if isinstance(array, str) else array
    values = F.transform(a, lambda x: x[field])
    return F.filter(a, lambda x, k: F.array_position(values, x[field]) == k + 1)


def through(column: str, mapping: dict[str, str]) -> Column:
    """A value looked up in a map; one that is not in it fails the query."""
    pairs = F.create_map(*(F.lit(x) for kv in mapping.items() for x in kv))
    found = F.try_element_at(pairs, F.col(column))
    unknown = F.raise_error(F.concat(F.lit(f"unknown {column}: "), F.col(column)))
    return F.when(F.col(column).isNull(), F.lit(None)).when(found.isNotNull(), found).otherwise(unknown)


def problems(*rules: tuple[Column, Column]) -> Column:
    """The texts of the rules that hold, joined; empty if none does."""
    return F.concat_ws("; ", *(F.when(cond, text) for cond, text in rules))


def greedy_budget(items: Column, most_each: int, most: int) -> Column:
    """Numbers of the items taken: in order, skipping any over ``most_each`` pages and any that would
    bring the pages taken over ``most``; later small ones may still fit. ``items``: (ord, pages)."""
    row = "struct<total:long,taken:array<long>>"
    start = F.struct(F.lit(0).cast("long").alias("total"), F.array().cast("array<long>").alias("taken")).cast(row)

    def step(acc: Column, x: Column) -> Column:
        fits = (x["pages"] <= most_each) & (acc["total"] + x["pages"] <= most)
        more = F.struct((acc["total"] + x["pages"]).cast("long").alias("total"), F.concat(acc["taken"], F.array(x["ord"].cast("long"))).alias("taken"))
        return F.when(fits, more).otherwise(acc)

    return F.aggregate(F.array_sort(items), start, step, lambda acc: acc["taken"])


def greedy_batches(items: Column, most_items: int, most_bytes: int) -> Column:
    """Batch number of each item, in order: a batch ends before the item that would break either limit.
    ``items``: (ord, bytes)."""
    row = "struct<batch:int,n:int,size:long,out:array<int>>"
    start = F.struct(F.lit(0).alias("batch"), F.lit(0).alias("n"), F.lit(0).cast("long").alias("size"), F.array().cast("array<int>").alias("out")).cast(row)

    def step(acc: Column, x: Column) -> Column:
        full = (acc["n"] > 0) & ((acc["n"] + 1 > most_items) | (acc["size"] + x["bytes"] > most_bytes))
        batch = (acc["batch"] + full.cast("int")).cast("int")
        return F.struct(
            batch.alias("batch"),
            F.when(full, 1).otherwise(acc["n"] + 1).cast("int").alias("n"),
            F.when(full, x["bytes"]).otherwise(acc["size"] + x["bytes"]).cast("long").alias("size"),
            F.concat(acc["out"], F.array(batch)).alias("out"),
        )

    return F.aggregate(F.array_sort(items), start, step, lambda acc: acc["out"])
