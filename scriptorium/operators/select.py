"""Selection: stratified splits and tournaments of many rounds."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .graph import _cut


def stratified_split(df: DataFrame, key: str, label: str, train: float = 0.7, val: float = 0.2) -> DataFrame:
    """Add ``split``: rows of each label in order of a hash of their key, cut where truncated shares fall."""
    by = Window.partitionBy(label)
    n = F.row_number().over(by.orderBy(F.md5(F.col(key).cast("string")), key))
    m = F.count("*").over(by)
    split = F.when(n <= F.floor(m * F.lit(train)), "train").when(n <= F.floor(m * F.lit(train + val)), "val").otherwise("test")
    return df.withColumn("split", split)


def tournament(entries: DataFrame, group: str, item: str, most: int, chunk: int, keep: int, score: Callable[[DataFrame], Column], order: list[Column]) -> DataFrame:
    """(group, item) selected. Groups of at most ``most`` pass whole. The others are cut into chunks of
    ``chunk`` in ``order``; the ``keep`` best of each chunk by ``score`` go on in chunk order, until one
    chunk has been judged. All groups go in step; a round's survivors are written.

    ``score`` gives the column to rank by (greatest first, ties by place).
    """
    if keep >= chunk:
        raise ValueError("a chunk must keep fewer than it holds")
    place = F.row_number().over(Window.partitionBy(group).orderBy(*order))
    size = F.count("*").over(Window.partitionBy(group))
    rows = _cut(entries.withColumns({"_place": place, "_size": size}))
    done = rows.where(F.col("_size") <= most).select(group, item)
    live = rows.where(F.col("_size") > most)
    while not live.isEmpty():
        chunked = live.withColumn("_chunk", F.floor((F.col("_place") - 1) / chunk))
        best = F.row_number().over(Window.partitionBy(group, "_chunk").orderBy(F.desc(score(chunked)), "_place"))
        kept = chunked.withColumn("_best", best).where(F.col("_best") <= keep)
        kept = _cut(kept.withColumn("_next", F.row_number().over(Window.partitionBy(group).orderBy("_chunk", "_place"))))
        one = F.col("_size") <= chunk
        done = done.unionByName(kept.where(one).select(group, item))
        live = kept.where(~one).withColumn("_place", F.col("_next")).withColumn("_size", F.count("*").over(Window.partitionBy(group))).drop("_best", "_next", "_chunk")
    return done
