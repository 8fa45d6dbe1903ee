"""What several operators need: shared storage, Arrow mapping, hashing by id."""

from __future__ import annotations

import os
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..folders import remove_at_end
from ..workers import reach


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share, from ``spark.checkpoint.dir``.

    Where it is unset, a folder under /tmp is used, for local sessions only.
    """
    path = spark.conf.get("spark.checkpoint.dir", None)
    if path:
        return path.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return f"/tmp/checkpoints/{os.getuid()}"


def materialise(df: DataFrame, tag: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: lineage is cut,
    what lies before runs once, and a lost executor costs nothing of it. The
    table is removed when the driver ends."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{tag}-{uuid.uuid4().hex}"
    remove_at_end(spark, path)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def map_arrow(df: DataFrame, rows: Callable[[Iterator[pa.RecordBatch]], Iterator[dict]], schema: str) -> DataFrame:
    """``mapInArrow`` for a function that yields column dicts of lists or arrays."""
    target = reach(df.sparkSession).createDataFrame([], schema).schema
    from pyspark.sql.pandas.types import to_arrow_schema

    arrow = to_arrow_schema(target)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for cols in rows(batches):
            yield pa.RecordBatch.from_arrays([pa.array(cols[f.name], type=f.type) for f in arrow], schema=arrow)

    return df.mapInArrow(run, target)


def keep_rows(df: DataFrame, keep: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> DataFrame:
    """``mapInArrow`` for a function that drops rows and leaves the columns as they are."""
    reach(df.sparkSession)
    return df.mapInArrow(keep, df.schema)


def text_bytes(name: str = "text") -> Column:
    """A text column as UTF-8 bytes, null as empty."""
    return F.coalesce(F.col(name), F.lit("")).cast("binary")


def crc_mod(column: str, modulus: int) -> Column:
    """crc32 of the id written as text, modulo ``modulus``; null ids count as the empty text."""
    return (F.crc32(F.coalesce(F.col(column).cast("string"), F.lit(""))) % modulus).cast("int")


def unused(df: DataFrame, name: str) -> str:
    """A column name that ``df`` does not have, whatever the case of its names."""
    taken = {c.lower() for c in df.columns}
    while name in taken:
        name += "_"
    return name
