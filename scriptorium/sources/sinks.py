"""Sinks: snapshots, per-paper quote documents, text lists, metrics."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def write_snapshot(panels: DataFrame, folder: str, date: str) -> str:
    """Write panels as JSON lines to a dated folder; gives its path."""
    path = f"{folder}/date={date}"
    panels.write.mode("overwrite").json(path)
    return path


def quote_documents(quotes: DataFrame, titles: DataFrame) -> DataFrame:
    """(doi, document): JSON of a paper's quotes, its own first, each kind in order; those of aggregates have no boxes.

    ``quotes``: doi, quote, own (boolean), boxes (array). A quote that is both is its own.
    """
    one = quotes.groupBy("doi", "quote").agg(F.bool_or("own").alias("own"), F.max(F.when(F.col("own"), F.col("boxes"))).alias("boxes"))
    boxes = F.coalesce("boxes", F.array().cast(dict(quotes.dtypes)["boxes"]))
    rows = F.array_sort(F.collect_list(F.struct((~F.col("own")).alias("rest"), "quote", boxes.alias("bboxes"))))
    by = one.groupBy("doi").agg(F.transform(rows, lambda r: F.struct(r["quote"].alias("quote"), r["bboxes"].alias("bboxes"))).alias("quotes"))
    return by.join(titles, "doi").select("doi", F.to_json(F.struct("doi", "title", "quotes")).alias("document"))


def write_lines(df: DataFrame, column: str, path: str) -> None:
    """A sorted list, one value a line, in parts whose order is that of the list."""
    df.select(F.col(column).cast("string").alias("value")).orderBy("value").write.mode("overwrite").text(path)


def write_metrics(metrics: DataFrame, path: str) -> None:
    metrics.coalesce(1).write.mode("overwrite").json(path)
