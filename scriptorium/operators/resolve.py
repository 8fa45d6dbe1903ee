"""Resolution of symbols through current, previous and alias names."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import respelt


def resolve(asked: DataFrame, current: DataFrame, previous: DataFrame, alias: DataFrame) -> DataFrame:
    """Add ``gene`` to rows with a normalised ``symbol``; name tables are (gene, symbol).

    A current symbol decides. Else a previous symbol of one gene does; one of
    several genes is ambiguous and ends the search. Else an alias of one gene.
    A symbol that all of this leaves open is tried once more as what it is known
    to be misspelt for. Each different symbol is looked up once.
    """

    def names(df: DataFrame, name: str) -> DataFrame:
        return df.groupBy("symbol").agg(F.countDistinct("gene").alias(f"_n_{name}"), F.min("gene").alias(f"_{name}"))

    symbols = asked.select("symbol").distinct()
    tried = symbols.union(symbols.select(respelt(F.col("symbol")))).distinct()
    for df, name in ((current, "current"), (previous, "previous"), (alias, "alias")):
        tried = tried.join(names(df, name), "symbol", "left")
    old = F.when(F.col("_n_previous") == 1, F.col("_previous")).when(F.col("_n_previous").isNull() & (F.col("_n_alias") == 1), F.col("_alias"))
    known = tried.select("symbol", F.coalesce("_current", old).alias("_gene")).where("_gene IS NOT NULL")
    again = known.select(F.col("symbol").alias("_respelt"), F.col("_gene").alias("_again"))
    out = asked.join(known, "symbol", "left").withColumn("_respelt", respelt(F.col("symbol"))).join(again, "_respelt", "left")
    return out.select(*asked.columns, F.coalesce("_gene", "_again").alias("gene"))
