"""What a review form is filled in with, gene by gene."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import rules


def chosen(associations: DataFrame, gene: str) -> DataFrame:
    """The associations that a form describes, with ``rated``: those with a finding; without any, those not
    reviewed yet; without these, all, and then the form keeps the gene's rating (rated is false)."""
    w = Window.partitionBy(gene)
    counted = associations.withColumns({"_found": F.count("finding").over(w), "_open": F.count_if(~F.coalesce("reviewed", F.lit(False))).over(w)})
    use = F.when(F.col("_found") > 0, F.col("finding").isNotNull()).when(F.col("_open") > 0, ~F.coalesce("reviewed", F.lit(False))).otherwise(True)
    return counted.where(use).withColumn("rated", (F.col("_found") > 0) | (F.col("_open") > 0)).drop("_found", "_open")


def prefill(associations: DataFrame, gene: str) -> DataFrame:
    """(gene, rated, chosen, mode, phenotypes, publications) of associations (finding, reviewed, mode, disease, publications)."""
    none = F.array().cast("array<string>")
    publications = F.array_sort(F.array_distinct(F.flatten(F.collect_list(F.coalesce("publications", none)))))
    by = chosen(associations, gene).groupBy(gene)
    found = by.agg(F.bool_and("rated").alias("rated"), F.count("*").alias("chosen"), F.collect_set("mode").alias("_modes"), F.array_sort(F.collect_set("disease")).alias("phenotypes"), publications.alias("publications"))
    return found.withColumn("mode", rules.mode_of_inheritance(F.col("_modes"))).drop("_modes")
