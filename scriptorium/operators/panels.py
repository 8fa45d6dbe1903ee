"""Lookups over a panel snapshot: frames of panels with their genes nested in them.

``panels`` is (id, name, description, child_panel_ids, genes); a gene has
hgnc_id, publications and evaluations (created, rating, publications), which are
null where the server could not give them. Further columns are kept.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def gene_entries(panels: DataFrame) -> DataFrame:
    """(panel, gene, at, entry): a row for each gene entry, at its place on the panel."""
    rows = panels.select(F.col("id").alias("panel"), F.posexplode("genes").alias("at", "entry"))
    return rows.select("panel", F.col("entry.hgnc_id").alias("gene"), "at", "entry")


def gene_panels(panels: DataFrame) -> DataFrame:
    """(gene, panels): the panels that hold each gene, each once, in order."""
    return gene_entries(panels).groupBy("gene").agg(F.array_sort(F.collect_set("panel")).alias("panels"))


def descriptions(panels: DataFrame) -> DataFrame:
    """Panels without those that are made of others; all columns but the genes."""
    own = F.size(F.coalesce("child_panel_ids", F.array().cast("array<bigint>"))) == 0
    return panels.where(own).drop("genes", "child_panel_ids")


def gene_reviews(panels: DataFrame) -> DataFrame:
    """(panel, gene, reviews): reviews of each gene entry, newest first; null where none were served. Of
    entries of one gene on one panel the last counts."""
    last = gene_entries(panels).groupBy("panel", "gene").agg(F.max_by("entry", "at").alias("entry"))
    return last.select("panel", "gene", F.sort_array("entry.evaluations", asc=False).alias("reviews"))


def review_state(reviews: Column) -> Column:
    return F.when(reviews.isNull(), "not served").when(F.size(reviews) == 0, "none").otherwise("reviewed")


def entry_publications(panels: DataFrame) -> DataFrame:
    """(panel, gene, publications): those of the entries and of their reviews, each once, in order."""
    none = F.array().cast("array<string>")
    reviewed = F.flatten(F.transform(F.col("entry.evaluations"), lambda r: F.coalesce(r["publications"], none)))
    both = F.concat(F.coalesce("entry.publications", none), F.coalesce(reviewed, none))
    return gene_entries(panels).groupBy("panel", "gene").agg(F.array_sort(F.array_distinct(F.flatten(F.collect_list(both)))).alias("publications"))
