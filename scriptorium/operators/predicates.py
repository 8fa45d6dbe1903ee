"""Row predicates of a curation run. None of them is ever NULL: complements are exact."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def json_flag(column: str, path: str) -> Column:
    """Whether a JSON document holds ``true`` at a path; absent, null or broken documents do not."""
    return F.get_json_object(column, path).eqNullSafe("true")


def relevant(column: str = "relevance_json") -> Column:
    return json_flag(column, "$.relevant")


def expansion(column: str = "source_type") -> Column:
    return F.col(column).eqNullSafe("expansion")


def initial(column: str = "source_type") -> Column:
    """Anything but an expansion paper, unknown origin included."""
    return ~expansion(column)


def settled(relevant: str = "relevant", status: str = "download_status") -> Column:
    """Judged irrelevant, or read: nothing is left to do. The complement is the actionable set."""
    return F.col(relevant).eqNullSafe(False) | F.col(status).eqNullSafe("downloaded")


def refused(column: str = "relevance_json") -> Column:
    """Whether a stored answer records a refusal; a JSON null is none."""
    return F.get_json_object(column, "$.refused").isNotNull()


def with_flag(df: DataFrame, keys: DataFrame, on: list[tuple[str, str]], name: str) -> DataFrame:
    """Add whether a row's key is among ``keys``: an existence join that keeps every row.

    ``on`` pairs columns of ``df`` with those of ``keys``; the keys are made
    distinct first, so rows are never multiplied.
    """
    marked = keys.select(*(F.col(k).alias(f"_k{n}") for n, (_, k) in enumerate(on))).distinct().withColumn(name, F.lit(True))
    cond = [F.col(c) == F.col(f"_k{n}") for n, (c, _) in enumerate(on)]
    joined = df.join(marked, cond, "left").drop(*(f"_k{n}" for n in range(len(on))))
    return joined.withColumn(name, F.coalesce(name, F.lit(False)))


def run_genes(papers: DataFrame, mentions: DataFrame) -> DataFrame:
    """Genes that a relevant paper mentions as recent evidence."""
    hits = mentions.where(F.col("source") == "recent_evidence").join(papers.where(relevant()), F.col("paper_doi") == F.col("doi"), "left_semi")
    return hits.select("hgnc_id").distinct()


def cited_papers(citations: DataFrame, genes: DataFrame) -> DataFrame:
    """Papers in the citations of the given genes."""
    return citations.join(genes, "hgnc_id", "left_semi").select("paper_doi").distinct()


def first_reason(*rules: tuple[Column, str], otherwise: str | None = None) -> Column:
    """The name of the first rule that holds."""
    out = None
    for cond, name in rules:
        out = F.when(cond, name) if out is None else out.when(cond, name)
    return out.otherwise(F.lit(otherwise))
