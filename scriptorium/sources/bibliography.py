"""Bibliographic records: XML article sets, preprint server JSON, CrossRef JSON, file lists."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

#: The fields of an article that are read; mixed content is kept as inner XML.
ARTICLE = """
MedlineCitation struct<
  PMID: struct<_VALUE: long>,
  Article: struct<
    Journal: struct<Title: string, ISSN: struct<_VALUE: string>, JournalIssue: struct<PubDate: struct<Year: string, Month: string, Day: string>>>,
    ArticleTitle: string, Abstract: struct<AbstractText: array<string>>,
    AuthorList: struct<Author: array<struct<LastName: string, ForeName: string, CollectiveName: string>>>,
    Language: array<string>,
    ArticleDate: struct<Year: string, Month: string, Day: string>,
    ELocationID: array<struct<_EIdType: string, _VALUE: string>>>,
  MedlineJournalInfo: struct<ISSNLinking: string>>,
PubmedData struct<ArticleIdList: struct<ArticleId: array<struct<_IdType: string, _VALUE: string>>>>"""

_MONTHS = ("jan", "feb", "mar", "apr", "may", "jun", "jul", "aug", "sep", "oct", "nov", "dec")


def plain(xml: Column) -> Column:
    """The text of mixed content, trimmed at the edges of every element, as inline elements are."""
    text = F.regexp_replace(F.regexp_replace(xml, r"\s+(?=</)", ""), r"(<[^/][^>]*>)\s+", "$1")
    text = F.trim(F.regexp_replace(text, r"<[^>]+>", ""))
    for entity, c in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&apos;", "'"), ("&amp;", "&")):
        text = F.replace(text, F.lit(entity), F.lit(c))
    return F.nullif(text, F.lit(""))


def date_of(part: str) -> Column:
    """Year, month and day as a date, null unless all are there and make one."""
    name = F.lower(F.left(F.col(f"{part}.Month"), F.lit(3)))
    month = F.coalesce(F.col(f"{part}.Month").try_cast("int"), F.nullif(F.array_position(F.array(*map(F.lit, _MONTHS)), name), F.lit(0)).cast("int"))
    return F.try_to_date(F.format_string("%04d-%02d-%02d", F.col(f"{part}.Year").try_cast("int"), month, F.col(f"{part}.Day").try_cast("int")))


def articles(rows: DataFrame, require_abstract: bool = True) -> DataFrame:
    """A row for each article (columns of ``ARTICLE``), with the first gate it fails as ``reason``, else null."""
    a, m = "MedlineCitation.Article", "MedlineCitation"
    ids = F.filter("PubmedData.ArticleIdList.ArticleId", lambda x: x["_IdType"] == "doi")
    places = F.filter(f"{a}.ELocationID", lambda x: x["_EIdType"] == "doi")
    doi = F.coalesce(F.try_element_at(ids, F.lit(1))["_VALUE"], F.try_element_at(places, F.lit(1))["_VALUE"])
    person = lambda p: F.coalesce(F.nullif(F.concat_ws(", ", p["LastName"], p["ForeName"]), F.lit("")), p["CollectiveName"], F.lit(""))
    authors = F.array_join(F.filter(F.transform(f"{a}.AuthorList.Author", person), lambda x: x != ""), "; ")
    languages = F.col(f"{a}.Language")
    found = rows.select(
        F.nullif(F.trim(doi), F.lit("")).alias("doi"),
        F.col(f"{m}.PMID._VALUE").alias("pmid"),
        plain(F.col(f"{a}.ArticleTitle")).alias("title"),
        F.nullif(F.array_join(F.transform(f"{a}.Abstract.AbstractText", plain), " "), F.lit("")).alias("abstract"),
        F.nullif(authors, F.lit("")).alias("authors"),
        F.col(f"{a}.Journal.Title").alias("journal"),
        F.coalesce(F.nullif(F.trim(f"{m}.MedlineJournalInfo.ISSNLinking"), F.lit("")), F.col(f"{a}.Journal.ISSN._VALUE")).alias("issn"),
        F.coalesce(date_of(f"{a}.ArticleDate"), date_of(f"{a}.Journal.JournalIssue.PubDate")).alias("source_date"),
        F.coalesce((F.size(languages) > 0) & ~F.array_contains(languages, "eng"), F.lit(False)).alias("foreign"),
    )
    reason = (
        F.when(F.col("doi").isNull(), "no_doi").when(F.col("source_date").isNull(), "no_date").when(F.col("title").isNull(), "no_title")
        .when(F.lit(require_abstract) & F.col("abstract").isNull(), "no_abstract").when(F.col("foreign"), "non_english")
    )
    return found.withColumn("reason", reason).drop("foreign")


def read_article_sets(spark: SparkSession, path: str, require_abstract: bool = True, min_year: int | None = None) -> tuple[DataFrame, DataFrame]:
    """(papers, skip counts by reason) of article set files, gzipped or not. Years under ``min_year`` are left out uncounted."""
    rows = spark.read.format("xml").option("rowTag", "PubmedArticle").schema(_parsed(ARTICLE)).load(path)
    every = articles(rows, require_abstract)
    skipped = every.where("reason IS NOT NULL").groupBy("reason").agg(F.count("*").alias("n"))
    papers = every.where("reason IS NULL").drop("reason")
    return (papers if min_year is None else papers.where(F.year("source_date") >= min_year)), skipped


def _parsed(ddl: str) -> StructType:
    return StructType.fromDDL(" ".join(ddl.split()))


def highest_versions(rows: DataFrame, key: str = "doi", version: str = "version", seen: str = "seq") -> DataFrame:
    """The highest version over 0 of each key, the first met on ties."""
    others = [c for c in rows.columns if c != key]
    best = rows.where(F.col(version) > 0).groupBy(key).agg(F.max_by(F.struct(*others), F.struct(version, (-F.col(seen)).alias("_s"))).alias("_row"))
    return best.select(key, "_row.*")


def crossref_doi(c: Column) -> tuple[Column, Column]:
    """A DOI without its ``/vN`` and the version N, 1 without one."""
    n = F.regexp_extract(c, r"/v(\d+)$", 1)
    return F.regexp_replace(c, r"/v\d+$", ""), F.coalesce(n.try_cast("int"), F.lit(1))


def update_files(names: DataFrame) -> DataFrame:
    """(name, year, number) of numbered update files in a listing, each once, in order."""
    pattern = r"pubmed(\d{2})n(\d{4})\.xml\.gz(?!\.md5)"
    found = names.select(F.explode(F.regexp_extract_all("line", F.lit(f"({pattern})"), F.lit(1))).alias("name")).distinct()
    return found.select("name", (F.regexp_extract("name", pattern, 1).cast("int") + 2000).alias("year"), F.regexp_extract("name", pattern, 2).cast("int").alias("number")).orderBy("year", "number")


def verified(files: DataFrame, sums: DataFrame) -> DataFrame:
    """Files (path, content) whose MD5 is the one listed (name, md5)."""
    name = F.substring_index("path", "/", -1)
    return files.withColumn("name", name).join(sums, "name").where(F.md5("content") == F.lower("md5")).drop("md5")
