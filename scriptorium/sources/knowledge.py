"""Reference data: ontologies (OBO), submissions (TSV), panels and gene registries (JSON), report scrapes, line lists."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.graph import descendants

PANEL = """
id long, name string, child_panel_ids array<long>,
genes array<struct<gene_data:struct<hgnc_id:string,gene_symbol:string>,entity_name:string,confidence_level:string,mode_of_inheritance:string,phenotypes:array<string>,publications:array<string>,evaluations:array<struct<rating:string,publications:array<string>,created:string,comments:array<struct<comment:string>>>>>>,
strs array<struct<gene_data:struct<hgnc_id:string,gene_symbol:string>,entity_name:string,confidence_level:string,mode_of_inheritance:string,phenotypes:array<string>,publications:array<string>,evaluations:array<struct<rating:string,publications:array<string>,created:string,comments:array<struct<comment:string>>>>>>"""


def _first(stanza: Column, field: str) -> Column:
    return F.nullif(F.regexp_extract(stanza, rf"(?m)^{field}: ([^\n!]*?)\s*(?:!.*)?$", 1), F.lit(""))


def _all(stanza: Column, field: str) -> Column:
    return F.regexp_extract_all(stanza, F.lit(rf"(?m)^{field}: (\S+)"), F.lit(1))


def terms(stanzas: DataFrame) -> DataFrame:
    """(id, label, synonyms, xrefs, parents, genes, obsolete, replaced_by, consider) of OBO stanzas (value)."""
    v = F.col("value")
    quoted = F.regexp_extract_all(v, F.lit(r'(?m)^synonym: "((?:[^"\\]|\\.)*)" \w+'), F.lit(1))
    scopes = F.regexp_extract_all(v, F.lit(r'(?m)^synonym: "(?:[^"\\]|\\.)*" (\w+)'), F.lit(1))
    return stanzas.where(v.startswith("[Term]")).select(
        _first(v, "id").alias("id"), _first(v, "name").alias("label"),
        F.zip_with(quoted, scopes, lambda n, s: F.struct(n.alias("name"), s.alias("scope"))).alias("synonyms"),
        _all(v, "xref").alias("xrefs"), _all(v, "is_a").alias("parents"),
        F.regexp_extract_all(v, F.lit(r"(?m)^relationship: has_material_basis_in_germline_mutation_in \S*?hgnc[/:](\d+)"), F.lit(1)).alias("genes"),
        F.coalesce(_first(v, "is_obsolete") == "true", F.lit(False)).alias("obsolete"),
        _first(v, "replaced_by").alias("replaced_by"), _all(v, "consider").alias("consider"),
    )


def read_ontology(spark: SparkSession, path: str) -> DataFrame:
    """The terms of an OBO file; stanzas are read apart, in parallel."""
    return terms(spark.read.option("lineSep", "\n\n").text(path).select(F.trim(F.col("value")).alias("value")))


def parent_edges(found: DataFrame) -> DataFrame:
    return found.select(F.col("id").alias("child"), F.explode("parents").alias("parent"))


def eligible(found: DataFrame, roots: list[str], barred: list[str]) -> DataFrame:
    """Terms under ``roots`` but not under ``barred``, without obsolete ones."""
    spark, edges = found.sparkSession, parent_edges(found)
    under = lambda r: descendants_of(spark, edges, r)
    return found.where("NOT obsolete").join(under(roots), F.col("id") == F.col("node"), "left_semi").join(under(barred), F.col("id") == F.col("node"), "left_anti").select("id")


def descendants_of(spark: SparkSession, edges: DataFrame, roots: list[str]) -> DataFrame:
    """String nodes under string roots."""
    start = spark.createDataFrame([(r,) for r in roots], "root string")
    seen = start.select(F.col("root").alias("node")).distinct()
    return descendants(edges, start).select("node").union(seen).distinct() if roots else seen


def read_submissions(spark: SparkSession, path: str) -> DataFrame:
    """Rows of a quoted TSV whose fields may hold line ends."""
    return spark.read.csv(path, sep="\t", header=True, multiLine=True, quote='"', escape='"')


def disease_terms(rows: DataFrame) -> DataFrame:
    """By gene and disease: the last title, modes in order. ``rows``: gene, disease, title, moi, ordinal."""
    return rows.groupBy("gene", "disease").agg(F.max_by("title", "ordinal").alias("title"), F.array_sort(F.collect_set("moi")).alias("modes"))


def read_panels(spark: SparkSession, path: str) -> DataFrame:
    """A row for each panel of a snapshot file ``{id: panel}``."""
    whole = spark.read.option("wholetext", True).text(path)
    return whole.select(F.explode(F.from_json("value", f"map<string,struct<{_struct(PANEL)}>>"))).select("value.*")


def _struct(ddl: str) -> str:
    from pyspark.sql.types import StructType

    return StructType.fromDDL(" ".join(ddl.split())).simpleString()[len("struct<") : -1]


def entries(panels: DataFrame) -> DataFrame:
    """Genes and repeats of panels, a row each: panel_id, kind, hgnc_id, symbol, colour, reviewed (null: not served)."""
    colour = F.when(F.col("e.confidence_level").isin("0", "1"), "RED").when(F.col("e.confidence_level") == "2", "AMBER").when(F.col("e.confidence_level") == "3", "GREEN")

    def rows(kind: str, column: str) -> DataFrame:
        one = panels.select(F.col("id").alias("panel_id"), F.lit(kind).alias("kind"), F.explode(column).alias("e"))
        hgnc = F.regexp_extract("e.gene_data.hgnc_id", r"(\d+)$", 1).try_cast("long")
        reviewed = F.when(F.col("e.evaluations").isNotNull(), F.size("e.evaluations") > 0)
        return one.select("panel_id", "kind", hgnc.alias("hgnc_id"), F.col("e.gene_data.gene_symbol").alias("symbol"), colour.alias("colour"), reviewed.alias("reviewed"))

    return rows("gene", "genes").unionByName(rows("str", "strs")).where("hgnc_id IS NOT NULL")


def add_reviews(genes: DataFrame, reviews: DataFrame) -> DataFrame:
    """Attach reviews, newest first; genes listed twice on a panel, or unknown to ``reviews``, get null."""
    from pyspark.sql import Window

    listed = F.count("*").over(Window.partitionBy("panel_id", "symbol"))
    by = reviews.groupBy("panel_id", "symbol").agg(F.sort_array(F.collect_list(F.struct("created", "rating")), asc=False).alias("reviews"))
    joined = genes.withColumn("_listed", listed).join(by, ["panel_id", "symbol"], "left")
    return joined.withColumn("reviews", F.when(F.col("_listed") == 1, F.col("reviews"))).drop("_listed")


def read_genes(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Current, previous and alias symbols (gene, symbol) of a registry file, in upper case."""
    doc = spark.read.option("multiLine", True).schema("response struct<docs:array<struct<hgnc_id:string,symbol:string,prev_symbol:array<string>,alias_symbol:array<string>>>>").json(path)
    rows = doc.select(F.explode("response.docs").alias("d")).select(F.regexp_extract("d.hgnc_id", r"(\d+)$", 1).cast("long").alias("gene"), "d.symbol", "d.prev_symbol", "d.alias_symbol")
    many = lambda c: rows.select("gene", F.explode(c).alias("s")).select("gene", F.upper("s").alias("symbol"))
    return rows.select("gene", F.upper("symbol").alias("symbol")), many("prev_symbol"), many("alias_symbol")


def scraped(pages: DataFrame, pattern: str, fields: list[str]) -> DataFrame:
    """A row for each match of a pattern in whole pages (value); fields are its groups."""
    groups = [F.regexp_extract_all("value", F.lit(f"(?s){pattern}"), F.lit(k + 1)) for k in range(len(fields))]
    return pages.select(F.explode(F.arrays_zip(*(g.alias(f) for g, f in zip(groups, fields)))).alias("m")).select("m.*")


def line_list(spark: SparkSession, path: str) -> DataFrame:
    """Trimmed lines, each once, without empty ones."""
    return spark.read.text(path).select(F.trim("value").alias("value")).where("value <> ''").distinct()
