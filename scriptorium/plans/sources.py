"""Plans over sources and incremental state, on records made of the driver's tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import keyed as K
from ..sources import bibliography as B
from ..sources import knowledge as N
from .frames import Tables
from .query import query


def _article_xml(t: Tables) -> DataFrame:
    doi = F.when(F.col("o_orderkey") % 13 != 0, F.concat(F.lit('<ArticleId IdType="doi">10.1/'), F.col("o_orderkey").cast("string"), F.lit("</ArticleId>"))).otherwise("")
    title = F.when(F.col("o_orderkey") % 17 != 0, F.concat(F.lit("<ArticleTitle>On <i> part </i> &amp; "), F.col("o_orderkey").cast("string"), F.lit("</ArticleTitle>"))).otherwise("")
    language = F.when(F.col("o_orderkey") % 5 == 0, "<Language>fre</Language>").when(F.col("o_orderkey") % 5 == 1, "").otherwise("<Language>eng</Language>")
    abstract = F.when(F.col("o_orderkey") % 7 != 0, "<Abstract><AbstractText>Some text.</AbstractText></Abstract>").otherwise("")
    date = F.concat(F.lit("<ArticleDate><Year>"), F.date_format("o_orderdate", "yyyy"), F.lit("</Year><Month>"), F.date_format("o_orderdate", "MM"), F.lit("</Month><Day>"), F.date_format("o_orderdate", "dd"), F.lit("</Day></ArticleDate>"))
    xml = F.concat(F.lit("<PubmedArticle><MedlineCitation><PMID>"), F.col("o_orderkey").cast("string"), F.lit("</PMID><Article>"), title, abstract, language, date, F.lit("</Article></MedlineCitation><PubmedData><ArticleIdList>"), doi, F.lit("</ArticleIdList></PubmedData></PubmedArticle>"))
    # a generator keeps the parse in one place: projections above it would each repeat it
    return t.orders.select("o_orderkey", F.explode(F.array(F.from_xml(xml, B._parsed(B.ARTICLE)))).alias("x"))


_GATES = "CASE WHEN o_orderkey % 13 = 0 THEN 'no_doi' WHEN o_orderkey % 17 = 0 THEN 'no_title' WHEN o_orderkey % 7 = 0 THEN 'no_abstract' WHEN o_orderkey % 5 = 0 THEN 'non_english' END"


@query(f"""
SELECT '10.1/' || CAST(o_orderkey AS VARCHAR) AS doi, o_orderkey AS pmid, 'On part & ' || CAST(o_orderkey AS VARCHAR) AS title, CAST(o_orderdate AS DATE) AS source_date FROM orders WHERE {_GATES} IS NULL""")
def src_article_scan(t: Tables) -> DataFrame:
    found = B.articles(_article_xml(t).select("x.*"))
    return found.where("reason IS NULL").select("doi", "pmid", "title", "source_date")


@query(f"SELECT {_GATES} AS reason, count(*) AS n FROM orders WHERE {_GATES} IS NOT NULL GROUP BY 1")
def src_article_skips(t: Tables) -> DataFrame:
    return B.articles(_article_xml(t).select("x.*")).where("reason IS NOT NULL").groupBy("reason").agg(F.count("*").alias("n"))


@query("""
SELECT doi, version, seq FROM (SELECT o_custkey AS doi, o_orderkey % 5 AS version, o_orderkey AS seq, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey % 5 DESC, o_orderkey) AS n FROM orders WHERE o_orderkey % 5 > 0) q WHERE n = 1""")
def src_highest_versions(t: Tables) -> DataFrame:
    rows = t.orders.select(F.col("o_custkey").alias("doi"), (F.col("o_orderkey") % 5).alias("version"), F.col("o_orderkey").alias("seq"))
    return B.highest_versions(rows)


@query("""
SELECT o_orderkey, '10.21203/rs.' || CAST(o_orderkey AS VARCHAR) AS doi, CASE WHEN o_orderkey % 3 = 0 THEN 1 ELSE CAST(o_orderkey % 3 + 1 AS INT) END AS version FROM orders""")
def src_crossref_versions(t: Tables) -> DataFrame:
    k = F.col("o_orderkey")
    raw = F.concat(F.lit("10.21203/rs."), k.cast("string"), F.when(k % 3 == 0, "").otherwise(F.concat(F.lit("/v"), (k % 3 + 1).cast("string"))))
    doi, version = B.crossref_doi(raw)
    return t.orders.select("o_orderkey", doi.alias("doi"), version.alias("version"))


@query("""
SELECT DISTINCT 'pubmed' || CAST(24 + p_partkey % 2 AS VARCHAR) || 'n' || lpad(CAST(p_partkey % 10000 AS VARCHAR), 4, '0') || '.xml.gz' AS name, CAST(2024 + p_partkey % 2 AS INT) AS year, CAST(p_partkey % 10000 AS INT) AS number FROM part""")
def src_update_files(t: Tables) -> DataFrame:
    k = F.col("p_partkey")
    name = F.concat(F.lit("pubmed"), (24 + k % 2).cast("string"), F.lit("n"), F.lpad((k % 10000).cast("string"), 4, "0"), F.lit(".xml.gz"))
    lines = t.part.select(F.concat(F.lit('<a href="'), name, F.lit('">'), name, F.lit("</a> <a>"), name, F.lit(".md5</a>")).alias("line"))
    return B.update_files(lines)


@query("""
SELECT 'MONDO:' || CAST(p_partkey AS VARCHAR) AS id, p_name AS label, 1 AS synonyms, CASE WHEN floor(p_partkey / 3) > 0 THEN 'MONDO:' || CAST(CAST(floor(p_partkey / 3) AS BIGINT) AS VARCHAR) END AS parent, p_size % 10 = 0 AS obsolete FROM part""")
def src_ontology_terms(t: Tables) -> DataFrame:
    k = F.col("p_partkey")
    up = F.floor(k / 3)
    parent = F.when(up > 0, F.concat(F.lit("\nis_a: MONDO:"), up.cast("string"), F.lit(" ! a name"))).otherwise("")
    stanza = F.concat(F.lit("[Term]\nid: MONDO:"), k.cast("string"), F.lit("\nname: "), "p_name", F.lit('\nsynonym: "'), "p_type", F.lit('" EXACT []'), parent, F.when(F.col("p_size") % 10 == 0, "\nis_obsolete: true").otherwise(""))
    found = N.terms(t.part.select(stanza.alias("value")))
    return found.select("id", "label", F.size("synonyms").alias("synonyms"), F.try_element_at("parents", F.lit(1)).alias("parent"), "obsolete")


@query("""
SELECT p_brand AS gene, p_type AS disease, max_by(p_name, p_partkey) AS title, string_agg(DISTINCT CAST(p_size % 4 AS VARCHAR), ',' ORDER BY CAST(p_size % 4 AS VARCHAR)) AS modes FROM part GROUP BY p_brand, p_type""")
def src_submissions(t: Tables) -> DataFrame:
    rows = t.part.select(F.col("p_brand").alias("gene"), F.col("p_type").alias("disease"), F.col("p_name").alias("title"), (F.col("p_size") % 4).cast("string").alias("moi"), F.col("p_partkey").alias("ordinal"))
    return N.disease_terms(rows).withColumn("modes", F.array_join("modes", ","))


@query("""
SELECT page_id, url, regexp_extract(html, '<title>([^<]*)</title>', 1) AS title FROM pages WHERE regexp_matches(html, '<title>[^<]*</title>')""")
def src_scraped_titles(t: Tables) -> DataFrame:
    return t.pages.where(F.col("html").rlike("<title>[^<]*</title>")).select("page_id", "url", F.regexp_extract("html", "<title>([^<]*)</title>", 1).alias("title"))


@query("""
WITH f AS (SELECT user_id, max_by(event_type, event_id) AS title, max_by(event_id, event_id) FILTER (WHERE event_id % 3 <> 0) AS pmid, min(CAST(ts AS DATE)) AS first_seen, max_by(CAST(ts AS DATE), event_id) AS last_seen FROM events GROUP BY user_id)
SELECT '10.2/' || CAST(user_id AS VARCHAR) AS doi, pmid, title, first_seen, last_seen FROM f""")
def i1_file_cursor_fold(t: Tables) -> DataFrame:
    """What applying the events as files by day, in order, leaves in an empty ledger."""
    day = F.to_date("ts")
    rows = t.events.select(F.concat(F.lit("10.2/"), F.col("user_id").cast("string")).alias("doi"), F.when(F.col("event_id") % 3 != 0, F.col("event_id")).alias("pmid"), F.col("event_type").alias("title"), day.alias("first_seen"), day.alias("last_seen"), F.col("event_id").alias("ordinal"))
    folds = {"pmid": K.KNOWN, "title": K.LAST, "first_seen": K.Fold(lambda c, o: F.min(c), lambda old, new: old), "last_seen": K.LAST}
    empty = t.spark.createDataFrame([], "doi string, pmid long, title string, first_seen date, last_seen date")
    return K.upsert(empty, rows, "doi", "ordinal", folds)


@query("SELECT doi, source_date FROM papers WHERE source_date >= DATE '1998-08-02' - INTERVAL 6 MONTH")
def i2_closure_horizon(t: Tables) -> DataFrame:
    from ..streaming.sync import working_set

    return working_set(t.papers, "1998-08-02").select("doi", "source_date")
