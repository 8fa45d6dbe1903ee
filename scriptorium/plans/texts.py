"""Plans over text, identifier and date functions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text as T
from .frames import Tables
from .query import query


@query("""
SELECT p_partkey, CASE p_partkey % 3 WHEN 0 THEN '10.1234/ab(' || p_partkey || ')x 10.1101/2020.01.01.1' WHEN 1 THEN '10.1101/2021.04.27.' || p_partkey
  ELSE '10.5000/' || p_partkey || '[a] 10.9999/z' END AS dois FROM part""")
def t1_dois(t: Tables) -> DataFrame:
    k = F.col("p_partkey").cast("string")
    bracketed = F.concat(F.lit("see https://doi.org/10.1234/ab("), k, F.lit(")x). Also 10.1101/2020.01.01.1v2;"))
    version = F.concat(F.lit("https://www.biorxiv.org/content/10.1101/2021.04.27."), k, F.lit("v1.full.pdf?x=1 and 10.1101/2021.04.27."), k)
    marks = F.concat(F.lit("[10.5000/"), k, F.lit("[a]]; 10.9999/z#part, 10.9999/z."))
    text = F.when(F.col("p_partkey") % 3 == 0, bracketed).when(F.col("p_partkey") % 3 == 1, version).otherwise(marks)
    return t.part.select("p_partkey", F.array_join(T.dois(text), " ").alias("dois"))


@query("""
WITH k AS (SELECT p_partkey, CAST(p_partkey + 1000000 AS VARCHAR) AS k FROM part)
SELECT p_partkey, CASE p_partkey % 6 WHEN 0 THEN k WHEN 1 THEN k || ' 2345678' WHEN 2 THEN k WHEN 3 THEN '' WHEN 4 THEN k || ' 55555' ELSE k END AS pmids FROM k""")
def t2_pmids(t: Tables) -> DataFrame:
    k = (F.col("p_partkey") + 1000000).cast("string")
    forms = [("PMID: ", "; OMIM 123456; 10.1000/7654321"), ("PMIDs: ", ", 2345678, 1234 and 99999"), ("PubMed ID: ", " Corpus ID: 245670"), ("bioRxiv ", ", ID 123456, 0123456"), ("", ", 55555; 123456789"), ("https://pubmed.ncbi.nlm.nih.gov/", "/?x=1 MIM# 601492")]
    text = F.lit("")
    for n, (before, after) in enumerate(forms):
        text = F.when(F.col("p_partkey") % 6 == n, F.concat(F.lit(before), k, F.lit(after))).otherwise(text)
    return t.part.select("p_partkey", F.array_join(T.pmids(text), " ").alias("pmids"))


@query("""
WITH q AS (SELECT p_partkey AS id, upper(replace(replace(p_name, ' ', '-'), '.', '-')) AS s FROM part),
cur AS (SELECT upper(replace(p_name, ' ', '-')) AS s, min(p_partkey) AS gene FROM part WHERE p_partkey % 3 = 0 GROUP BY 1),
prev AS (SELECT upper(replace(p_name, ' ', '-')) AS s, count(*) AS n, min(p_partkey) AS gene FROM part WHERE p_partkey % 3 = 1 GROUP BY 1),
ali AS (SELECT upper(replace(p_name, ' ', '-')) AS s, count(*) AS n, min(p_partkey) AS gene FROM part WHERE p_partkey % 3 = 2 GROUP BY 1)
SELECT q.id, coalesce(cur.gene, CASE WHEN prev.n = 1 THEN prev.gene WHEN prev.n > 1 THEN NULL WHEN ali.n = 1 THEN ali.gene END) AS gene
FROM q LEFT JOIN cur ON q.s = cur.s LEFT JOIN prev ON q.s = prev.s LEFT JOIN ali ON q.s = ali.s
UNION ALL SELECT -p_partkey, CASE WHEN p_partkey % 3 = 0 THEN p_partkey END FROM part""")
def t3_symbol_resolution(t: Tables) -> DataFrame:
    from ..operators.resolve import resolve

    key = T.normal_symbol(F.replace(F.col("p_name"), F.lit(" "), F.lit("-")))
    named = t.part.select(F.col("p_partkey").alias("gene"), key.alias("symbol"))
    part = lambda k: named.where(F.col("gene") % 3 == k)
    family = t.part.where("p_partkey % 3 = 0").select(F.col("p_partkey").alias("gene"), F.concat(F.lit("ERCC"), F.col("p_partkey").cast("string")).alias("symbol"))
    misspelt = t.part.select((-F.col("p_partkey")).alias("id"), F.concat(F.lit("ERRC"), F.col("p_partkey").cast("string")).alias("symbol"))
    asked = t.part.select(F.col("p_partkey").alias("id"), key.alias("symbol")).union(misspelt)
    return resolve(asked, part(0).union(family), part(1), part(2)).select("id", "gene")


@query("""
WITH c AS (SELECT p_partkey, CASE p_size % 4 WHEN 0 THEN 'mitochondria' WHEN 1 THEN CAST(p_size AS VARCHAR) || 'q11' WHEN 2 THEN 'Xp22' ELSE 'unplaced' END AS l FROM part)
SELECT p_partkey, CASE WHEN lower(l) LIKE 'mitochond%' THEN 'MT' ELSE nullif(regexp_extract(l, '^([0-9]+|X|Y)', 1), '') END AS chromosome FROM c""")
def t4_chromosome(t: Tables) -> DataFrame:
    k = F.col("p_size") % 4
    place = F.when(k == 0, "mitochondria").when(k == 1, F.concat(F.col("p_size").cast("string"), F.lit("q11"))).when(k == 2, "Xp22").otherwise("unplaced")
    return t.part.select("p_partkey", T.chromosome(place).alias("chromosome"))


@query("SELECT p_partkey, p_name || ' XYZ ABC1-AS QRS (XYZ)' AS text FROM part")
def t5_symbol_replacement(t: Tables) -> DataFrame:
    text = F.concat(F.col("p_name"), F.lit(" ABC1 ABC1-AS ABC12 (ABC1)"))
    return t.part.select("p_partkey", T.replace_symbols(text, {"ABC1": "XYZ", "ABC12": "QRS"}).alias("text"))


@query("SELECT doi, pmid IS NULL OR issn < 11 AS is_preprint FROM papers")
def t6_preprints(t: Tables) -> DataFrame:
    names = ["The bioRxiv", "MedRxiv", "arXiv.org", "SSRN Journal", "Research Square", "Preprints", "ChemRxiv", "EarthArXiv", "PsyArXiv", "SocArXiv", "OSF Preprints", "Archives of Things"]
    journal = F.element_at(F.array(*map(F.lit, names)), F.least(F.col("issn") + 1, F.lit(12)).cast("int"))
    return t.papers.select("doi", T.is_preprint(F.col("pmid"), journal).alias("is_preprint"))


@query("""
SELECT doc_id, kind = 'whole' AND (length(regexp_replace(text, '[^\\p{L}\\p{N}]', '', 'g')) < 2 OR lower(trim(text, ' ' || chr(9) || chr(10) || chr(13))) IN ('placeholder', 'pending', 'n/a', 'tbd')) OR kind = 'stands in' AS placeholder
FROM (SELECT doc_id, text, CASE WHEN doc_id % 8 IN (0, 1, 2, 3) THEN 'stands in' WHEN doc_id % 8 = 4 THEN 'quoted' ELSE 'whole' END AS kind FROM documents) q""")
def t7_placeholder_quotes(t: Tables) -> DataFrame:
    k = F.col("doc_id") % 8
    q = F.when(k == 0, " N/A ").when(k == 1, ".x.").when(k == 2, "TBD\n").when(k == 3, "Pending").when(k == 4, "NR").otherwise(F.col("text"))
    return t.documents.select("doc_id", T.is_placeholder(q).alias("placeholder"))


@query("""
SELECT page_id, md5(trim(regexp_replace(regexp_replace(html, '<[^>]+>', ' ', 'g'), '[ \\t\\n\\f\\r\\x0B]+', ' ', 'g'))) AS text FROM pages""")
def t8_strip_tags(t: Tables) -> DataFrame:
    return t.pages.select("page_id", F.md5(T.strip_tags(F.col("html"))).alias("text"))


@query("""
SELECT c_custkey, CASE c_custkey % 4 WHEN 0 THEN 'Unknown' WHEN 1 THEN 'UkaszZoc' ELSE 'Mullerludenscheid' || upper(substr(c_mktsegment, 1, 1)) || lower(substr(c_mktsegment, 2)) END AS key FROM customer""")
def t9_author_keys(t: Tables) -> DataFrame:
    k = F.col("c_custkey") % 4
    long = F.concat(F.lit("Müller-Lüdenscheid "), F.col("c_mktsegment"), F.lit(", A; B"))
    names = F.when(k == 0, F.when(F.col("c_custkey") % 8 == 0, " ; B, C")).when(k == 1, "Łukasz Żółć; Other").otherwise(long)
    return t.customer.select("c_custkey", T.author_keys(names).alias("key"))


@query("SELECT doc_id, CASE WHEN length(text) > 60 THEN substr(text, 1, 60) || '...' ELSE text END AS text FROM documents")
def t10_shorten(t: Tables) -> DataFrame:
    return t.documents.select("doc_id", T.shorten(F.col("text"), 60).alias("text"))


@query("""
SELECT p_partkey, array_to_string(list_filter(string_split_regex(lower(p_name), '[^a-z0-9]+'), lambda x: x <> '' AND x NOT IN ('a', 'an', 'and', 'associated', 'by', 'due', 'for', 'in', 'of', 'or', 'related', 'the', 'to', 'type', 'with')), ' ') || ' naive syndrome 7' AS tokens FROM part""")
def t11_tokens(t: Tables) -> DataFrame:
    from ..operators.search import tokens

    name = F.concat("p_name", F.lit(" of the Naïve-β syndrome, TYPE 7 (due to)"))
    return t.part.select("p_partkey", F.array_join(tokens(name), " ").alias("tokens"))


@query("""
SELECT doi, url_encode('10.1/a b*~' || doi || '(x)') AS encoded FROM papers""")
def t12_percent_encode(t: Tables) -> DataFrame:
    return t.papers.select("doi", T.percent_encode(F.concat(F.lit("10.1/a b*~"), "doi", F.lit("(x)"))).alias("encoded"))


@query("SELECT doi, replace(replace('see 10.1/1 or 10.1/12', '10.1/12', 'Lee2020'), '10.1/1', 'Ito2021') || doi AS text FROM papers")
def t13_display_ids(t: Tables) -> DataFrame:
    swap = T.display_ids({"10.1/1": "Ito2021", "10.1/12": "Lee2020"})
    return t.papers.select("doi", F.concat(swap(F.lit("see 10.1/1 or 10.1/12")), "doi").alias("text"))


@query("SELECT hgnc_id, string_agg(disease || ' (' || moi || ')', '; ' ORDER BY position) AS listed FROM associations GROUP BY hgnc_id")
def t14_ordered_lists(t: Tables) -> DataFrame:
    line = F.concat("disease", F.lit(" ("), "moi", F.lit(")"))
    rows = F.array_sort(F.collect_list(F.struct("position", line.alias("line"))))
    return t.associations.groupBy("hgnc_id").agg(F.array_join(F.transform(rows, lambda r: r["line"]), "; ").alias("listed"))


@query("SELECT doi, source_details > '9' AS after_nine FROM papers")
def t15_text_order(t: Tables) -> DataFrame:
    return t.papers.select("doi", (F.col("source_details") > "9").alias("after_nine"))


@query("SELECT p_partkey FROM part WHERE p_type ILIKE '%StAnDaRd%' OR p_name ILIKE '%red%'")
def t16_like_ignores_case(t: Tables) -> DataFrame:
    return t.part.where(F.col("p_type").ilike("%StAnDaRd%") | F.col("p_name").ilike("%red%")).select("p_partkey")


@query("""
SELECT page_id, trim(regexp_replace(regexp_replace(url || ' And or NOT nota', '(?i)\\b(AND|OR|NOT)\\b', ' ', 'g'), '\\s+', ' ', 'g')) AS title FROM pages""")
def t17_boolean_words(t: Tables) -> DataFrame:
    return t.pages.select("page_id", T.strip_boolean_words(F.concat("url", F.lit(" And or NOT nota"))).alias("title"))


@query("SELECT doi, (source_date - INTERVAL 6 MONTH)::DATE AS horizon FROM papers")
def d1_months_before(t: Tables) -> DataFrame:
    return t.papers.select("doi", F.add_months("source_date", -6).alias("horizon"))


@query("""
SELECT o_orderkey, make_date(year(o_orderdate), CASE WHEN o_orderkey % 2 = 0 THEN month(o_orderdate) ELSE 1 END, CASE WHEN o_orderkey % 4 = 0 THEN day(o_orderdate) ELSE 1 END) AS d FROM orders""")
def d2_partial_dates(t: Tables) -> DataFrame:
    k = F.col("o_orderkey")
    month, day = F.when(k % 2 == 0, F.month("o_orderdate")), F.when(k % 4 == 0, F.dayofmonth("o_orderdate"))
    return t.orders.select("o_orderkey", F.make_date(F.year("o_orderdate"), F.coalesce(month, F.lit(1)), F.coalesce(day, F.lit(1))).alias("d"))


@query("SELECT event_id, strftime(ts, '%Y-%m') AS month, (date_trunc('month', ts) + INTERVAL 1 MONTH)::DATE AS next_month FROM events")
def d3_month_keys(t: Tables) -> DataFrame:
    return t.events.select("event_id", F.date_format("ts", "yyyy-MM").alias("month"), F.trunc(F.add_months("ts", 1), "MM").alias("next_month"))


@query("SELECT event_id FROM events WHERE ts < TIMESTAMP '2024-01-10 00:00:00' - INTERVAL 7 DAY")
def d4_stale(t: Tables) -> DataFrame:
    return t.events.where("ts < timestamp '2024-01-10 00:00:00' - interval 7 days").select("event_id")
