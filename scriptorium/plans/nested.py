"""Plans over nested documents: paths, unnesting, rewriting, checks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import is_placeholder
from ..operators import documents as D
from .frames import Tables
from .query import query


def _orders(t: Tables) -> DataFrame:
    """Orders as nested documents: parts, each with its lines, in order of their numbers."""
    line = F.struct(F.col("l_linenumber").alias("number"), F.col("l_partkey").alias("part"), F.col("l_suppkey").alias("supplier"), F.col("l_quantity").alias("quantity"), F.col("l_returnflag").alias("flag"))
    by_status = t.lineitem.groupBy("l_orderkey", "l_linestatus").agg(F.array_sort(F.collect_list(line)).alias("lines"))
    group = F.struct(F.col("l_linestatus").alias("status"), F.col("lines"))
    docs = by_status.groupBy("l_orderkey").agg(F.to_json(F.array_sort(F.collect_list(group))).alias("doc"))
    return docs.select("l_orderkey", F.from_json("doc", D.ORDER_GROUPS).alias("groups"))


@query("SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events")
def n1_json_path(t: Tables) -> DataFrame:
    return t.events.select("event_id", F.get_json_object("props", "$.k").cast("long").alias("k"))


@query("SELECT l_orderkey, bool_or(l_partkey IN (1, 2, 3, 5, 8, 13, 21)) AS has_chosen FROM lineitem GROUP BY l_orderkey")
def n2_array_membership(t: Tables) -> DataFrame:
    chosen = F.array(*map(F.lit, (1, 2, 3, 5, 8, 13, 21)))
    parts = t.lineitem.groupBy("l_orderkey").agg(F.to_json(F.collect_list("l_partkey")).alias("parts"))
    return parts.select("l_orderkey", F.exists(F.from_json("parts", "array<int>"), lambda x: F.array_contains(chosen, x)).alias("has_chosen"))


@query("SELECT l_orderkey, l_linestatus AS status, l_linenumber AS number, l_partkey AS part FROM lineitem WHERE l_partkey % 10 = 3 AND l_returnflag <> 'N'")
def n3_flatten(t: Tables) -> DataFrame:
    lines = _orders(t).select("l_orderkey", F.inline("groups")).select("l_orderkey", "status", F.inline("lines"))
    return lines.where("part % 10 = 3 AND flag <> 'N'").select("l_orderkey", "status", F.col("number").cast("int").alias("number"), "part")


@query("""
SELECT l_orderkey, string_agg(DISTINCT q, ',' ORDER BY q) AS quotes FROM (
  SELECT l_orderkey, 'p' || CAST(l_partkey AS VARCHAR) AS q FROM lineitem UNION ALL SELECT l_orderkey, 's' || CAST(l_suppkey AS VARCHAR) FROM lineitem) x GROUP BY l_orderkey""")
def n4_quotes_union(t: Tables) -> DataFrame:
    text = lambda p, f: lambda x: F.concat(F.lit(p), x[f].cast("string"))
    lines = F.flatten(F.transform("groups", lambda g: g["lines"]))
    quotes = F.array_sort(F.array_distinct(F.concat(F.transform(lines, text("p", "part")), F.transform(lines, text("s", "supplier")))))
    return _orders(t).select("l_orderkey", F.array_join(quotes, ",").alias("quotes"))


@query("""
SELECT l_orderkey, count(*) FILTER (WHERE l_returnflag <> 'N') AS kept, count(*) FILTER (WHERE l_returnflag = 'N') AS dropped FROM lineitem GROUP BY l_orderkey""")
def n5_drop_elements(t: Tables) -> DataFrame:
    kept, dropped = D.drop_where(F.flatten(F.transform("groups", lambda g: g["lines"])), lambda x: is_placeholder(F.when(x["flag"] == "N", "n/a").otherwise("NR")))
    return _orders(t).select("l_orderkey", F.size(kept).cast("long").alias("kept"), dropped.cast("long").alias("dropped"))


@query("""
WITH f AS (SELECT l_orderkey, l_suppkey % 5 AS k, min_by(l_partkey, (l_linenumber, l_partkey)) AS part, min(l_linenumber) AS n FROM lineitem GROUP BY ALL)
SELECT l_orderkey, string_agg(CAST(part AS VARCHAR), ',' ORDER BY n, k, part) AS parts FROM f GROUP BY l_orderkey""")
def n6_first_of_key(t: Tables) -> DataFrame:
    row = F.struct(F.col("l_linenumber").alias("n"), (F.col("l_suppkey") % 5).alias("k"), F.col("l_partkey").alias("part"))
    rows = t.lineitem.groupBy("l_orderkey").agg(F.array_sort(F.collect_list(row)).alias("rows"))
    return rows.select("l_orderkey", F.array_join(F.transform(D.first_by("rows", "k"), lambda r: r["part"].cast("string")), ",").alias("parts"))


@query("SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 'finished' WHEN 'O' THEN 'open' ELSE 'partial' END AS status FROM orders")
def n7_keys_through_map(t: Tables) -> DataFrame:
    return t.orders.select("o_orderkey", D.through("o_orderstatus", {"F": "finished", "O": "open", "P": "partial"}).alias("status"))


@query("""
SELECT id, array_to_string(list_filter(['A:' || CASE WHEN a THEN 'yes' ELSE 'no' END, 'B:' || CASE WHEN b THEN 'yes' ELSE 'no' END, 'C:' || CASE WHEN c THEN 'yes' ELSE 'no' END], lambda x: x LIKE '%yes'), ' ') AS met FROM associations""")
def n8_criteria_list(t: Tables) -> DataFrame:
    rows = F.array(*(F.struct(F.lit(c.upper()).alias("name"), F.col(c).alias("met")) for c in ("a", "b", "c")))
    met = F.filter(rows, lambda r: r["met"])
    return t.associations.select("id", F.array_join(F.transform(met, lambda r: F.concat(r["name"], F.lit(":yes"))), " ").alias("met"))


@query("""
SELECT doi, CASE WHEN source = '1-URGENT' THEN '{"kind":"pubmed"' || CASE WHEN pmid IS NULL THEN '' ELSE ',"pmid":' || CAST(pmid AS VARCHAR) END || '}'
  ELSE '{"kind":"server","version":' || source_details || '}' END AS metadata FROM papers""")
def n9_tagged_metadata(t: Tables) -> DataFrame:
    pubmed = F.to_json(F.struct(F.lit("pubmed").alias("kind"), F.col("pmid")))
    server = F.to_json(F.struct(F.lit("server").alias("kind"), F.col("source_details").cast("long").alias("version")))
    return t.papers.select("doi", F.when(F.col("source") == "1-URGENT", pubmed).otherwise(server).alias("metadata"))


@query("""
SELECT m.hgnc_id, count(*) AS uncopied FROM mentions m
WHERE NOT EXISTS (SELECT 1 FROM citations c WHERE c.hgnc_id = m.hgnc_id AND c.paper_doi = m.paper_doi) GROUP BY m.hgnc_id""")
def n10_uncopied_citations(t: Tables) -> DataFrame:
    return t.mentions.join(t.citations, ["hgnc_id", "paper_doi"], "left_anti").groupBy("hgnc_id").agg(F.count("*").alias("uncopied"))


@query("""
SELECT id, concat_ws('; ', CASE WHEN families IS NULL THEN 'no families' END, CASE WHEN mondo_id IS NULL THEN 'no term' END, CASE WHEN moi IN ('NR', 'Other') THEN 'mode ' || moi END) AS problems FROM associations""")
def n11_problem_lists(t: Tables) -> DataFrame:
    rules = (F.col("families").isNull(), F.lit("no families")), (F.col("mondo_id").isNull(), F.lit("no term")), (F.col("moi").isin("NR", "Other"), F.concat(F.lit("mode "), "moi"))
    return t.associations.select("id", D.problems(*rules).alias("problems"))

