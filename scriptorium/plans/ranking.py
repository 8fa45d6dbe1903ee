"""Plans over windows, orders and set operations."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import code_point
from ..operators import documents as D
from ..operators import latest as L
from ..operators.predicates import with_flag
from .frames import Tables
from .query import query


@query("""
SELECT stage, subject, custom_id, status FROM (SELECT *, row_number() OVER (PARTITION BY stage, subject ORDER BY completed_at DESC NULLS LAST, custom_id DESC) AS n FROM requests) q WHERE n = 1""")
def w1_latest_per_group(t: Tables) -> DataFrame:
    return L.latest(t.requests, ["stage", "subject"], ["completed_at", "custom_id"], ["custom_id", "status"])


@query("""
WITH m AS (SELECT subject, max(round) AS round FROM requests GROUP BY subject),
led AS (SELECT r.subject, max_by(r.custom_id, (r.completed_at, r.custom_id)) AS led_by FROM requests r JOIN m ON r.subject = m.subject AND r.round = m.round - 1 WHERE r.completed_at IS NOT NULL GROUP BY r.subject)
SELECT m.subject, m.round, l.led_by FROM m JOIN led l ON m.subject = l.subject
WHERE NOT EXISTS (SELECT 1 FROM requests r WHERE r.subject = m.subject AND r.round = m.round AND r.status = 'pending' AND r.service_tier = 'batch' AND r.stage = 'screen')""")
def w2_unsent_rounds(t: Tables) -> DataFrame:
    rounds = t.requests.groupBy("subject").agg(F.max("round").alias("round"))
    prior = t.requests.where("completed_at IS NOT NULL").withColumn("next", F.col("round") + 1)
    led = rounds.join(prior.select("subject", "next", "custom_id", "completed_at"), (rounds["subject"] == prior["subject"]) & (rounds["round"] == F.col("next"))).groupBy(rounds["subject"], "round")
    led = led.agg(F.max_by("custom_id", F.struct("completed_at", "custom_id")).alias("led_by"))
    open_ = t.requests.where("status = 'pending' AND service_tier = 'batch' AND stage = 'screen'").select("subject", "round")
    return led.join(open_, ["subject", "round"], "left_anti").select("subject", "round", "led_by")


@query("""
SELECT hgnc_id, paper_doi, rank FROM (SELECT m.hgnc_id, m.paper_doi, row_number() OVER (PARTITION BY m.hgnc_id ORDER BY p.source_date DESC, p.doi DESC) AS rank
  FROM (SELECT DISTINCT hgnc_id, paper_doi FROM mentions) m JOIN papers p ON m.paper_doi = p.doi) q WHERE rank <= 5""")
def w3_newest_per_gene(t: Tables) -> DataFrame:
    pairs = t.mentions.select("hgnc_id", "paper_doi").distinct().join(t.papers.select("doi", "source_date"), F.col("paper_doi") == F.col("doi"))
    return L.ranked(pairs, ["hgnc_id"], [F.desc("source_date"), F.desc("doi")], 5).select("hgnc_id", "paper_doi", F.col("rank").cast("long").alias("rank"))


@query("""
SELECT doi, citedness, row_number() OVER (ORDER BY citedness DESC NULLS LAST, source_date DESC, doi DESC) AS place
FROM (SELECT p.doi, p.source_date, CASE WHEN p.pmid IS NULL THEN NULL ELSE j.citedness END AS citedness FROM papers p LEFT JOIN journals j ON p.issn = j.issn WHERE p.download_status = 'manual_required') q
ORDER BY place LIMIT 200""")
def w4_worklist_by_citedness(t: Tables) -> DataFrame:
    rows = t.papers.where("download_status = 'manual_required'").join(t.journals, "issn", "left")
    rows = rows.withColumn("citedness", F.when(F.col("pmid").isNotNull(), F.col("citedness")))
    order = [F.desc_nulls_last("citedness"), F.desc("source_date"), F.desc("doi")]
    top = rows.orderBy(*order).limit(200)
    return top.select("doi", "citedness", F.row_number().over(Window.orderBy(*order)).cast("long").alias("place"))


@query("""
SELECT id, hgnc_id, row_number() OVER (PARTITION BY hgnc_id ORDER BY listed_rating DESC NULLS LAST, coalesce(families, 0) DESC, position) AS place FROM associations""")
def w5_composite_order(t: Tables) -> DataFrame:
    w = Window.partitionBy("hgnc_id").orderBy(F.desc_nulls_last("listed_rating"), F.desc(F.coalesce("families", F.lit(0))), "position")
    return t.associations.select("id", "hgnc_id", F.row_number().over(w).cast("long").alias("place"))


@query("""
WITH r AS (SELECT id, hgnc_id, moi, row_number() OVER (PARTITION BY hgnc_id ORDER BY price DESC, id) AS n FROM associations),
g AS (SELECT *, min(n) OVER (PARTITION BY hgnc_id, moi) AS head FROM r)
SELECT hgnc_id, id, dense_rank() OVER (PARTITION BY hgnc_id ORDER BY head) AS grp, n FROM g""")
def w6_groups_by_first_member(t: Tables) -> DataFrame:
    r = t.associations.withColumn("n", F.row_number().over(Window.partitionBy("hgnc_id").orderBy(F.desc("price"), "id")).cast("long"))
    g = r.withColumn("head", F.min("n").over(Window.partitionBy("hgnc_id", "moi")))
    return g.select("hgnc_id", "id", F.dense_rank().over(Window.partitionBy("hgnc_id").orderBy("head")).cast("long").alias("grp"), "n")


@query("""
WITH k AS (SELECT doi, source || CAST(year(source_date) AS VARCHAR) || CAST(month(source_date) AS VARCHAR) AS key FROM papers WHERE pmid IS NULL)
SELECT doi, key || CASE WHEN count(*) OVER (PARTITION BY key) > 1 THEN chr(CAST(96 + row_number() OVER (PARTITION BY key ORDER BY doi) AS INT)) ELSE '' END AS display FROM k""")
def w7_disambiguated_ids(t: Tables) -> DataFrame:
    key = F.concat("source", F.year("source_date").cast("string"), F.month("source_date").cast("string"))
    k = t.papers.where("pmid IS NULL").select("doi", key.alias("key"))
    by = Window.partitionBy("key")
    suffix = F.when(F.count("*").over(by) > 1, code_point(96 + F.row_number().over(by.orderBy("doi")))).otherwise("")
    return k.select("doi", F.concat("key", suffix).alias("display"))


@query("SELECT id, 'V' || CAST(row_number() OVER (PARTITION BY hgnc_id ORDER BY disease, id) AS VARCHAR) AS label FROM associations")
def w8_row_labels(t: Tables) -> DataFrame:
    n = F.row_number().over(Window.partitionBy("hgnc_id").orderBy("disease", "id"))
    return t.associations.select("id", F.concat(F.lit("V"), n.cast("string")).alias("label"))


@query("SELECT hgnc_id, paper_doi, CAST(floor((row_number() OVER (PARTITION BY hgnc_id ORDER BY paper_doi) - 1) / 10) AS BIGINT) AS chunk FROM (SELECT DISTINCT hgnc_id, paper_doi FROM mentions) m")
def w9_fixed_chunks(t: Tables) -> DataFrame:
    n = F.row_number().over(Window.partitionBy("hgnc_id").orderBy("paper_doi"))
    return t.mentions.select("hgnc_id", "paper_doi").distinct().select("hgnc_id", "paper_doi", F.floor((n - 1) / 10).cast("long").alias("chunk"))


@query("""
WITH RECURSIVE i AS (SELECT l_orderkey, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, CAST(l_quantity AS BIGINT)) AS n, CAST(l_quantity AS BIGINT) AS b FROM lineitem),
f AS (SELECT l_orderkey, n, 0 AS batch, 1 AS k, b AS size FROM i WHERE n = 1
  UNION ALL SELECT i.l_orderkey, i.n, CASE WHEN f.k + 1 > 3 OR f.size + i.b > 60 THEN f.batch + 1 ELSE f.batch END, CASE WHEN f.k + 1 > 3 OR f.size + i.b > 60 THEN 1 ELSE f.k + 1 END,
  CASE WHEN f.k + 1 > 3 OR f.size + i.b > 60 THEN i.b ELSE f.size + i.b END FROM f JOIN i ON i.l_orderkey = f.l_orderkey AND i.n = f.n + 1)
SELECT l_orderkey, string_agg(CAST(batch AS VARCHAR), ',' ORDER BY n) AS batches FROM f GROUP BY l_orderkey""")
def w9_greedy_batches(t: Tables) -> DataFrame:
    item = F.struct(F.col("l_linenumber").alias("ord"), F.col("l_quantity").cast("long").alias("bytes"))
    by = t.lineitem.groupBy("l_orderkey").agg(D.greedy_batches(F.collect_list(item), 3, 60).alias("batches"))
    return by.select("l_orderkey", F.array_join(F.transform("batches", lambda b: b.cast("string")), ",").alias("batches"))


@query("""
WITH RECURSIVE i AS (SELECT l_orderkey, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, CAST(l_quantity AS BIGINT)) AS n, l_linenumber AS o, CAST(l_quantity AS BIGINT) AS b FROM lineitem),
f AS (SELECT l_orderkey, n, CASE WHEN b <= 40 AND b <= 70 THEN b ELSE 0 END AS total, CASE WHEN b <= 40 THEN CAST(o AS VARCHAR) ELSE '' END AS taken FROM i WHERE n = 1
  UNION ALL SELECT i.l_orderkey, i.n, CASE WHEN i.b <= 40 AND f.total + i.b <= 70 THEN f.total + i.b ELSE f.total END,
  CASE WHEN i.b <= 40 AND f.total + i.b <= 70 THEN concat_ws(',', nullif(f.taken, ''), CAST(i.o AS VARCHAR)) ELSE f.taken END FROM f JOIN i ON i.l_orderkey = f.l_orderkey AND i.n = f.n + 1)
SELECT l_orderkey, max_by(taken, n) AS taken FROM f GROUP BY l_orderkey""")
def w9_page_budget(t: Tables) -> DataFrame:
    item = F.struct(F.col("l_linenumber").alias("ord"), F.col("l_quantity").cast("long").alias("pages"))
    by = t.lineitem.groupBy("l_orderkey").agg(D.greedy_budget(F.collect_list(item), 40, 70).alias("taken"))
    return by.select("l_orderkey", F.array_join(F.transform("taken", lambda b: b.cast("string")), ",").alias("taken"))


@query("SELECT doi FROM papers WHERE relevant IS NULL AND doi NOT IN (SELECT '10.1/' || subject FROM requests) ORDER BY doi LIMIT 100")
def w10_limit_after_order(t: Tables) -> DataFrame:
    skip = t.requests.select(F.concat(F.lit("10.1/"), "subject").alias("doi"))
    return t.papers.where("relevant IS NULL").join(skip, "doi", "left_anti").select("doi").orderBy("doi").limit(100)


@query("""
WITH r AS (SELECT doc_id, label, row_number() OVER (PARTITION BY label ORDER BY md5(CAST(doc_id AS VARCHAR)), doc_id) AS n, count(*) OVER (PARTITION BY label) AS m FROM scored)
SELECT doc_id, label, CASE WHEN n <= CAST(floor(m * 0.7::DOUBLE) AS BIGINT) THEN 'train' WHEN n <= CAST(floor(m * (0.7::DOUBLE + 0.2::DOUBLE)) AS BIGINT) THEN 'val' ELSE 'test' END AS split FROM r""")
def w11_stratified_split(t: Tables) -> DataFrame:
    from ..operators.select import stratified_split

    return stratified_split(t.scored, "doc_id", "label").select("doc_id", "label", "split")


@query("""
SELECT q.hgnc_id, q.paper_doi, EXISTS (SELECT 1 FROM citations c WHERE c.hgnc_id = q.hgnc_id AND c.paper_doi = q.paper_doi) AS cited
FROM (SELECT hgnc_id, paper_doi FROM mentions UNION SELECT hgnc_id, paper_doi FROM citations) q""")
def s1_union_with_flag(t: Tables) -> DataFrame:
    pairs = t.mentions.select("hgnc_id", "paper_doi").union(t.citations).distinct()
    return with_flag(pairs, t.citations, [("hgnc_id", "hgnc_id"), ("paper_doi", "paper_doi")], "cited")


@query("""
SELECT hgnc_id, count(*) FILTER (WHERE kind = 1) AS only_mentioned, count(*) FILTER (WHERE kind = 2) AS only_cited FROM (
  SELECT hgnc_id, paper_doi, 1 AS kind FROM (SELECT hgnc_id, paper_doi FROM mentions EXCEPT SELECT hgnc_id, paper_doi FROM citations) a
  UNION ALL SELECT hgnc_id, paper_doi, 2 FROM (SELECT hgnc_id, paper_doi FROM citations EXCEPT SELECT hgnc_id, paper_doi FROM mentions) b) q GROUP BY hgnc_id""")
def s2_differences(t: Tables) -> DataFrame:
    m, c = t.mentions.select("hgnc_id", "paper_doi").distinct().withColumn("m", F.lit(1)), t.citations.withColumn("c", F.lit(1))
    both = m.join(c, ["hgnc_id", "paper_doi"], "full").where("m IS NULL OR c IS NULL")
    return both.groupBy("hgnc_id").agg(F.count("m").alias("only_mentioned"), F.count("c").alias("only_cited"))


@query("""
WITH u AS (SELECT hgnc_id, lower(paper_doi) AS k, paper_doi AS v, 1 AS p FROM mentions UNION ALL SELECT hgnc_id, lower(paper_doi), upper(paper_doi), 2 FROM citations)
SELECT hgnc_id, k, min_by(v, (p, v)) AS spelling FROM u GROUP BY hgnc_id, k""")
def s3_first_spelling(t: Tables) -> DataFrame:
    u = t.mentions.select("hgnc_id", F.lower("paper_doi").alias("k"), F.col("paper_doi").alias("v"), F.lit(1).alias("p"))
    u = u.unionAll(t.citations.select("hgnc_id", F.lower("paper_doi"), F.upper("paper_doi"), F.lit(2)))
    return u.groupBy("hgnc_id", "k").agg(F.min_by("v", F.struct("p", "v")).alias("spelling"))


@query("""
SELECT lower(c.paper_doi) AS id, min(c.hgnc_id) AS owner, min_by(c.paper_doi, (c.hgnc_id, c.paper_doi)) AS spelling FROM citations c
WHERE lower(c.paper_doi) NOT IN (SELECT lower(doi) FROM papers WHERE relevant) GROUP BY 1""")
def s4_missing_identifiers(t: Tables) -> DataFrame:
    held = t.papers.where("relevant").select(F.lower("doi").alias("id"))
    missing = t.citations.withColumn("id", F.lower("paper_doi")).join(held, "id", "left_anti")
    return missing.groupBy("id").agg(F.min("hgnc_id").alias("owner"), F.min_by("paper_doi", F.struct("hgnc_id", "paper_doi")).alias("spelling"))
