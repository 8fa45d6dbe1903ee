"""Plans over predicates and joins: due sets, existence flags, anti joins, lookups."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import latest as L
from ..operators import predicates as P
from .frames import Tables
from .query import query

_RELEVANT = "coalesce(json_extract_string(relevance_json, '$.relevant') = 'true', false)"
_RUN_GENES = f"SELECT DISTINCT m.hgnc_id FROM mentions m JOIN papers p ON m.paper_doi = p.doi WHERE m.source = 'recent_evidence' AND {_RELEVANT}"


@query("""
WITH latest AS (SELECT subject, custom_id, status, row_number() OVER (PARTITION BY subject ORDER BY completed_at DESC NULLS LAST, custom_id DESC) AS n FROM requests)
SELECT r.subject, r.custom_id AS refused_id, r.refusal_category, l.custom_id AS latest_id, l.status AS latest_status
FROM requests r JOIN latest l ON r.subject = l.subject AND l.n = 1 WHERE r.status = 'refused'""")
def latest_request_per_subject(t: Tables) -> DataFrame:
    last = L.latest(t.requests, ["subject"], ["completed_at", "custom_id"], ["custom_id", "status"])
    last = last.select("subject", F.col("custom_id").alias("latest_id"), F.col("status").alias("latest_status"))
    refused = t.requests.where("status = 'refused'").select("subject", F.col("custom_id").alias("refused_id"), "refusal_category")
    return refused.join(last, "subject").select("subject", "refused_id", "refusal_category", "latest_id", "latest_status")


@query(f"SELECT doi, {_RELEVANT} AS is_relevant FROM papers")
def r1_relevant(t: Tables) -> DataFrame:
    return t.papers.select("doi", P.relevant().alias("is_relevant"))


@query("SELECT doi, source_type IS NOT DISTINCT FROM 'expansion' AS is_expansion, source_type IS DISTINCT FROM 'expansion' AS is_initial FROM papers")
def r2_initial_expansion(t: Tables) -> DataFrame:
    return t.papers.select("doi", P.expansion().alias("is_expansion"), P.initial().alias("is_initial"))


@query(_RUN_GENES)
def r3_run_genes(t: Tables) -> DataFrame:
    return P.run_genes(t.papers, t.mentions)


@query(f"WITH g AS ({_RUN_GENES}) SELECT doi, doi IN (SELECT paper_doi FROM citations WHERE hgnc_id IN (SELECT hgnc_id FROM g)) AS cited FROM papers")
def r4_cited_flag(t: Tables) -> DataFrame:
    cited = P.cited_papers(t.citations, P.run_genes(t.papers, t.mentions))
    return P.with_flag(t.papers, cited, [("doi", "paper_doi")], "cited").select("doi", "cited")


@query(f"""
WITH g AS ({_RUN_GENES})
SELECT doi FROM papers WHERE source_type IS NOT DISTINCT FROM 'expansion' OR {_RELEVANT}
  OR doi IN (SELECT paper_doi FROM citations WHERE hgnc_id IN (SELECT hgnc_id FROM g))""")
def r5_corpus(t: Tables) -> DataFrame:
    cited = P.cited_papers(t.citations, P.run_genes(t.papers, t.mentions))
    flagged = P.with_flag(t.papers, cited, [("doi", "paper_doi")], "cited")
    return flagged.where(P.expansion() | F.col("cited") | P.relevant()).select("doi")


@query("""
SELECT relevant, download_status, count(*) AS n, count(*) FILTER (WHERE relevant IS NOT DISTINCT FROM false OR download_status IS NOT DISTINCT FROM 'downloaded') AS n_settled
FROM papers GROUP BY relevant, download_status""")
def r6_settled_partition(t: Tables) -> DataFrame:
    return t.papers.groupBy("relevant", "download_status").agg(F.count("*").alias("n"), F.count_if(P.settled()).alias("n_settled"))


@query("SELECT doi, source_date FROM papers WHERE source_date BETWEEN DATE '1996-01-01' AND DATE '1996-06-30'")
def r7_date_window(t: Tables) -> DataFrame:
    return t.papers.where(F.col("source_date").between(F.lit("1996-01-01").cast("date"), F.lit("1996-06-30").cast("date"))).select("doi", "source_date")


@query("""
SELECT doi FROM papers p WHERE download_status = 'downloaded' AND extraction_json IS NULL
  AND NOT EXISTS (SELECT 1 FROM requests r WHERE r.status = 'pending' AND '10.1/' || r.subject = p.doi)
  AND doi NOT IN (SELECT '10.1/' || subject FROM requests WHERE status = 'refused' AND stage = 'extract')
ORDER BY doi LIMIT 500""")
def r8_due_papers(t: Tables) -> DataFrame:
    pending = t.requests.where("status = 'pending'").select(F.concat(F.lit("10.1/"), "subject").alias("doi"))
    skipped = t.requests.where("status = 'refused' AND stage = 'extract'").select(F.concat(F.lit("10.1/"), "subject").alias("doi"))
    due = t.papers.where("download_status = 'downloaded' AND extraction_json IS NULL")
    return due.join(pending, "doi", "left_anti").join(skipped, "doi", "left_anti").select("doi").orderBy("doi").limit(500)


@query(f"""
WITH g AS ({_RUN_GENES})
SELECT hgnc_id FROM g WHERE hgnc_id NOT IN (SELECT hgnc_id FROM associations)
  AND NOT EXISTS (SELECT 1 FROM requests r WHERE r.status = 'pending' AND r.subject = CAST(g.hgnc_id AS STRING))""")
def r9_due_genes(t: Tables) -> DataFrame:
    genes = P.run_genes(t.papers, t.mentions)
    pending = t.requests.where("status = 'pending'").select("subject")
    return genes.join(t.associations, "hgnc_id", "left_anti").join(pending, F.col("hgnc_id").cast("string") == F.col("subject"), "left_anti")


@query(f"""
WITH asked AS (SELECT '10.1/' || CAST(user_id AS STRING) AS doi FROM events GROUP BY user_id)
SELECT a.doi, CASE WHEN p.doi IS NULL THEN 'not in the database' WHEN p.extraction_json IS NOT NULL THEN 'already extracted'
  WHEN p.download_status IS DISTINCT FROM 'downloaded' THEN 'not downloaded'
  WHEN p.relevant IS NULL THEN 'not assessed' WHEN NOT p.relevant THEN 'not relevant' ELSE 'due' END AS reason
FROM asked a LEFT JOIN papers p ON a.doi = p.doi""")
def r10_why_not_selected(t: Tables) -> DataFrame:
    asked = t.events.select(F.concat(F.lit("10.1/"), F.col("user_id").cast("string")).alias("asked")).distinct()
    joined = asked.join(t.papers, F.col("asked") == F.col("doi"), "left")
    reason = P.first_reason(
        (F.col("doi").isNull(), "not in the database"),
        (F.col("extraction_json").isNotNull(), "already extracted"),
        (~F.col("download_status").eqNullSafe("downloaded"), "not downloaded"),
        (F.col("relevant").isNull(), "not assessed"),
        (~F.col("relevant"), "not relevant"),
        otherwise="due",
    )
    return joined.select(F.col("asked").alias("doi"), reason.alias("reason"))


@query("""
SELECT doi FROM papers WHERE download_status = 'manual_required'
  AND (source_type IS NOT DISTINCT FROM 'expansion' OR doi IN (SELECT paper_doi FROM citations))
  AND doi NOT IN (SELECT paper_doi FROM mentions WHERE hgnc_id < 20)""")
def r11_manual_worklist(t: Tables) -> DataFrame:
    flagged = P.with_flag(t.papers.where("download_status = 'manual_required'"), t.citations, [("doi", "paper_doi")], "cited")
    done = t.mentions.where("hgnc_id < 20").select(F.col("paper_doi").alias("doi"))
    return flagged.where(P.expansion() | F.col("cited")).join(done, "doi", "left_anti").select("doi")


@query("""
SELECT doi, CASE WHEN doi IN (SELECT paper_doi FROM citations) THEN 'downloaded' ELSE download_status END AS download_status
FROM papers WHERE download_status = 'scheduled' AND source IN ('1-URGENT', '2-HIGH')""")
def r12_download_queue(t: Tables) -> DataFrame:
    queue = t.papers.where("download_status = 'scheduled'").where(F.col("source").isin("1-URGENT", "2-HIGH"))
    there = P.with_flag(queue, t.citations, [("doi", "paper_doi")], "there")
    return there.select("doi", F.when(F.col("there"), "downloaded").otherwise(F.col("download_status")).alias("download_status"))


@query(f"""
SELECT doi FROM papers WHERE extraction_json IS NULL AND NOT (source_type IS NOT DISTINCT FROM 'expansion' OR {_RELEVANT})
  AND (relevance_json IS NULL OR json_extract(relevance_json, '$.refused') IS NULL OR json_extract_string(relevance_json, '$.refused') IS NULL)""")
def r13_unread_outside_corpus(t: Tables) -> DataFrame:
    return t.papers.where(F.col("extraction_json").isNull() & ~(P.expansion() | P.relevant()) & ~P.refused()).select("doi")


@query("SELECT id FROM associations WHERE mondo_id IS NULL OR mondo_match = 'gencc'")
def r14_to_map(t: Tables) -> DataFrame:
    return t.associations.where("mondo_id IS NULL OR mondo_match = 'gencc'").select("id")


@query("""
SELECT p.doi, m.hgnc_id, p.source_date, p.download_status FROM papers p JOIN mentions m ON p.doi = m.paper_doi WHERE m.hgnc_id % 50 = 7""")
def j1_papers_of_genes(t: Tables) -> DataFrame:
    chosen = t.mentions.where("hgnc_id % 50 = 7")
    return t.papers.join(chosen, F.col("doi") == F.col("paper_doi")).select("doi", "hgnc_id", "source_date", "download_status")


@query("SELECT issn FROM (SELECT DISTINCT issn FROM papers WHERE issn IS NOT NULL) q WHERE issn NOT IN (SELECT issn FROM journals)")
def j3_unfetched_journals(t: Tables) -> DataFrame:
    return t.papers.where("issn IS NOT NULL").select("issn").distinct().join(t.journals, "issn", "left_anti")


@query("SELECT paper_doi FROM mentions m WHERE EXISTS (SELECT 1 FROM papers p WHERE p.doi = m.paper_doi AND p.relevant) GROUP BY paper_doi")
def j2_mentioned_relevant(t: Tables) -> DataFrame:
    return t.mentions.join(t.papers.where("relevant"), F.col("paper_doi") == F.col("doi"), "left_semi").select("paper_doi").distinct()


@query("""
SELECT stage, subject, count(*) AS failures, max_by(coalesce(rejection, 'unusable'), (completed_at, custom_id)) AS last_rejection
FROM requests f WHERE status = 'errored'
  AND NOT EXISTS (SELECT 1 FROM requests r WHERE r.stage = f.stage AND r.subject = f.subject AND r.status = 'succeeded' AND r.completed_at > f.completed_at)
GROUP BY stage, subject HAVING count(*) >= 2""")
def j4_failures_without_later_answer(t: Tables) -> DataFrame:
    r = t.requests
    open_ = L.unanswered(r.where("status = 'errored'"), r.where("status = 'succeeded'"), ["stage", "subject"])
    last = F.max_by(F.coalesce("rejection", F.lit("unusable")), F.struct("completed_at", "custom_id"))
    return open_.groupBy("stage", "subject").agg(F.count("*").alias("failures"), last.alias("last_rejection")).where("failures >= 2")


@query("SELECT p.doi, j.citedness, j.issn IS NOT NULL AS looked_up FROM papers p LEFT JOIN journals j ON p.issn = j.issn")
def j5_papers_with_journal(t: Tables) -> DataFrame:
    j = t.journals.withColumn("looked_up", F.lit(True))
    return t.papers.join(j, "issn", "left").select("doi", "citedness", F.coalesce("looked_up", F.lit(False)).alias("looked_up"))


@query("""
WITH refused AS (SELECT doi, source_details FROM papers WHERE json_extract_string(relevance_json, '$.refused.category') = 'bio'),
genes AS (SELECT DISTINCT hgnc_id FROM associations)
SELECT DISTINCT r.doi, g.hgnc_id FROM refused r CROSS JOIN genes g
WHERE EXISTS (SELECT 1 FROM mentions m WHERE m.paper_doi = r.doi AND m.hgnc_id = g.hgnc_id)
  OR EXISTS (SELECT 1 FROM citations c WHERE c.paper_doi = r.doi AND c.hgnc_id = g.hgnc_id)
  OR r.source_details = CAST(g.hgnc_id AS STRING)""")
def j6_refused_papers_of_genes(t: Tables) -> DataFrame:
    refused = t.papers.where(F.get_json_object("relevance_json", "$.refused.category") == "bio").select("doi", "source_details")
    genes = t.associations.select("hgnc_id").distinct()
    pairs = [
        refused.join(t.mentions, F.col("doi") == F.col("paper_doi")).select("doi", "hgnc_id"),
        refused.join(t.citations, F.col("doi") == F.col("paper_doi")).select("doi", "hgnc_id"),
        refused.select("doi", F.col("source_details").try_cast("long").alias("hgnc_id")),
    ]
    out = pairs[0].union(pairs[1]).union(pairs[2])
    return out.join(genes, "hgnc_id", "left_semi").select("doi", "hgnc_id").distinct()


@query("""
SELECT p.doi, (SELECT r.status FROM requests r WHERE '10.1/' || r.subject = p.doi ORDER BY r.completed_at DESC NULLS LAST, r.custom_id DESC LIMIT 1) AS last_status
FROM papers p WHERE p.relevant""")
def j7_latest_status_of_papers(t: Tables) -> DataFrame:
    last = L.latest(t.requests, ["subject"], ["completed_at", "custom_id"], ["status"])
    last = last.select(F.concat(F.lit("10.1/"), "subject").alias("doi"), F.col("status").alias("last_status"))
    return t.papers.where("relevant").join(last, "doi", "left").select("doi", "last_status")


@query("""
WITH last AS (SELECT stage, subject, status, row_number() OVER (PARTITION BY stage, subject ORDER BY completed_at DESC, custom_id DESC) AS n FROM requests WHERE status <> 'pending')
SELECT r.custom_id, r.stage, r.subject, r.refusal_category, l.status AS outcome
FROM requests r JOIN last l ON r.stage = l.stage AND r.subject = l.subject AND l.n = 1 WHERE r.status = 'refused'""")
def j8_refusals_with_outcome(t: Tables) -> DataFrame:
    last = L.latest(t.requests.where("status <> 'pending'"), ["stage", "subject"], ["completed_at", "custom_id"], ["status"]).withColumnRenamed("status", "outcome")
    return t.requests.where("status = 'refused'").join(last, ["stage", "subject"]).select("custom_id", "stage", "subject", "refusal_category", "outcome")


@query("""
SELECT e.doi, count(*) AS requests, count(*) FILTER (WHERE r.status = 'succeeded') AS answered
FROM existing e JOIN requests r ON e.doi = '10.2/' || r.subject GROUP BY e.doi""")
def j9_two_databases(t: Tables) -> DataFrame:
    r = t.requests.select(F.concat(F.lit("10.2/"), "subject").alias("doi"), "status")
    return t.existing.select("doi").join(r, "doi").groupBy("doi").agg(F.count("*").alias("requests"), F.count_if(F.col("status") == "succeeded").alias("answered"))


@query("""
WITH wanted AS (SELECT p_partkey AS id, upper('10.1/' || CAST(p_partkey AS STRING)) || CASE WHEN p_size % 2 = 0 THEN '' ELSE 'X' END AS doi, p_partkey + 1000000 AS pmid FROM part),
hits AS (SELECT w.id, p.doi FROM wanted w JOIN papers p ON lower(w.doi) = lower(p.doi) UNION SELECT w.id, p.doi FROM wanted w JOIN papers p ON w.pmid = p.pmid)
SELECT id, min(doi) AS doi FROM hits GROUP BY id""")
def j10_case_insensitive_match(t: Tables) -> DataFrame:
    spelled = F.concat(F.upper(F.concat(F.lit("10.1/"), F.col("p_partkey").cast("string"))), F.when(F.col("p_size") % 2 == 0, "").otherwise("X"))
    wanted = t.part.select(F.col("p_partkey").alias("id"), F.lower(spelled).alias("key"), (F.col("p_partkey") + 1000000).alias("wpmid"))
    papers = t.papers.select("doi", "pmid", F.lower("doi").alias("key"))
    hits = wanted.join(papers, "key").select("id", "doi").union(wanted.join(papers, F.col("wpmid") == F.col("pmid")).select("id", "doi"))
    return hits.groupBy("id").agg(F.min("doi").alias("doi"))


@query("""
SELECT panel_id, max_by(version, (created, version)) AS version FROM snapshots
WHERE created <= DATE '1997-06-30' AND version <> '' AND version <> '0.0' GROUP BY panel_id""")
def j11_version_as_of(t: Tables) -> DataFrame:
    return L.as_of(t.snapshots.where("version <> '' AND version <> '0.0'"), ["panel_id"], "created", "version", F.lit("1997-06-30").cast("date"))


@query("""
SELECT panel_id, coalesce(min_by(version, (created, version)) FILTER (WHERE created >= DATE '1998-01-01'), max_by(version, (created, version))) AS version
FROM snapshots GROUP BY panel_id""")
def j11_first_at_or_latest(t: Tables) -> DataFrame:
    order = F.struct("created", "version")
    after = F.min_by("version", F.when(F.col("created") >= F.lit("1998-01-01").cast("date"), order))
    return t.snapshots.groupBy("panel_id").agg(F.coalesce(after, F.max_by("version", order)).alias("version"))


@query("""
WITH m AS (SELECT o_custkey % 20 AS panel, o_custkey AS gene, date_trunc('month', o_orderdate)::DATE AS month, max(CAST(o_orderkey % 4 AS INT)) AS rating
  FROM orders WHERE o_orderdate < TIMESTAMP '1996-01-01' GROUP BY ALL),
n AS (SELECT DISTINCT panel, month, dense_rank() OVER (PARTITION BY panel ORDER BY month) AS k FROM m),
x AS (SELECT m.*, n.k FROM m JOIN n ON m.panel = n.panel AND m.month = n.month)
SELECT b.panel, b.month, count(*) FILTER (WHERE a.gene IS NULL) AS added, count(*) FILTER (WHERE b.rating > a.rating) AS upgraded
FROM x b LEFT JOIN x a ON a.panel = b.panel AND a.gene = b.gene AND a.k = b.k - 1 WHERE b.k > 1 GROUP BY b.panel, b.month""")
def j12_consecutive_snapshots(t: Tables) -> DataFrame:
    from pyspark.sql import Window

    o = t.orders.where("o_orderdate < timestamp '1996-01-01'")
    m = o.groupBy((F.col("o_custkey") % 20).alias("panel"), F.col("o_custkey").alias("gene"), F.trunc(F.col("o_orderdate"), "MM").alias("month")).agg(F.max((F.col("o_orderkey") % 4).cast("int")).alias("rating"))
    x = m.withColumn("k", F.dense_rank().over(Window.partitionBy("panel").orderBy("month")))
    before = x.select("panel", "gene", (F.col("k") + 1).alias("k"), F.col("rating").alias("was"))
    d = x.where("k > 1").join(before, ["panel", "gene", "k"], "left")
    return d.groupBy("panel", "month").agg(F.count_if(F.col("was").isNull()).alias("added"), F.count_if(F.col("rating") > F.col("was")).alias("upgraded"))
