"""Plans over keyed state: upserts, merges, write-backs and deletes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import keyed as K
from ..operators.predicates import with_flag
from .frames import Tables
from .query import query

_LAST = "row_number() OVER (PARTITION BY doi ORDER BY ordinal DESC)"
_TODAY = "DATE '2024-06-01'"


def _today():
    return F.lit("2024-06-01").cast("date")


@query(f"""
WITH f AS (SELECT doi, max_by(title, ordinal) AS title, max_by(source, ordinal) AS source, max_by(pmid, ordinal) FILTER (WHERE pmid IS NOT NULL) AS pmid FROM incoming GROUP BY doi)
SELECT coalesce(e.doi, f.doi) AS doi, coalesce(f.pmid, e.pmid) AS pmid, coalesce(f.title, e.title) AS title, coalesce(f.source, e.source) AS source,
  e.download_status, e.relevant, coalesce(e.first_seen, {_TODAY}) AS first_seen, CASE WHEN f.doi IS NULL THEN e.last_seen ELSE {_TODAY} END AS last_seen
FROM existing e FULL JOIN f ON e.doi = f.doi""")
def r15_metadata_upsert(t: Tables) -> DataFrame:
    incoming = t.incoming.withColumns({"first_seen": _today(), "last_seen": _today()})
    folds = {"pmid": K.KNOWN, "title": K.LAST, "source": K.LAST, "first_seen": K.FIRST, "last_seen": K.LAST}
    return K.upsert(t.existing, incoming, "doi", "ordinal", folds).select("doi", "pmid", "title", "source", "download_status", "relevant", "first_seen", "last_seen")


@query("""
SELECT count(*) FILTER (WHERE doi NOT IN (SELECT doi FROM existing)) AS inserted,
  (SELECT count(*) FROM incoming) - count(*) FILTER (WHERE doi NOT IN (SELECT doi FROM existing)) AS updated
FROM (SELECT DISTINCT doi FROM incoming) q""")
def r15_upsert_counts(t: Tables) -> DataFrame:
    rows = with_flag(t.incoming.groupBy("doi").agg(F.count("*").alias("n")), t.existing, [("doi", "doi")], "held")
    inserted = F.count_if(~F.col("held"))
    return rows.agg(inserted.alias("inserted"), (F.coalesce(F.sum("n"), F.lit(0)) - inserted).alias("updated"))


@query("""
WITH best AS (SELECT doi, source, max(source_details) AS d, max_by(title, (source_details, ordinal)) AS title FROM incoming WHERE source_type = 'initial' GROUP BY doi, source)
SELECT e.doi, CASE WHEN b.d > e.source_details AND e.source_type = 'initial' THEN b.d ELSE e.source_details END AS source_details,
  CASE WHEN b.d > e.source_details AND e.source_type = 'initial' THEN b.title ELSE e.title END AS title
FROM existing e LEFT JOIN best b ON e.doi = b.doi AND e.source = b.source""")
def r16_guarded_upsert(t: Tables) -> DataFrame:
    order = F.struct("source_details", "ordinal")
    best = t.incoming.where("source_type = 'initial'").groupBy("doi", "source").agg(F.max("source_details").alias("_d"), F.max_by("title", order).alias("_t"))
    joined = t.existing.join(best, ["doi", "source"], "left")
    newer = F.coalesce((F.col("_d") > F.col("source_details")) & (F.col("source_type") == "initial"), F.lit(False))
    return joined.select("doi", F.when(newer, F.col("_d")).otherwise(F.col("source_details")).alias("source_details"), F.when(newer, F.col("_t")).otherwise(F.col("title")).alias("title"))


@query("""
SELECT doi, min_by(title, ordinal) AS title, CASE WHEN min_by(coalesce(relevant, false), ordinal) THEN min_by(coalesce(download_status, ''), ordinal) ELSE '' END AS download_status
FROM incoming WHERE doi NOT IN (SELECT doi FROM existing) GROUP BY doi""")
def r17_insert_or_ignore(t: Tables) -> DataFrame:
    new = K.ignore_existing(t.existing, t.incoming, "doi", "ordinal", ["title", "relevant", "download_status"])
    status = F.when(F.col("relevant"), F.coalesce("download_status", F.lit(""))).otherwise("")
    return new.select("doi", "title", status.alias("download_status"))


@query("""
SELECT e.doi, coalesce(e.pmid, i.pmid) AS pmid FROM existing e
LEFT JOIN (SELECT doi, min(pmid) AS pmid FROM incoming GROUP BY doi) i ON e.doi = i.doi""")
def r18_backfill_pmids(t: Tables) -> DataFrame:
    other = t.incoming.groupBy("doi").agg(F.min("pmid").alias("_pmid"))
    return t.existing.join(other, "doi", "left").select("doi", F.coalesce("pmid", "_pmid").alias("pmid"))


@query("""
WITH i AS (SELECT doi, max(source_details) AS d, max_by(download_status, (source_details, ordinal)) AS s FROM incoming WHERE source_type = 'expansion' GROUP BY doi)
SELECT coalesce(e.doi, i.doi) AS doi,
  CASE WHEN e.doi IS NULL OR (e.source_type = 'expansion' AND i.d > e.source_details) THEN i.d ELSE e.source_details END AS source_details,
  CASE WHEN e.doi IS NULL THEN i.s WHEN e.source_type = 'expansion' AND i.d > e.source_details THEN coalesce(e.download_status, i.s) ELSE e.download_status END AS download_status
FROM existing e FULL JOIN i ON e.doi = i.doi""")
def r19_expansion_upsert(t: Tables) -> DataFrame:
    order = F.struct("source_details", "ordinal")
    i = t.incoming.where("source_type = 'expansion'").groupBy("doi").agg(F.max("source_details").alias("source_details"), F.max_by("download_status", order).alias("download_status"))
    i = i.withColumn("ordinal", F.lit(0))
    newer = lambda old, new: (F.col(f"{old}.source_type") == "expansion") & (F.col(f"{new}.source_details") > F.col(f"{old}.source_details"))  # noqa: E731  as text
    out = K.upsert(t.existing, i, "doi", "ordinal", {"source_details": K.LAST, "download_status": K.FILL}, newer)
    return out.select("doi", "source_details", "download_status")


@query("""
WITH i AS (SELECT doi, max_by(title, ordinal) AS title, max_by(coalesce(download_status, '-'), ordinal) AS s, max_by(CASE relevant WHEN true THEN 1 WHEN false THEN 0 ELSE 2 END, ordinal) AS r FROM incoming GROUP BY doi)
SELECT coalesce(e.doi, i.doi) AS doi, coalesce(e.title, i.title) AS title,
  CASE WHEN i.doi IS NULL THEN e.download_status ELSE nullif(i.s, '-') END AS download_status,
  CASE WHEN i.doi IS NULL THEN e.relevant WHEN i.r = 2 THEN NULL ELSE i.r = 1 END AS relevant
FROM existing e FULL JOIN i ON e.doi = i.doi""")
def r20_disposition_writeback(t: Tables) -> DataFrame:
    folds = {"title": K.Fold(lambda c, o: F.max_by(c, o), lambda old, new: old), "download_status": K.LAST, "relevant": K.LAST}
    return K.upsert(t.existing, t.incoming, "doi", "ordinal", folds).select("doi", "title", "download_status", "relevant")


@query("""
SELECT doi, max_by(relevant, ordinal) FILTER (WHERE relevant IS NOT NULL) AS relevant,
  nullif(substr(max(CASE download_status WHEN 'scheduled' THEN '1scheduled' WHEN 'manual_required' THEN '2manual_required' WHEN 'downloaded' THEN '3downloaded' ELSE '0' END), 2), '') AS download_status
FROM incoming GROUP BY doi""")
def r21_disposition_merge(t: Tables) -> DataFrame:
    verdict = F.max_by("relevant", F.when(F.col("relevant").isNotNull(), F.col("ordinal")))
    return t.incoming.groupBy("doi").agg(verdict.alias("relevant"), K.best_by_rank("download_status", ["scheduled", "manual_required", "downloaded"]).alias("download_status"))


@query("""
WITH p AS (SELECT DISTINCT hgnc_id FROM associations WHERE price > 1500),
n AS (SELECT hgnc_id, id AS position, 'new' AS name FROM associations WHERE price > 1500)
SELECT hgnc_id, position, disease AS name FROM associations WHERE hgnc_id NOT IN (SELECT hgnc_id FROM p)
UNION ALL SELECT hgnc_id, position, name FROM n""")
def r22_replace_children(t: Tables) -> DataFrame:
    parents = t.associations.where("price > 1500")
    children = parents.select("hgnc_id", F.col("id").alias("position"), F.lit("new").alias("name"))
    return K.replace_children(t.associations.select("hgnc_id", "position", F.col("disease").alias("name")), parents, children, "hgnc_id")


@query("""
SELECT coalesce(e.doi, i.doi) AS doi, coalesce(i.title, e.title) AS title FROM existing e
FULL JOIN (SELECT doi, max_by(title, ordinal) AS title FROM incoming GROUP BY doi) i ON e.doi = i.doi""")
def r23_last_write_wins(t: Tables) -> DataFrame:
    return K.upsert(t.existing.select("doi", "title"), t.incoming, "doi", "ordinal", {"title": K.LAST})


@query("""
WITH b AS (SELECT custom_id % 100 AS batch_id, status, completed_at FROM requests)
SELECT batch_id, CASE WHEN count(*) FILTER (WHERE status = 'pending') = 0 THEN max(completed_at) END AS collected_at, count(*) AS requests FROM b GROUP BY batch_id""")
def r24_batch_completion(t: Tables) -> DataFrame:
    b = t.requests.groupBy((F.col("custom_id") % 100).alias("batch_id"))
    return b.agg(F.when(~F.bool_or(F.col("status") == "pending"), F.max("completed_at")).alias("collected_at"), F.count("*").alias("requests"))


@query("""
WITH r AS (SELECT subject, max_by(model, (completed_at, custom_id)) AS model, max_by(coalesce(refusal_category, 'none'), (completed_at, custom_id)) AS category
  FROM requests WHERE status = 'refused' AND model = 'fallback' GROUP BY subject),
p AS (SELECT subject FROM requests WHERE status = 'pending' AND stage = 'screen' AND model = 'primary')
SELECT q.doi, 'refused by ' || r.model || ': ' || r.category AS settled FROM papers q JOIN r ON q.doi = '10.1/' || r.subject
WHERE q.relevant IS NULL AND r.subject NOT IN (SELECT subject FROM p)""")
def r25_settle_refused(t: Tables) -> DataFrame:
    order = F.struct("completed_at", "custom_id")
    refused = t.requests.where("status = 'refused' AND model = 'fallback'").groupBy("subject")
    refused = refused.agg(F.max_by("model", order).alias("model"), F.max_by(F.coalesce("refusal_category", F.lit("none")), order).alias("category"))
    refused = refused.join(t.requests.where("status = 'pending' AND stage = 'screen' AND model = 'primary'"), "subject", "left_anti")
    hit = t.papers.where("relevant IS NULL").join(refused, F.col("doi") == F.concat(F.lit("10.1/"), "subject"))
    return hit.select("doi", F.concat(F.lit("refused by "), "model", F.lit(": "), "category").alias("settled"))


@query("""
SELECT doi, CASE WHEN json_extract_string(relevance_json, '$.refused.model') IS NOT NULL THEN NULL ELSE relevance_json END AS relevance_json FROM papers""")
def r25_reopen_refused(t: Tables) -> DataFrame:
    from ..operators.predicates import refused

    return t.papers.select("doi", F.when(~refused(), F.col("relevance_json")).alias("relevance_json"))


@query("""
WITH s AS (SELECT download_status, doi IN (SELECT paper_doi FROM citations) AS kept FROM papers WHERE download_status IS NOT NULL)
SELECT download_status, count(*) FILTER (WHERE NOT kept) AS cleared, count(*) FILTER (WHERE kept) AS kept FROM s GROUP BY download_status""")
def r26_clear_unselected(t: Tables) -> DataFrame:
    flagged = with_flag(t.papers.where("download_status IS NOT NULL"), t.citations, [("doi", "paper_doi")], "selected")
    return flagged.groupBy("download_status").agg(F.count_if(~F.col("selected")).alias("cleared"), F.count_if("selected").alias("kept"))


@query("""
WITH c AS (SELECT p_partkey % 60 AS hgnc_id, p_partkey + 1000000 AS pmid, CAST(NULL AS VARCHAR) AS doi FROM part WHERE p_size % 2 = 0
  UNION ALL SELECT p_partkey % 60, NULL, upper('10.1/' || CAST(p_partkey AS STRING)) FROM part WHERE p_size % 2 = 1)
SELECT c.hgnc_id, p.doi AS paper_doi FROM c JOIN papers p ON c.pmid = p.pmid
UNION SELECT c.hgnc_id, p.doi FROM c JOIN papers p ON lower(c.doi) = lower(p.doi)""")
def r27_link_citations(t: Tables) -> DataFrame:
    gene = (F.col("p_partkey") % 60).alias("hgnc_id")
    by_pmid = t.part.where("p_size % 2 = 0").select(gene, (F.col("p_partkey") + 1000000).alias("pmid")).join(t.papers, "pmid").select("hgnc_id", F.col("doi").alias("paper_doi"))
    wanted = t.part.where("p_size % 2 = 1").select(gene, F.lower(F.concat(F.lit("10.1/"), F.col("p_partkey").cast("string"))).alias("key"))
    by_doi = wanted.join(t.papers.withColumn("key", F.lower("doi")), "key").select("hgnc_id", F.col("doi").alias("paper_doi"))
    return by_pmid.union(by_doi).distinct()


@query("SELECT doi, download_status FROM existing WHERE source_type <> 'expansion'")
def r28_force_wipe(t: Tables) -> DataFrame:
    return t.existing.where("NOT source_type = 'expansion'").select("doi", "download_status")
