"""Plans over the rating and finding rules."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import rules as R
from .frames import Tables
from .query import query

_RATING = "CASE WHEN (a OR b OR c) AND d AND e THEN 3 WHEN coalesce(families, 0) > 1 THEN 2 ELSE 1 END"


def _rating():
    return R.association_rating(*map(F.col, "abcde"), F.col("families"))


@query(f"SELECT hgnc_id, max({_RATING}) AS rating, count(*) AS associations FROM associations GROUP BY hgnc_id")
def m1_gene_rating(t: Tables) -> DataFrame:
    return t.associations.groupBy("hgnc_id").agg(F.max(_rating()).alias("rating"), F.count("*").alias("associations"))


@query(f"""
SELECT id, CASE WHEN reviewed OR position % 4 = 0 THEN NULL WHEN listed_rating IS NULL THEN 'new_gene' WHEN moi = 'BIALLELIC' AND coalesce(families, 0) >= 2 THEN 'new_mode'
  WHEN {_RATING} > listed_rating THEN 'upgrade' END AS finding FROM associations""")
def m2_findings(t: Tables) -> DataFrame:
    older = F.col("position") % 4 == 0
    return t.associations.select("id", R.finding(_rating(), F.col("listed_rating"), F.col("reviewed"), F.col("moi") == "BIALLELIC", F.col("families"), older).alias("finding"))


@query("""
WITH f AS (SELECT m.paper_doi, max(a.families) AS families FROM mentions m JOIN associations a ON m.hgnc_id = a.hgnc_id GROUP BY m.paper_doi)
SELECT p.doi, CASE WHEN p.pmid IS NOT NULL THEN NULL WHEN f.families IS NULL THEN 'preprint without family counts' WHEN f.families < 3 THEN 'preprint with fewer than 3 families' END AS reason
FROM papers p JOIN f ON p.doi = f.paper_doi""")
def m3_preprint_gate(t: Tables) -> DataFrame:
    by_gene = t.associations.groupBy("hgnc_id").agg(F.max("families").alias("families"))
    f = t.mentions.join(by_gene, "hgnc_id").groupBy("paper_doi").agg(F.max("families").alias("families"))
    return t.papers.join(f, F.col("doi") == F.col("paper_doi")).select("doi", R.preprint_gate(F.col("pmid").isNull(), F.col("families"), 3).alias("reason"))


@query("""
WITH v AS (SELECT id, moi, position % 70 AS het, position % 40 AS hom, position % 50 AS hemi FROM associations)
SELECT id, CASE WHEN moi = 'BIALLELIC' THEN CASE WHEN hom > 15 THEN 'hom' END WHEN moi = 'X-LINKED' THEN CASE WHEN hemi > 30 THEN 'hemi' END ELSE CASE WHEN het > 30 THEN 'het' END END AS flag FROM v""")
def m4_frequency_flags(t: Tables) -> DataFrame:
    p = F.col("position")
    return t.associations.select("id", R.frequency_flag(F.col("moi"), p % 70, p % 40, p % 50).alias("flag"))


@query("""
WITH v AS (SELECT id, families AS independent, position % 3 AS reported, position % 5 AS total FROM associations)
SELECT id, CASE WHEN independent IS NULL THEN 'unknown' WHEN independent = reported THEN 'reported' WHEN independent < total THEN 'reduced' ELSE 'derived' END AS how FROM v""")
def m5_derived_families(t: Tables) -> DataFrame:
    p = F.col("position")
    return t.associations.select("id", R.derived_families(p % 3, p % 5, F.col("families")).alias("how"))


@query("""
WITH a AS (SELECT p_partkey % 700 AS gene, CASE WHEN moi IN ('X-LINKED', 'Other') AND id % 3 <> 0 THEN 'BOTH' ELSE moi END AS moi,
  CASE id % 5 WHEN 0 THEN 'mosaic; imprinted, paternal allele expressed' WHEN 1 THEN 'imprinted, maternal allele expressed' ELSE '' END AS details FROM (SELECT *, id AS p_partkey FROM associations) q),
s AS (SELECT gene, list(DISTINCT moi) FILTER (WHERE moi <> 'NR') AS k, bool_or(moi = 'MONOALLELIC' AND details LIKE '%paternal%') AS p, bool_or(moi = 'MONOALLELIC' AND details LIKE '%maternal%') AS m FROM a GROUP BY gene),
k AS (SELECT gene, p, m, CASE WHEN len(list_filter(k, lambda x: x <> 'Other')) > 0 THEN list_filter(k, lambda x: x <> 'Other') ELSE coalesce(k, []) END AS k FROM s)
SELECT gene, CASE WHEN len(k) = 0 THEN 'Unknown' WHEN k = ['MONOALLELIC'] AND p AND m THEN 'MONOALLELIC, autosomal or pseudoautosomal, imprinted status unknown'
  WHEN k = ['MONOALLELIC'] AND p THEN 'MONOALLELIC, autosomal or pseudoautosomal, maternally imprinted (paternal allele expressed)'
  WHEN k = ['MONOALLELIC'] AND m THEN 'MONOALLELIC, autosomal or pseudoautosomal, paternally imprinted (maternal allele expressed)'
  WHEN k = ['MONOALLELIC'] THEN 'MONOALLELIC, autosomal or pseudoautosomal, NOT imprinted' WHEN len(k) = 1 THEN k[1]
  WHEN len(list_filter(k, lambda x: x NOT IN ('BOTH', 'MONOALLELIC', 'BIALLELIC'))) = 0 THEN 'BOTH' ELSE 'Other' END AS mode FROM k""")
def m6_modes_of_inheritance(t: Tables) -> DataFrame:
    mode = F.when(F.col("moi").isin("X-LINKED", "Other") & (F.col("id") % 3 != 0), "BOTH").otherwise(F.col("moi"))
    details = F.when(F.col("id") % 5 == 0, "mosaic; imprinted, paternal allele expressed").when(F.col("id") % 5 == 1, R.MATERNAL).otherwise("")
    rows = t.associations.groupBy((F.col("id") % 700).alias("gene")).agg(F.collect_list(F.struct(mode.alias("mode"), details.alias("details"))).alias("rows"))
    return rows.select("gene", R.panel_mode(F.col("rows")).alias("mode"))


@query("""
SELECT hgnc_id, id AS best FROM (SELECT hgnc_id, id, row_number() OVER (PARTITION BY hgnc_id ORDER BY coalesce(families, -1) DESC, id) AS n FROM associations) q WHERE n = 1""")
def m7_best_candidate(t: Tables) -> DataFrame:
    rows = t.associations.groupBy("hgnc_id").agg(F.collect_list(F.struct("id", "families")).alias("rows"))
    return rows.select("hgnc_id", R.best_candidate(F.col("rows"), "families", "id")["id"].alias("best"))


@query("SELECT id, round(position / nullif(position % 90, 0)::DOUBLE, 9) AS frequency FROM associations")
def m8_allele_frequency(t: Tables) -> DataFrame:
    an = F.nullif(F.col("position") % 90, F.lit(0))
    return t.associations.select("id", F.round(F.col("position") / an, 9).alias("frequency"))


@query("""
WITH s AS (SELECT p.doi, p.extraction_json IS NOT NULL AS stored, EXISTS (SELECT 1 FROM requests r WHERE '10.1/' || r.subject = p.doi AND r.status = 'refused') AS refused,
  EXISTS (SELECT 1 FROM requests r WHERE '10.1/' || r.subject = p.doi AND r.status = 'errored') AS failed FROM papers p)
SELECT CASE WHEN stored THEN 'stored' WHEN refused THEN 'refused' WHEN failed THEN 'failed' ELSE 'not_run' END AS state, count(*) AS n FROM s GROUP BY 1""")
def g17_stage_states(t: Tables) -> DataFrame:
    by = t.requests.groupBy(F.concat(F.lit("10.1/"), "subject").alias("doi")).agg(F.bool_or(F.col("status") == "refused").alias("refused"), F.bool_or(F.col("status") == "errored").alias("failed"))
    s = t.papers.join(by, "doi", "left")
    no = lambda c: F.coalesce(F.col(c), F.lit(False))
    return s.groupBy(R.stage_state(F.col("extraction_json").isNotNull(), no("refused"), no("failed")).alias("state")).agg(F.count("*").alias("n"))
