"""Plans that select over rounds, and classifier inference with a pluggable scorer."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import inference
from ..operators.select import tournament
from .frames import Tables
from .query import query


@query("""
WITH s AS (SELECT l_suppkey % 10 AS gene, l_partkey AS paper, max(l_quantity * 1000 + l_orderkey % 1000) AS v FROM lineitem GROUP BY ALL),
p AS (SELECT *, row_number() OVER (PARTITION BY gene ORDER BY paper) AS place, count(*) OVER (PARTITION BY gene) AS n FROM s),
r1 AS (SELECT *, row_number() OVER (PARTITION BY gene, floor((place - 1) / 100) ORDER BY v DESC, place) AS b FROM p WHERE n > 20),
k1 AS (SELECT gene, paper, v, row_number() OVER (PARTITION BY gene ORDER BY place) AS place, count(*) OVER (PARTITION BY gene) AS m, n FROM r1 WHERE b <= 20),
r2 AS (SELECT *, row_number() OVER (PARTITION BY gene, floor((place - 1) / 100) ORDER BY v DESC, place) AS b FROM k1 WHERE n > 100),
k2 AS (SELECT gene, paper, v, row_number() OVER (PARTITION BY gene ORDER BY place) AS place, m, count(*) OVER (PARTITION BY gene) AS m2 FROM r2 WHERE b <= 20),
r3 AS (SELECT *, row_number() OVER (PARTITION BY gene ORDER BY v DESC, place) AS b FROM k2 WHERE m > 100)
SELECT gene, paper FROM p WHERE n <= 20 UNION ALL SELECT gene, paper FROM k1 WHERE n <= 100 UNION ALL SELECT gene, paper FROM k2 WHERE m <= 100 UNION ALL SELECT gene, paper FROM r3 WHERE m2 <= 100 AND b <= 20""")
def g7_tournament(t: Tables) -> DataFrame:
    s = t.lineitem.groupBy((F.col("l_suppkey") % 10).alias("gene"), F.col("l_partkey").alias("paper")).agg(F.max(F.col("l_quantity") * 1000 + F.col("l_orderkey") % 1000).alias("v"))
    return tournament(s, "gene", "paper", 20, 100, 20, lambda df: F.col("v"), [F.asc("paper")])


@query("SELECT doc_id, length(text) % 7 >= 4 AS positive FROM documents")
def u2_classifier_inference(t: Tables) -> DataFrame:
    return inference.classify(t.documents, "doc_id", [F.col("text")], inference.length_scorer, 4 / 7).select("doc_id", "positive")


@query("""
SELECT l.doc_id, l.quality = 1 OR l.toxic = 1 AS is_relevant, d.doc_id IS NOT NULL AS known FROM labels l LEFT JOIN (SELECT DISTINCT doc_id FROM documents WHERE n_chars > 500) d ON l.doc_id = d.doc_id""")
def u4_label_extraction(t: Tables) -> DataFrame:
    known = t.documents.where("n_chars > 500").select("doc_id").distinct().withColumn("known", F.lit(True))
    joined = t.labels.join(known, "doc_id", "left")
    return joined.select("doc_id", ((F.col("quality") == 1) | (F.col("toxic") == 1)).alias("is_relevant"), F.coalesce("known", F.lit(False)).alias("known"))


@query("""
WITH p AS (SELECT CAST(n_chars % 1000 AS DOUBLE) / 1000 AS p, CAST(quality AS DOUBLE) AS y FROM documents d JOIN labels l ON d.doc_id = l.doc_id)
SELECT round(avg(-0.25 * power(1 - pt, 2) * ln(pt)), 9) AS loss FROM (SELECT greatest(least(CASE WHEN y = 1 THEN p ELSE 1 - p END, 0.999999), 0.000001) AS pt FROM p) q""")
def u3_focal_loss(t: Tables) -> DataFrame:
    return t.scored.agg(F.round(F.avg(inference.focal_loss(F.col("prob"), F.col("label"))), 9).alias("loss"))
