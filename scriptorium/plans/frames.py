"""Literature tables made of the driver's tables, in SQL that both engines read.

``Tables`` gives a frame or a parquet table as a DataFrame; ``with_frames``
puts the frames an SQL text names before it, for the comparing engine.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

BASE = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "pages", "labels")

FRAMES = {
    # model requests: one attempt per event, subjects are users
    "requests": """
SELECT event_id AS custom_id, CASE event_id % 3 WHEN 0 THEN 'screen' WHEN 1 THEN 'extract' ELSE 'assess' END AS stage,
  CAST(user_id AS STRING) AS subject, CASE WHEN user_id % 3 = 0 AND event_type = 'view' THEN 1 WHEN user_id % 3 = 0 THEN 2 ELSE CAST(event_id % 4 AS INT) END AS round,
  CASE WHEN event_id % 2 = 0 THEN 'primary' ELSE 'fallback' END AS model,
  CASE WHEN event_id % 10 = 0 THEN 'batch' ELSE 'standard' END AS service_tier,
  CASE event_type WHEN 'error' THEN 'refused' WHEN 'signup' THEN 'pending' WHEN 'click' THEN 'errored' ELSE 'succeeded' END AS status,
  CASE WHEN event_type = 'error' THEN CASE event_id % 3 WHEN 0 THEN 'bio' WHEN 1 THEN 'cyber' ELSE NULL END END AS refusal_category,
  CASE WHEN event_type = 'click' AND event_id % 5 <> 0 THEN 'reason ' || CAST(event_id % 4 AS STRING) END AS rejection,
  CAST(floor(value) AS BIGINT) AS input_tokens, event_id % 97 AS output_tokens, event_id % 13 AS cache_read_tokens,
  CASE WHEN event_type = 'signup' THEN NULL ELSE ts END AS completed_at, props
FROM events""",
    "papers": """
SELECT '10.1/' || CAST(o_orderkey AS STRING) AS doi, CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE o_orderkey + 1000000 END AS pmid,
  'Paper ' || CAST(o_orderkey AS STRING) AS title, o_custkey % 40 AS issn, o_orderpriority AS source,
  CAST(o_orderdate AS DATE) AS source_date,
  CASE WHEN o_custkey % 5 = 0 THEN 'expansion' WHEN o_custkey % 7 = 0 THEN NULL ELSE 'initial' END AS source_type,
  CAST(o_custkey % 23 AS STRING) AS source_details,
  CASE WHEN o_orderstatus = 'F' THEN 'downloaded' WHEN o_orderstatus = 'P' THEN NULL WHEN o_orderkey % 6 = 0 THEN 'manual_required' ELSE 'scheduled' END AS download_status,
  CASE WHEN o_orderkey % 4 = 0 THEN NULL ELSE o_orderkey % 3 <> 0 END AS relevant,
  CASE WHEN o_orderkey % 4 = 0 THEN NULL
       WHEN o_orderkey % 11 = 0 THEN '{"relevant": false, "screen": null, "refused": {"model": "primary", "category": "bio"}}'
       WHEN o_orderkey % 3 <> 0 THEN '{"relevant": true, "screen": {"relevant": true, "confidence": "HIGH"}, "refused": null}'
       WHEN o_orderkey % 2 = 0 THEN '{"relevant": false, "screen": {"relevant": false, "confidence": "LOW"}}'
       ELSE '{"relevant": false, "screen": {"relevant": false, "confidence": "MEDIUM"}}' END AS relevance_json,
  CASE WHEN o_orderkey % 5 = 0 THEN '{"done": true}' END AS extraction_json,
  o_totalprice AS weight
FROM orders""",
    "mentions": """
SELECT DISTINCT l_partkey AS hgnc_id, '10.1/' || CAST(l_orderkey AS STRING) AS paper_doi,
  CASE l_returnflag WHEN 'R' THEN 'recent_evidence' WHEN 'A' THEN 'expansion_evidence' ELSE 'relevance_assessment' END AS source
FROM lineitem""",
    "citations": """
SELECT DISTINCT l_partkey AS hgnc_id, '10.1/' || CAST(l_orderkey AS STRING) AS paper_doi
FROM lineitem WHERE l_quantity > 40""",
    "journals": """
SELECT s_suppkey % 40 AS issn, max(CASE WHEN s_acctbal < 3000 THEN NULL ELSE s_acctbal END) AS citedness
FROM supplier WHERE s_suppkey % 40 < 35 GROUP BY s_suppkey % 40""",
    "associations": """
SELECT p_partkey AS id, p_partkey % 60 AS hgnc_id, p_partkey AS position, p_name AS disease,
  CASE WHEN p_size % 6 = 0 THEN NULL ELSE 'MONDO:' || CAST(p_partkey % 300 AS STRING) END AS mondo_id,
  CASE WHEN p_size % 6 = 0 THEN NULL WHEN p_size % 6 < 3 THEN 'gencc' ELSE 'exact' END AS mondo_match,
  p_size % 2 = 0 AS a, p_size % 3 = 0 AS b, p_size % 5 = 0 AS c, p_size % 7 <> 0 AS d, p_size % 4 <> 1 AS e,
  CASE WHEN p_size % 8 = 0 THEN NULL ELSE p_size % 4 END AS families,
  CASE p_size % 5 WHEN 0 THEN 'MONOALLELIC' WHEN 1 THEN 'BIALLELIC' WHEN 2 THEN 'X-LINKED' WHEN 3 THEN 'NR' ELSE 'Other' END AS moi,
  CASE p_size % 7 WHEN 0 THEN NULL ELSE p_size % 7 % 4 END AS listed_rating, p_size % 9 = 0 AS reviewed, p_retailprice AS price
FROM part""",
    "parents": """
SELECT p_partkey AS child, CAST(floor(p_partkey / 3) AS BIGINT) AS parent FROM part WHERE floor(p_partkey / 3) > 0
UNION ALL
SELECT p_partkey AS child, CAST(floor(p_partkey / 4) AS BIGINT) AS parent FROM part WHERE p_partkey % 4 = 2 AND floor(p_partkey / 4) > 0""",
    "snapshots": """
SELECT o_custkey % 50 AS panel_id, CAST(o_orderdate AS DATE) AS created,
  CASE WHEN o_orderkey % 17 = 0 THEN '0.0' ELSE CAST(o_orderkey % 5 AS STRING) || '.' || CAST(o_orderkey AS STRING) END AS version
FROM orders""",
    "scored": """
SELECT d.doc_id AS doc_id, l.quality AS label, CAST(d.n_chars % 1000 AS DOUBLE) / 1000 AS prob
FROM documents d JOIN labels l ON d.doc_id = l.doc_id""",
    "incoming": """
SELECT event_id AS ordinal, '10.2/' || CAST(user_id AS STRING) AS doi, CASE WHEN event_id % 3 = 0 THEN NULL ELSE event_id END AS pmid,
  'Title ' || CAST(event_id AS STRING) AS title, CASE event_type WHEN 'view' THEN 'pubmed' WHEN 'click' THEN 'pubmed' ELSE 'medrxiv' END AS source,
  CAST(event_id % 30 AS STRING) AS source_details, CASE WHEN event_id % 4 = 0 THEN 'expansion' ELSE 'initial' END AS source_type,
  CASE event_id % 5 WHEN 0 THEN NULL WHEN 1 THEN 'scheduled' WHEN 2 THEN 'manual_required' ELSE 'downloaded' END AS download_status,
  CASE event_id % 4 WHEN 0 THEN NULL WHEN 1 THEN false ELSE true END AS relevant
FROM events WHERE event_id % 2 = 1""",
    "existing": """
SELECT '10.2/' || CAST(c_custkey AS STRING) AS doi, CASE WHEN c_custkey % 2 = 0 THEN NULL ELSE c_custkey END AS pmid, c_name AS title,
  CASE WHEN c_custkey % 3 = 0 THEN 'medrxiv' ELSE 'pubmed' END AS source, CAST(c_custkey % 25 AS STRING) AS source_details,
  CASE WHEN c_custkey % 4 = 0 THEN 'expansion' ELSE 'initial' END AS source_type,
  CASE c_custkey % 4 WHEN 0 THEN NULL WHEN 1 THEN 'scheduled' WHEN 2 THEN 'downloaded' ELSE 'manual_required' END AS download_status,
  CASE c_custkey % 3 WHEN 0 THEN NULL WHEN 1 THEN true ELSE false END AS relevant,
  DATE '2024-01-01' AS first_seen, DATE '2024-02-01' AS last_seen
FROM customer WHERE c_custkey % 3 <> 1""",
}


def _named(sql: str, names) -> list[str]:
    return [n for n in names if re.search(rf"\b(?:FROM|JOIN|from|join|,)\s+{n}\b", sql)]


class Tables:
    """Frames and parquet tables of a folder, by attribute."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def __getattr__(self, name: str) -> DataFrame:
        if name in BASE:
            return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")
        if name not in FRAMES:
            raise AttributeError(name)
        sql = FRAMES[name]
        used = _named(sql, BASE)
        for n in used:
            sql = re.sub(rf"\b(FROM|JOIN)\s+{n}\b", rf"\1 {{{n}}}", sql)
        return self.spark.sql(_braced(sql, used), **{n: getattr(self, n) for n in used})


def _braced(sql: str, used: list[str]) -> str:
    """Braces of JSON texts doubled, those of table names kept."""
    out = sql.replace("{", "{{").replace("}", "}}")
    for n in used:
        out = out.replace(f"{{{{{n}}}}}", f"{{{n}}}")
    return out


def with_frames(sql: str) -> str:
    """The SQL with the frames that it names as common table expressions."""
    heads = [f"{n} AS ({FRAMES[n]})" for n in _named(sql, FRAMES)]
    if not heads:
        return sql
    body = sql.strip()
    if m := re.match(r"WITH\s+(RECURSIVE\s+)?", body):
        return f"WITH {m[1] or ''}{', '.join(heads)}, {body[m.end():]}"
    return f"WITH {', '.join(heads)} {body}"
