"""Plans over aggregates: counts by status, histories, usage, metrics."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import metrics as M
from .frames import Tables
from .query import query


@query("SELECT download_status, count(*) AS n FROM papers WHERE download_status IS NOT NULL GROUP BY download_status")
def a1_count_by_status(t: Tables) -> DataFrame:
    return t.papers.where("download_status IS NOT NULL").groupBy("download_status").agg(F.count("*").alias("n"))


@query("SELECT hgnc_id, count(DISTINCT paper_doi) AS papers FROM mentions GROUP BY hgnc_id HAVING count(DISTINCT paper_doi) > 30")
def a2_genes_to_reduce(t: Tables) -> DataFrame:
    return t.mentions.groupBy("hgnc_id").agg(F.countDistinct("paper_doi").alias("papers")).where("papers > 30").orderBy(F.desc("papers"), "hgnc_id")


@query("""
SELECT DISTINCT paper_doi FROM mentions WHERE hgnc_id IN (SELECT hgnc_id FROM mentions GROUP BY hgnc_id HAVING count(DISTINCT paper_doi) <= 25)""")
def a3_papers_of_small_genes(t: Tables) -> DataFrame:
    small = t.mentions.groupBy("hgnc_id").agg(F.countDistinct("paper_doi").alias("n")).where("n <= 25")
    return t.mentions.join(small, "hgnc_id", "left_semi").select("paper_doi").distinct()


@query("""
SELECT coalesce(sum(CASE WHEN source_type = 'expansion' THEN 1 ELSE 0 END), 0) AS expansion,
  coalesce(sum(CASE WHEN source_type IS DISTINCT FROM 'expansion' AND relevant THEN 1 ELSE 0 END), 0) AS relevant,
  coalesce(sum(CASE WHEN source_type IS DISTINCT FROM 'expansion' AND relevant = false THEN 1 ELSE 0 END), 0) AS irrelevant,
  coalesce(sum(CASE WHEN source_type IS DISTINCT FROM 'expansion' AND relevant IS NULL THEN 1 ELSE 0 END), 0) AS unassessed FROM papers""")
def a4_exclusive_buckets(t: Tables) -> DataFrame:
    first = ~F.col("source_type").eqNullSafe("expansion")
    return t.papers.agg(
        F.count_if(~first).alias("expansion"),
        F.count_if(first & F.col("relevant")).alias("relevant"),
        F.count_if(first & ~F.col("relevant")).alias("irrelevant"),
        F.count_if(first & F.col("relevant").isNull()).alias("unassessed"),
    )


#: Example prices in USD per million tokens: input, output, cache read.
PRICES = [("primary", 5.0, 25.0, 0.5), ("fallback", 3.0, 15.0, 0.3)]


@query("""
WITH prices(model, inp, outp, cached) AS (VALUES ('primary', 5.0::DOUBLE, 25.0::DOUBLE, 0.5::DOUBLE), ('fallback', 3.0::DOUBLE, 15.0::DOUBLE, 0.3::DOUBLE))
SELECT r.stage, r.model, r.service_tier, count(*) AS requests, count(*) FILTER (WHERE status = 'succeeded') AS succeeded,
  count(*) FILTER (WHERE status = 'refused') AS refused, count(*) FILTER (WHERE status = 'errored') AS errored,
  sum(input_tokens)::BIGINT AS input_tokens, sum(output_tokens)::BIGINT AS output_tokens,
  round((sum(input_tokens) * max(inp) + sum(output_tokens) * max(outp) + sum(cache_read_tokens) * max(cached)) / 1e6 * max(CASE WHEN r.service_tier = 'batch' THEN 0.5::DOUBLE ELSE 1.0::DOUBLE END), 6) AS usd
FROM requests r JOIN prices p ON r.model = p.model GROUP BY r.stage, r.model, r.service_tier""")
def a5_usage(t: Tables) -> DataFrame:
    prices = F.create_map(*(x for m, *p in PRICES for x in (F.lit(m), F.array(*map(F.lit, p)))))
    g = t.requests.groupBy("stage", "model", "service_tier").agg(
        F.count("*").alias("requests"),
        *(F.count_if(F.col("status") == s).alias(s) for s in ("succeeded", "refused", "errored")),
        *(F.sum(c).alias(c) for c in ("input_tokens", "output_tokens", "cache_read_tokens")),
    )
    price = prices[F.col("model")]
    cost = F.col("input_tokens") * price[0] + F.col("output_tokens") * price[1] + F.col("cache_read_tokens") * price[2]
    tier = F.when(F.col("service_tier") == "batch", 0.5).otherwise(1.0)
    return g.withColumn("usd", F.round(cost / 1e6 * tier, 6)).drop("cache_read_tokens")


@query("""
SELECT subject, count(*) AS failures, max_by(coalesce(rejection, 'unusable'), (completed_at, custom_id)) AS last_rejection
FROM requests WHERE status = 'errored' GROUP BY subject HAVING count(*) >= 2""")
def a6_failed_for_good(t: Tables) -> DataFrame:
    last = F.max_by(F.coalesce("rejection", F.lit("unusable")), F.struct("completed_at", "custom_id"))
    return t.requests.where("status = 'errored'").groupBy("subject").agg(F.count("*").alias("failures"), last.alias("last_rejection")).where("failures >= 2")


@query("""
SELECT subject, bool_or(model = 'primary') AS by_primary, bool_or(model = 'fallback') AS by_fallback,
  CASE WHEN bool_or(model = 'fallback') THEN 'skip' ELSE 'fallback' END AS next_model
FROM requests WHERE status = 'refused' AND completed_at >= TIMESTAMP '2024-01-05' GROUP BY subject""")
def a7_refusals_by_model(t: Tables) -> DataFrame:
    r = t.requests.where("status = 'refused' AND completed_at >= timestamp '2024-01-05'").groupBy("subject")
    r = r.agg(F.bool_or(F.col("model") == "primary").alias("by_primary"), F.bool_or(F.col("model") == "fallback").alias("by_fallback"))
    return r.withColumn("next_model", F.when(F.col("by_fallback"), "skip").otherwise("fallback"))


@query("""
WITH o(outcome) AS (VALUES ('succeeded'), ('refused'), ('errored'), ('expired')),
l AS (SELECT stage, subject, max_by(status, (completed_at, custom_id)) AS status FROM requests WHERE status <> 'pending' GROUP BY stage, subject)
SELECT o.outcome, count(l.status) AS n FROM o LEFT JOIN l ON o.outcome = l.status GROUP BY o.outcome""")
def a8_outcome_counts(t: Tables) -> DataFrame:
    kinds = t.spark.createDataFrame([(x,) for x in ("succeeded", "refused", "errored", "expired")], "outcome string")
    last = t.requests.where("status <> 'pending'").groupBy("stage", "subject").agg(F.max_by("status", F.struct("completed_at", "custom_id")).alias("status"))
    counts = last.groupBy(F.col("status").alias("outcome")).agg(F.count("*").alias("n"))
    return kinds.join(counts, "outcome", "left").select("outcome", F.coalesce("n", F.lit(0)).alias("n"))


@query("""
SELECT subject, max_by(coalesce(refusal_category, ''), (completed_at, custom_id)) AS refusal_category, count(*) AS n FROM requests WHERE status = 'refused' GROUP BY subject""")
def a9_value_of_latest_row(t: Tables) -> DataFrame:
    r = t.requests.where("status = 'refused'").groupBy("subject")
    return r.agg(F.max_by(F.coalesce("refusal_category", F.lit("")), F.struct("completed_at", "custom_id")).alias("refusal_category"), F.count("*").alias("n"))


@query("""
WITH g AS (SELECT l_partkey AS gene, l_suppkey AS panel, max(l_quantity) AS q FROM lineitem GROUP BY l_partkey, l_suppkey)
SELECT gene, max(q) AS confidence, count(*) AS panels FROM g GROUP BY gene""")
def a10_max_per_key(t: Tables) -> DataFrame:
    by_panel = t.lineitem.groupBy(F.col("l_partkey").alias("gene"), F.col("l_suppkey").alias("panel")).agg(F.max("l_quantity").alias("q"))
    return by_panel.groupBy("gene").agg(F.max("q").alias("confidence"), F.count("*").alias("panels"))


@query("""
SELECT hgnc_id, string_agg(DISTINCT moi, ',' ORDER BY moi) AS modes, count(DISTINCT disease) AS diseases FROM associations GROUP BY hgnc_id""")
def a11_sorted_sets(t: Tables) -> DataFrame:
    return t.associations.groupBy("hgnc_id").agg(F.array_join(F.array_sort(F.collect_set("moi")), ",").alias("modes"), F.countDistinct("disease").alias("diseases"))


@query("SELECT hgnc_id, bool_and(reviewed) AS all_reviewed, bool_or(reviewed) AS any_reviewed FROM associations GROUP BY hgnc_id")
def a12_boolean_aggregates(t: Tables) -> DataFrame:
    return t.associations.groupBy("hgnc_id").agg(F.bool_and("reviewed").alias("all_reviewed"), F.bool_or("reviewed").alias("any_reviewed"))


@query("""
SELECT (SELECT count(*) FROM papers) AS papers, (SELECT count(DISTINCT paper_doi) FROM mentions) AS mentioned,
  (SELECT count(*) FROM (SELECT DISTINCT hgnc_id, mondo_id FROM associations WHERE mondo_id IS NOT NULL) q) AS pairs,
  (SELECT count(*) FROM associations WHERE listed_rating IS NULL) AS unlisted""")
def a13_report_statistics(t: Tables) -> DataFrame:
    parts = [
        t.papers.agg(F.count("*").alias("papers")),
        t.mentions.agg(F.countDistinct("paper_doi").alias("mentioned")),
        t.associations.agg(F.countDistinct("hgnc_id", "mondo_id").alias("pairs"), F.count_if(F.col("listed_rating").isNull()).alias("unlisted")),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.join(F.broadcast(p))  # rows of one-row frames
    return out


@query("SELECT DISTINCT stage, subject FROM requests")
def a14_distinct(t: Tables) -> DataFrame:
    return t.requests.select("stage", "subject").distinct()


@query("""
WITH n AS (SELECT p_partkey AS term, lower(p_name) AS name FROM part UNION ALL SELECT p_partkey, lower(p_type) FROM part),
k AS (SELECT DISTINCT term, unnest(string_split_regex(name, '[^a-z0-9]+')) AS token FROM n),
s AS (SELECT count(DISTINCT p_partkey) AS n FROM part)
SELECT token, count(DISTINCT term) AS df, round(ln(1 + max(s.n) / count(DISTINCT term)::DOUBLE), 9) AS idf FROM k, s WHERE token <> '' GROUP BY token""")
def a15_inverse_document_frequency(t: Tables) -> DataFrame:
    from ..operators.search import token_weights

    names = t.part.select(F.col("p_partkey").alias("term"), F.col("p_name").alias("name")).union(t.part.select("p_partkey", "p_type"))
    total = t.part.agg(F.countDistinct("p_partkey")).scalar()
    lower = lambda name: F.lower(F.translate(name, "İ", "i"))  # noqa: E731  # one letter in the SQL, two in Spark
    return token_weights(names, total, lambda name: F.filter(F.split(lower(name), "[^a-z0-9]+"), lambda x: x != ""))


_CURVE = """
WITH b AS (SELECT prob, sum(label) AS p, sum(1 - label) AS n FROM scored GROUP BY prob),
c AS (SELECT prob, sum(p) OVER (ORDER BY prob DESC) AS tp, sum(n) OVER (ORDER BY prob DESC) AS fp, sum(p) OVER () AS pos FROM b)"""


@query(f"""{_CURVE},
r AS (SELECT prob, tp / pos::DOUBLE AS recall, tp / (tp + fp)::DOUBLE AS prec FROM c),
x AS (SELECT (recall - coalesce(lag(recall) OVER w, 0)) * (prec + coalesce(lag(prec) OVER w, 1)) / 2 AS area FROM r WINDOW w AS (ORDER BY prob DESC))
SELECT round(sum(area), 9) AS pr_auc FROM x""")
def a16_pr_auc(t: Tables) -> DataFrame:
    return M.pr_auc(M.curve(t.scored))


@query(f"{_CURVE} SELECT max(prob) AS threshold FROM c WHERE tp >= 0.9 * pos")
def a16_threshold_for_recall(t: Tables) -> DataFrame:
    return M.threshold_for(M.curve(t.scored), 0.9)


@query("""
WITH c AS (SELECT count(*) FILTER (WHERE prob >= 0.5 AND label = 1) AS tp, count(*) FILTER (WHERE prob >= 0.5 AND label = 0) AS fp,
  count(*) FILTER (WHERE prob < 0.5 AND label = 1) AS fn, count(*) FILTER (WHERE prob < 0.5 AND label = 0) AS tn FROM scored)
SELECT *, round(tp / (tp + fn)::DOUBLE, 9) AS recall, round(tp / (tp + fp)::DOUBLE, 9) AS precision, round(fp / (fp + tn)::DOUBLE, 9) AS false_positive_rate FROM c""")
def a16_confusion(t: Tables) -> DataFrame:
    return M.confusion(t.scored, 0.5)


@query("""
WITH s AS (SELECT hgnc_id, max(families) AS suggested FROM associations GROUP BY hgnc_id), a AS (SELECT l_partkey AS hgnc_id, count(*) % 4 AS actual FROM lineitem GROUP BY l_partkey)
SELECT CASE WHEN a.hgnc_id IS NULL THEN 'not_executed' WHEN s.suggested = a.actual THEN 'concordant' ELSE 'discordant' END AS status, count(*) AS n
FROM s LEFT JOIN a ON s.hgnc_id = a.hgnc_id GROUP BY 1""")
def a17_concordance(t: Tables) -> DataFrame:
    suggested = t.associations.groupBy("hgnc_id").agg(F.max("families").alias("suggested"))
    actual = t.lineitem.groupBy(F.col("l_partkey").alias("hgnc_id")).agg((F.count("*") % 4).alias("actual"))
    status = F.when(F.col("actual").isNull(), "not_executed").when(F.col("suggested") == F.col("actual"), "concordant").otherwise("discordant")
    return suggested.join(actual, "hgnc_id", "left").groupBy(status.alias("status")).agg(F.count("*").alias("n"))


@query("""
SELECT panel_id, date_trunc('month', created)::DATE AS month, min_by(version, (created, version)) AS first_version, count(*) AS versions FROM snapshots GROUP BY 1, 2""")
def a18_first_version_by_month(t: Tables) -> DataFrame:
    return t.snapshots.groupBy("panel_id", F.trunc("created", "MM").alias("month")).agg(F.min_by("version", F.struct("created", "version")).alias("first_version"), F.count("*").alias("versions"))


@query("""
WITH r AS (SELECT date_trunc('month', o_orderdate)::DATE AS month, o_orderstatus AS rating, count(*) AS n FROM orders GROUP BY 1, 2)
SELECT month, coalesce(sum(n) FILTER (WHERE rating = 'F'), 0)::BIGINT AS f, coalesce(sum(n) FILTER (WHERE rating = 'O'), 0)::BIGINT AS o, coalesce(sum(n) FILTER (WHERE rating = 'P'), 0)::BIGINT AS p FROM r GROUP BY month""")
def a18_months_by_rating(t: Tables) -> DataFrame:
    by = t.orders.groupBy(F.trunc(F.col("o_orderdate"), "MM").alias("month")).pivot("o_orderstatus", ["F", "O", "P"]).agg(F.count("o_orderkey"))
    return by.select("month", *(F.coalesce(c, F.lit(0)).alias(c.lower()) for c in ("F", "O", "P")))


