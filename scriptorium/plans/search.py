"""Plans over the term graph and the name search."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..operators import graph as G
from ..operators import search as S
from .frames import Tables
from .query import query


@query("""
WITH RECURSIVE d AS (SELECT 2::BIGINT AS node UNION SELECT 5::BIGINT UNION SELECT p.child FROM parents p JOIN d ON p.parent = d.node) SELECT DISTINCT node FROM d""")
def g1_descendants(t: Tables) -> DataFrame:
    roots = t.spark.createDataFrame([(2,), (5,)], "root long")
    return G.descendants(t.parents, roots).select("node")


@query("""
WITH RECURSIVE a AS (SELECT p_partkey AS root, p_partkey AS node, 0 AS distance FROM part WHERE p_partkey % 100 = 0
  UNION SELECT a.root, p.parent, a.distance + 1 FROM a JOIN parents p ON p.child = a.node)
SELECT root, node, min(distance) AS distance FROM a GROUP BY root, node""")
def g2_ancestors(t: Tables) -> DataFrame:
    return G.ancestors(t.parents, t.part.where("p_partkey % 100 = 0").select(F.col("p_partkey").alias("root")))


@query("""
WITH RECURSIVE l AS (SELECT p_partkey AS root, p_partkey AS node, 0 AS level FROM part WHERE p_partkey % 100 = 0
  UNION SELECT l.root, p.child, l.level + 1 FROM l JOIN parents p ON p.parent = l.node JOIN part e ON e.p_partkey = p.child WHERE l.level < 3 AND e.p_size % 10 <> 0)
SELECT root, node, min(level) AS level FROM l GROUP BY root, node HAVING min(level) > 0""")
def g3_levels(t: Tables) -> DataFrame:
    eligible = t.part.where("p_size % 10 <> 0").select(F.col("p_partkey").alias("node"))
    return G.levels(t.parents, t.part.where("p_partkey % 100 = 0").select(F.col("p_partkey").alias("root")), eligible)


@query("SELECT p_brand AS xref, string_agg(CAST(p_partkey AS VARCHAR), ',' ORDER BY lower(p_name), p_partkey) AS terms FROM part GROUP BY p_brand")
def g4_lookup_by_xref(t: Tables) -> DataFrame:
    rows = F.array_sort(F.collect_list(F.struct(F.lower("p_name").alias("n"), F.col("p_partkey").alias("k"))))
    return t.part.groupBy(F.col("p_brand").alias("xref")).agg(F.array_join(F.transform(rows, lambda r: r["k"].cast("string")), ",").alias("terms"))


_TOKENS = "list_filter(string_split_regex(lower({}), '[^a-z0-9]+'), lambda x: x <> '' AND x NOT IN ('a', 'an', 'and', 'associated', 'by', 'due', 'for', 'in', 'of', 'or', 'related', 'the', 'to', 'type', 'with'))"
_SEARCH = f"""
WITH names AS (SELECT p_partkey AS term, p_name AS name, 0 AS kind FROM part UNION ALL SELECT p_partkey, p_type, 1 FROM part UNION ALL SELECT p_partkey, p_brand || ' of ' || p_name, 2 FROM part),
asked AS (SELECT DISTINCT p_type || ' extra' AS q FROM part WHERE p_partkey % 100 = 0 UNION SELECT DISTINCT p_name FROM part WHERE p_partkey % 100 = 0 UNION SELECT DISTINCT p_type || ' of the TYPE' FROM part WHERE p_partkey % 100 = 0),
nt AS (SELECT term, kind, {_TOKENS.format("name")} AS toks FROM names),
total AS (SELECT count(DISTINCT term) AS n FROM names),
idf AS (SELECT token, round(ln(1 + max(n) / count(DISTINCT term)::DOUBLE), 9) AS w FROM (SELECT term, unnest(toks) AS token FROM nt) x, total GROUP BY token),
ns AS (SELECT DISTINCT term, kind, array_to_string(toks, ' ') AS seq, len(list_distinct(toks)) AS size, unnest(list_distinct(toks)) AS token FROM nt),
qt AS (SELECT q, {_TOKENS.format("q")} AS toks FROM asked),
qs AS (SELECT q, array_to_string(toks, ' ') AS aseq, unnest(list_distinct(toks)) AS token FROM qt),
qw AS (SELECT qs.*, coalesce(idf.w, ln(1.0 + total.n)) AS w, sum(coalesce(idf.w, ln(1.0 + total.n))) OVER (PARTITION BY q) AS qsum FROM qs LEFT JOIN idf ON qs.token = idf.token, total),
h AS (SELECT q, term, kind, seq, max(aseq) AS aseq, max(qsum) AS qsum, max(size) AS size, sum(w) AS common, count(*) AS shared FROM qw JOIN ns ON qw.token = ns.token GROUP BY q, term, kind, seq),
s AS (SELECT q, term, CASE WHEN seq = aseq THEN kind ELSE 3 END AS tier, CASE WHEN seq = aseq THEN 0 ELSE round(common / qsum, 6) END AS coverage, CASE WHEN seq = aseq THEN 0 ELSE round(shared / size, 6) END AS prec FROM h),
b AS (SELECT *, row_number() OVER (PARTITION BY q, term ORDER BY tier, coverage DESC, prec DESC) AS best FROM s),
r AS (SELECT q, term, tier, coverage, prec, row_number() OVER (PARTITION BY q ORDER BY tier, coverage DESC, prec DESC, lower(p_name), term) AS rank FROM b JOIN part ON term = p_partkey WHERE best = 1),
x AS (SELECT q.q, p.p_partkey AS term, row_number() OVER (PARTITION BY q.q ORDER BY p.p_partkey) AS rank FROM (SELECT DISTINCT 'Orpha: ' || p_size AS q, p_size FROM part WHERE p_partkey % 100 = 0) q JOIN part p ON q.p_size = p.p_size)
SELECT q AS query, term, tier, coverage, prec AS precision, rank FROM r WHERE rank <= 10 UNION ALL SELECT q, term, 0, 0, 0, rank FROM x WHERE rank <= 10"""


@query(_SEARCH)
def g5_ranked_search(t: Tables) -> DataFrame:
    kind = lambda name, k: t.part.select(F.col("p_partkey").alias("term"), name.alias("name"), F.lit(k).alias("kind"))
    names = kind(F.col("p_name"), 0).union(kind(F.col("p_type"), 1)).union(kind(F.concat("p_brand", F.lit(" of "), "p_name"), 2))
    xrefs = t.part.select(F.concat(F.lit("ORPHANET:"), F.col("p_size").cast("string")).alias("xref"), F.col("p_partkey").alias("term"))
    asking = t.part.where("p_partkey % 100 = 0")  # queries: ids divisible by 100, against all names
    texts = F.explode(F.array(F.concat("p_type", F.lit(" extra")), "p_name", F.concat("p_type", F.lit(" of the TYPE")), F.concat(F.lit("Orpha: "), F.col("p_size").cast("string"))))
    return S.search(names, asking.select(texts.alias("query")), xrefs).select("query", "term", "tier", "coverage", "precision", F.col("rank").cast("long").alias("rank"))


@query("""
WITH RECURSIVE t AS (SELECT p_partkey AS node, p_name AS label, p_size % 17 = 0 AS obsolete, p_size % 10 <> 0 AS eligible FROM part),
q AS (SELECT p_partkey AS node FROM part WHERE p_partkey % 100 = 0 UNION SELECT -1),
a AS (SELECT q.node AS root, q.node, 0 AS d FROM q JOIN t ON q.node = t.node WHERE NOT obsolete UNION SELECT a.root, p.parent, a.d + 1 FROM a JOIN parents p ON p.child = a.node),
u AS (SELECT root, node, min(d) AS d FROM a GROUP BY root, node HAVING min(d) > 0),
ur AS (SELECT u.root, u.node, u.d, row_number() OVER (PARTITION BY u.root ORDER BY u.d, t.label, u.node) AS n FROM u JOIN t ON u.node = t.node),
up AS (SELECT root, string_agg(node || '@' || d, ' ' ORDER BY n) FILTER (WHERE n <= 5) AS ancestors, greatest(count(*) - 5, 0) AS more FROM ur GROUP BY root),
l AS (SELECT root, root AS node, 0 AS d FROM a WHERE d = 0 UNION SELECT l.root, p.child, l.d + 1 FROM l JOIN parents p ON p.parent = l.node JOIN t ON p.child = t.node WHERE l.d < 3 AND t.eligible),
m AS (SELECT root, node, min(d) AS d FROM l GROUP BY root, node HAVING min(d) > 0),
c AS (SELECT p.parent AS node, count(DISTINCT p.child) AS n FROM parents p JOIN t ON p.child = t.node WHERE t.eligible GROUP BY p.parent),
mr AS (SELECT m.root, m.node, m.d, coalesce(c.n, 0) AS children, row_number() OVER (PARTITION BY m.root ORDER BY m.d, coalesce(c.n, 0) DESC, lower(t.label), m.node) AS n FROM m JOIN t ON m.node = t.node LEFT JOIN c ON m.node = c.node),
down AS (SELECT root, string_agg(node || '@' || d || '/' || children, ' ' ORDER BY n) FILTER (WHERE n <= 12) AS descendants FROM mr GROUP BY root),
n AS (SELECT root, string_agg(CAST(k AS VARCHAR), ',' ORDER BY d) AS counts FROM (SELECT root, d, count(*) AS k FROM mr GROUP BY root, d) x GROUP BY root)
SELECT q.node, CASE WHEN t.node IS NULL THEN 'not found' WHEN t.obsolete THEN 'obsolete' ELSE 'ok' END AS status, t.label,
  CASE WHEN t.obsolete = false THEN coalesce(up.ancestors, '') END AS ancestors, CASE WHEN t.obsolete = false THEN coalesce(up.more, 0) END AS ancestors_not_listed,
  CASE WHEN t.obsolete = false THEN coalesce(down.descendants, '') END AS descendants, CASE WHEN t.obsolete = false THEN coalesce(n.counts, '') END AS counts,
  CASE WHEN t.obsolete = false AND NOT t.eligible THEN 'not eligible' END AS note
FROM q LEFT JOIN t ON q.node = t.node LEFT JOIN up ON q.node = up.root LEFT JOIN down ON q.node = down.root LEFT JOIN n ON q.node = n.root""")
def g6_lookup_payload(t: Tables) -> DataFrame:
    terms = t.part.select(F.col("p_partkey").alias("node"), F.col("p_name").alias("label"), (F.col("p_size") % 17 == 0).alias("obsolete"), (F.col("p_size") % 10 != 0).alias("eligible"))
    asked = t.part.where("p_partkey % 100 = 0").select(F.col("p_partkey").alias("node")).union(t.spark.range(1).select(F.lit(-1).cast("long")))
    found = S.lookup(terms, t.parents, asked, most_ancestors=5, most_descendants=12)
    told = lambda c, *parts: F.array_join(F.transform(c, lambda x: F.concat(*(x[p].cast("string") if p in ("node", "distance", "depth", "children") else F.lit(p) for p in parts))), " ")
    counts = F.array_join(F.transform("counts", lambda x: x.cast("string")), ",")
    return found.select("node", "status", "label", told("ancestors", "node", "@", "distance").alias("ancestors"), F.col("ancestors_not_listed").cast("long").alias("ancestors_not_listed"), told("descendants", "node", "@", "depth", "/", "children").alias("descendants"), counts.alias("counts"), "note")


@query("""
WITH w AS (SELECT p_partkey AS id, p_brand, p_size, count(*) OVER (PARTITION BY p_brand) AS n FROM part)
SELECT p_brand, p_type, works, id FROM (SELECT p_brand, p_type, sum(p_size) AS works, min(p_partkey) AS id, row_number() OVER (PARTITION BY p_brand ORDER BY sum(p_size) DESC, min(p_partkey)) AS k FROM part GROUP BY p_brand, p_type) q WHERE k = 1""")
def g13_source_with_most_works(t: Tables) -> DataFrame:
    by = t.part.groupBy("p_brand", "p_type").agg(F.sum("p_size").alias("works"), F.min("p_partkey").alias("id"))
    w = Window.partitionBy("p_brand").orderBy(F.desc("works"), "id")
    return by.withColumn("k", F.row_number().over(w)).where("k = 1").drop("k")
