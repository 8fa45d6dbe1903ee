"""Plans that assemble report frames: placement, worklists, panel entries, prefill."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import rules as R
from ..operators import panels
from ..operators import predicates as P
from ..operators import prefill as A
from .frames import Tables
from .query import query

_RATING = "CASE WHEN (a OR b OR c) AND d AND e THEN 3 WHEN coalesce(families, 0) > 1 THEN 2 ELSE 1 END"
_FINDING = f"CASE WHEN reviewed THEN NULL WHEN listed_rating IS NULL THEN 'new_gene' WHEN {_RATING} > listed_rating THEN 'upgrade' END"


def _rated(t: Tables) -> DataFrame:
    rating = R.association_rating(*map(F.col, "abcde"), F.col("families"))
    rated = t.associations.withColumn("rating", rating)
    return rated.withColumn("finding", R.finding(F.col("rating"), F.col("listed_rating"), F.col("reviewed"), F.lit(False), F.col("families")))


_GROUPS = f"""r AS (SELECT hgnc_id, {_RATING} AS rating, CASE WHEN position % 4 = 0 THEN NULL ELSE {_FINDING} END AS finding, listed_rating, reviewed FROM (SELECT * REPLACE (id % 900 AS hgnc_id) FROM associations) q),
g AS (SELECT hgnc_id, max(CASE WHEN finding IS NOT NULL THEN rating END) AS best, bool_and(listed_rating IS NULL) AS novel, bool_or(listed_rating IS NOT NULL AND NOT reviewed) AS unreviewed FROM r GROUP BY hgnc_id),
p AS (SELECT hgnc_id, CASE WHEN best IS NOT NULL THEN CASE WHEN novel THEN 'new-' ELSE 'finding-' END || CASE WHEN best >= 3 THEN 'green' WHEN best = 2 THEN 'amber' ELSE 'red' END
  WHEN novel THEN 'new-older' WHEN unreviewed THEN 'unreviewed' ELSE 'reviewed' END AS placed FROM g)"""


def _placed(t: Tables) -> DataFrame:
    """(hgnc_id, placed): the group of each of 900 genes; every fourth association rests on older literature."""
    older = F.col("position") % 4 == 0
    rated = _rated(t).withColumn("hgnc_id", F.col("id") % 900).withColumn("finding", F.when(~older, F.col("finding")))
    g = rated.groupBy("hgnc_id").agg(
        F.max(F.when(F.col("finding").isNotNull(), F.col("rating"))).alias("best"), F.bool_and(F.col("listed_rating").isNull()).alias("novel"),
        F.bool_or(F.col("listed_rating").isNotNull() & ~F.col("reviewed")).alias("unreviewed"),
    )
    return g.select("hgnc_id", R.gene_group(F.col("novel"), F.col("best"), F.col("unreviewed")).alias("placed"))


@query(f"WITH {_GROUPS} SELECT placed, count(*) AS genes FROM p GROUP BY placed")
def g8_gene_placement(t: Tables) -> DataFrame:
    return _placed(t).groupBy("placed").agg(F.count("*").alias("genes"))


@query(f"""
WITH {_GROUPS},
c AS (SELECT m.paper_doi, min(CASE WHEN m.source <> 'recent_evidence' THEN CASE WHEN p.placed LIKE 'new-%' THEN 0 WHEN p.placed LIKE 'finding-%' THEN 1 WHEN p.placed = 'unreviewed' THEN 2 ELSE 3 END END) AS best
  FROM mentions m JOIN p ON m.hgnc_id = p.hgnc_id WHERE m.hgnc_id % 3 = 0 GROUP BY m.paper_doi),
f AS (SELECT x.doi, c.best, c.paper_doi IS NOT NULL AND c.best IS NULL AS filtered, x.relevance_json IS NOT NULL AS assessed, x.extraction_json IS NOT NULL AS read,
  coalesce(x.relevant, false) OR EXISTS (SELECT 1 FROM citations k WHERE k.paper_doi = x.doi) AS in_corpus, coalesce(x.download_status = 'manual_required', false) AS manual,
  json_extract_string(x.relevance_json, '$.refused.model') IS NOT NULL AS refused FROM papers x LEFT JOIN c ON x.doi = c.paper_doi WHERE x.source_type = 'initial' AND x.source <> '5-LOW'),
b AS (SELECT CASE WHEN best IS NOT NULL THEN ['novel', 'findings', 'unreviewed', 'already_reviewed'][best + 1] WHEN filtered THEN 'filtered' WHEN NOT assessed THEN NULL WHEN read THEN 'read_no_evidence'
  WHEN in_corpus THEN CASE WHEN manual THEN 'manual_download' END WHEN refused THEN 'refused' ELSE 'not_relevant' END AS bucket FROM f)
SELECT bucket, count(*) AS n FROM b WHERE bucket IS NOT NULL GROUP BY bucket""")
def g9_featured_buckets(t: Tables) -> DataFrame:
    added = F.when(F.col("source") != "recent_evidence", R.contribution(F.col("placed")))
    c = t.mentions.where("hgnc_id % 3 = 0").join(_placed(t), "hgnc_id").groupBy("paper_doi").agg(F.min(added).alias("best"))
    f = t.papers.where("source_type = 'initial' AND source <> '5-LOW'").join(c, F.col("doi") == F.col("paper_doi"), "left")
    f = P.with_flag(f, t.citations, [("doi", "paper_doi")], "cited")
    yes = lambda x: F.coalesce(x, F.lit(False))
    filtered = F.col("paper_doi").isNotNull() & F.col("best").isNull()
    bucket = R.featured_bucket(F.col("best"), filtered, F.col("relevance_json").isNotNull(), F.col("extraction_json").isNotNull(), yes(F.col("relevant")) | F.col("cited"), yes(F.col("download_status") == "manual_required"), P.refused())
    return f.select(bucket.alias("bucket")).where("bucket IS NOT NULL").groupBy("bucket").agg(F.count("*").alias("n"))


@query("""
WITH e AS (SELECT DISTINCT l_partkey AS hgnc_id FROM lineitem WHERE l_quantity > 49),
r AS (SELECT hgnc_id, count(*) AS papers FROM mentions GROUP BY hgnc_id),
c AS (SELECT DISTINCT hgnc_id FROM citations)
SELECT e.hgnc_id, coalesce(r.papers, 0) AS papers, CASE WHEN c.hgnc_id IS NULL THEN 'no citation' WHEN r.papers IS NULL THEN 'no paper' ELSE 'no entity' END AS reason
FROM e LEFT JOIN r ON e.hgnc_id = r.hgnc_id LEFT JOIN c ON e.hgnc_id = c.hgnc_id WHERE e.hgnc_id NOT IN (SELECT hgnc_id FROM associations)""")
def g10_entries_without_evidence(t: Tables) -> DataFrame:
    entries = t.lineitem.where("l_quantity > 49").select(F.col("l_partkey").alias("hgnc_id")).distinct().join(t.associations, "hgnc_id", "left_anti")
    read = t.mentions.groupBy("hgnc_id").agg(F.count("*").alias("papers"))
    found = P.with_flag(entries.join(read, "hgnc_id", "left"), t.citations, [("hgnc_id", "hgnc_id")], "cited")
    reason = P.first_reason((~F.col("cited"), "no citation"), (F.col("papers").isNull(), "no paper"), otherwise="no entity")
    return found.select("hgnc_id", F.coalesce("papers", F.lit(0)).alias("papers"), reason.alias("reason"))


@query("""
WITH c AS (SELECT DISTINCT c.paper_doi, p.relevant, json_extract_string(p.relevance_json, '$.refused.model') IS NOT NULL AS refused FROM citations c JOIN papers p ON lower(c.paper_doi) = lower(p.doi))
SELECT count(*) FILTER (WHERE relevant) AS found, count(*) FILTER (WHERE relevant = false AND NOT refused) AS missed, count(*) FILTER (WHERE refused) AS refused,
  round(coalesce(100 * count(*) FILTER (WHERE relevant) / nullif(count(*) FILTER (WHERE relevant) + count(*) FILTER (WHERE relevant = false AND NOT refused), 0)::DOUBLE, 0), 6) AS sensitivity FROM c""")
def g11_validation_sensitivity(t: Tables) -> DataFrame:
    papers = t.papers.select(F.lower("doi").alias("key"), "relevant", P.refused().alias("refused"))
    c = t.citations.select(F.lower("paper_doi").alias("key")).distinct().join(papers, "key")
    counted = c.agg(F.count_if("relevant").alias("found"), F.count_if(~F.col("relevant") & ~F.col("refused")).alias("missed"), F.count_if("refused").alias("refused"))
    both = F.col("found") + F.col("missed")
    return counted.withColumn("sensitivity", F.round(F.when(both > 0, 100 * F.col("found") / both).otherwise(0.0), 6))


@query("""
SELECT doi FROM papers WHERE json_extract_string(relevance_json, '$.screen.confidence') = 'LOW' AND json_extract_string(relevance_json, '$.screen.relevant') = 'false' AND json_extract_string(relevance_json, '$.refused.model') IS NULL""")
def g12_low_confidence_rejections(t: Tables) -> DataFrame:
    low = F.get_json_object("relevance_json", "$.screen.confidence") == "LOW"
    rejected = F.get_json_object("relevance_json", "$.screen.relevant") == "false"
    return t.papers.where(low & rejected & ~P.refused()).select("doi")


@query("""
SELECT mondo_id, count(*) AS reports, string_agg(DISTINCT moi, ',' ORDER BY moi) AS modes,
  CASE WHEN count(families) = 0 THEN 'lookup failed' WHEN max(families) = 0 THEN 'not found' ELSE 'found' END AS frequency FROM associations WHERE mondo_id IS NOT NULL GROUP BY mondo_id""")
def g14_variants_with_reports(t: Tables) -> DataFrame:
    state = F.when(F.count("families") == 0, "lookup failed").when(F.max("families") == 0, "not found").otherwise("found")
    g = t.associations.where("mondo_id IS NOT NULL").groupBy("mondo_id")
    return g.agg(F.count("*").alias("reports"), F.array_join(F.array_sort(F.collect_set("moi")), ",").alias("modes"), state.alias("frequency"))


@query("""
SELECT hgnc_id, string_agg(disease, '|' ORDER BY listed_rating IS NOT NULL, disease, id) AS matches FROM associations GROUP BY hgnc_id""")
def g15_unlisted_first(t: Tables) -> DataFrame:
    rows = F.array_sort(F.collect_list(F.struct(F.col("listed_rating").isNotNull().alias("listed"), "disease", "id")))
    return t.associations.groupBy("hgnc_id").agg(F.array_join(F.transform(rows, lambda r: r["disease"]), "|").alias("matches"))


@query(f"""
WITH r AS (SELECT id % 900 AS gene, id, moi, disease, reviewed, {_FINDING} AS finding FROM associations),
n AS (SELECT gene, count(finding) AS f, count(*) FILTER (WHERE NOT reviewed) AS u FROM r GROUP BY gene),
c AS (SELECT r.*, n.f > 0 OR n.u > 0 AS rated FROM r JOIN n ON r.gene = n.gene WHERE CASE WHEN n.f > 0 THEN r.finding IS NOT NULL WHEN n.u > 0 THEN NOT r.reviewed ELSE true END),
m AS (SELECT gene, coalesce(list_filter(list(DISTINCT moi), lambda x: x <> 'NR'), []) AS k FROM c GROUP BY gene),
k AS (SELECT gene, CASE WHEN len(list_filter(k, lambda x: x <> 'Other')) > 0 THEN list_filter(k, lambda x: x <> 'Other') ELSE k END AS k FROM m),
d AS (SELECT c.gene, string_agg(DISTINCT x.paper_doi, ' ' ORDER BY x.paper_doi) AS publications FROM c JOIN citations x ON c.id = x.hgnc_id GROUP BY c.gene)
SELECT c.gene, bool_and(c.rated) AS rated, count(*) AS chosen, string_agg(DISTINCT c.disease, '; ' ORDER BY c.disease) AS phenotypes, coalesce(any_value(d.publications), '') AS publications,
  any_value(CASE WHEN len(k.k) = 0 THEN 'Unknown' WHEN len(k.k) = 1 THEN k.k[1] WHEN len(list_filter(k.k, lambda x: x NOT IN ('MONOALLELIC', 'BIALLELIC'))) = 0 THEN 'BOTH' ELSE 'Other' END) AS mode
FROM c JOIN k ON c.gene = k.gene LEFT JOIN d ON c.gene = d.gene GROUP BY c.gene""")
def g16_prefill_selection(t: Tables) -> DataFrame:
    rows = _rated(t).withColumn("gene", F.col("id") % 900).join(t.citations.groupBy(F.col("hgnc_id").alias("id")).agg(F.collect_set("paper_doi").alias("publications")), "id", "left")
    return A.prefill(rows.withColumnRenamed("moi", "mode"), "gene").select("gene", "rated", "chosen", F.array_join("phenotypes", "; ").alias("phenotypes"), F.array_join("publications", " ").alias("publications"), "mode")


_PANELS = """panels AS (SELECT o.o_orderkey AS id, 'Panel ' || o.o_orderkey AS name, CASE WHEN o.o_orderkey % 5 = 0 THEN 1 ELSE 0 END AS super FROM orders o),
held AS (SELECT l_orderkey AS panel, l_partkey AS gene, l_linenumber AS n, l_returnflag AS flag, l_linestatus AS state FROM lineitem)"""


def _panels(t: Tables) -> DataFrame:
    """Panels as a snapshot has them, of orders and their lines."""
    evaluations = F.when(F.col("l_linestatus") == "O", F.array()).when(F.col("l_returnflag") == "R", F.array(F.struct(F.col("l_shipdate").cast("string").alias("created"), F.lit("GREEN").alias("rating"), F.array(F.concat(F.lit("r"), F.col("l_suppkey").cast("string"))).alias("publications"))))
    evaluations = evaluations.cast("array<struct<created:string,rating:string,publications:array<string>>>")
    gene = F.struct(F.col("l_partkey").alias("hgnc_id"), F.array(F.concat(F.lit("p"), F.col("l_linenumber").cast("string"))).alias("publications"), evaluations.alias("evaluations"))
    lines = t.lineitem.groupBy(F.col("l_orderkey").alias("id")).agg(F.array_sort(F.collect_list(F.struct(F.col("l_linenumber").alias("n"), gene.alias("gene")))).alias("lines"))
    children = F.when(F.col("o_orderkey") % 5 == 0, F.array(F.col("o_orderkey") + 1)).otherwise(F.array().cast("array<bigint>"))
    orders = t.orders.select(F.col("o_orderkey").alias("id"), F.concat(F.lit("Panel "), F.col("o_orderkey").cast("string")).alias("name"), F.col("o_orderpriority").alias("description"), children.alias("child_panel_ids"))
    return orders.join(lines, "id", "left").withColumn("genes", F.transform("lines", lambda x: x["gene"])).drop("lines")


@query(f"WITH {_PANELS} SELECT gene, count(DISTINCT panel) AS panels, min(panel) AS first FROM held JOIN panels ON panel = id GROUP BY gene")
def p1_gene_panels(t: Tables) -> DataFrame:
    found = panels.gene_panels(_panels(t))
    return found.select("gene", F.size("panels").cast("long").alias("panels"), F.array_min("panels").alias("first"))


@query(f"WITH {_PANELS} SELECT p.id, p.name, o.o_orderpriority AS description FROM panels p JOIN orders o ON p.id = o.o_orderkey WHERE super = 0")
def p2_panels_without_children(t: Tables) -> DataFrame:
    return panels.descriptions(_panels(t)).select("id", "name", "description")


@query(f"""
WITH {_PANELS}, l AS (SELECT l_orderkey AS panel, l_partkey AS gene, l_linenumber AS n, l_linestatus, l_returnflag, l_shipdate FROM lineitem),
f AS (SELECT * FROM l QUALIFY row_number() OVER (PARTITION BY panel, gene ORDER BY n DESC, CASE WHEN l_linestatus = 'O' THEN 1 WHEN l_returnflag = 'R' THEN 2 ELSE 0 END DESC, l_shipdate DESC) = 1)
SELECT panel, gene, CASE WHEN l_linestatus = 'O' THEN 'none' WHEN l_returnflag = 'R' THEN 'reviewed' ELSE 'not served' END AS state, CASE WHEN l_linestatus <> 'O' AND l_returnflag = 'R' THEN strftime(l_shipdate, '%Y-%m-%d') END AS latest FROM f""")
def p3_reviews_of_entries(t: Tables) -> DataFrame:
    found = panels.gene_reviews(_panels(t))
    return found.select("panel", "gene", panels.review_state(F.col("reviews")).alias("state"), F.left(F.get("reviews", F.lit(0))["created"], F.lit(10)).alias("latest"))


@query("""
SELECT 'gene' AS kind, l_orderkey AS panel, l_partkey AS entity, CASE WHEN l_quantity < 20 THEN 'RED' WHEN l_quantity < 30 THEN 'AMBER' ELSE 'GREEN' END AS colour FROM lineitem WHERE l_linenumber % 2 = 0
UNION ALL SELECT 'str', l_orderkey, l_partkey, CASE WHEN l_quantity < 20 THEN 'RED' WHEN l_quantity < 30 THEN 'AMBER' ELSE 'GREEN' END FROM lineitem WHERE l_linenumber % 2 = 1""")
def p4_panel_entries(t: Tables) -> DataFrame:
    entity = F.struct(F.col("l_partkey").alias("entity"), F.floor(F.col("l_quantity") / 10).cast("string").alias("level"))
    genes = F.collect_list(F.when(F.col("l_linenumber") % 2 == 0, entity))
    strs = F.collect_list(F.when(F.col("l_linenumber") % 2 == 1, entity))
    panels = t.lineitem.groupBy(F.col("l_orderkey").alias("panel")).agg(genes.alias("genes"), strs.alias("strs"))
    rows = lambda kind, c: panels.select(F.lit(kind).alias("kind"), "panel", F.inline(c))
    colour = F.when(F.col("level").isin("0", "1"), "RED").when(F.col("level") == "2", "AMBER").otherwise("GREEN")
    return rows("gene", "genes").unionByName(rows("str", "strs")).select("kind", "panel", "entity", colour.alias("colour"))


@query("""
SELECT a.hgnc_id FROM associations a GROUP BY a.hgnc_id HAVING bool_and(a.listed_rating IS NOT NULL OR a.reviewed)
  AND a.hgnc_id NOT IN (SELECT c.hgnc_id FROM citations c JOIN papers p ON lower(c.paper_doi) = lower(p.doi) WHERE p.relevant IS NULL)""")
def p5_reviewed_in_full(t: Tables) -> DataFrame:
    reviewed = t.associations.groupBy("hgnc_id").agg(F.bool_and(F.col("listed_rating").isNotNull() | F.col("reviewed")).alias("all")).where("all")
    open_ = t.papers.where("relevant IS NULL").select(F.lower("doi").alias("key"))
    unread = t.citations.withColumn("key", F.lower("paper_doi")).join(open_, "key", "left_semi")
    return reviewed.join(unread, "hgnc_id", "left_anti").select("hgnc_id")


@query("""
WITH p AS (SELECT l_orderkey AS panel, l_partkey AS gene, 'p' || l_linenumber AS pub FROM lineitem UNION SELECT l_orderkey, l_partkey, 'r' || l_suppkey FROM lineitem WHERE l_linestatus <> 'O' AND l_returnflag = 'R')
SELECT panel, gene, string_agg(pub, ' ' ORDER BY pub) AS publications FROM p GROUP BY panel, gene""")
def p6_entry_publications(t: Tables) -> DataFrame:
    return panels.entry_publications(_panels(t)).select("panel", "gene", F.array_join("publications", " ").alias("publications"))


@query("""
WITH missing AS (SELECT DISTINCT lower(paper_doi) AS k FROM citations WHERE lower(paper_doi) NOT IN (SELECT lower(doi) FROM papers WHERE relevant)),
base AS (SELECT lower(doi) AS k, min(doi) AS doi FROM papers WHERE relevant IS NULL GROUP BY 1)
SELECT m.k AS id, CASE WHEN b.doi IS NULL THEN 'fetch' ELSE 'baseline' END AS source FROM missing m LEFT JOIN base b ON m.k = b.k""")
def p7_citation_seeding(t: Tables) -> DataFrame:
    held = t.papers.where("relevant").select(F.lower("doi").alias("id"))
    missing = t.citations.select(F.lower("paper_doi").alias("id")).distinct().join(held, "id", "left_anti")
    base = t.papers.where("relevant IS NULL").groupBy(F.lower("doi").alias("id")).agg(F.min("doi").alias("doi"))
    return missing.join(base, "id", "left").select("id", F.when(F.col("doi").isNull(), "fetch").otherwise("baseline").alias("source"))


@query("SELECT hgnc_id, string_agg(CAST(id AS VARCHAR) || ':' || moi, ' ' ORDER BY position) AS reviews FROM associations WHERE reviewed GROUP BY hgnc_id")
def p8_reviews_in_entry_order(t: Tables) -> DataFrame:
    rows = F.array_sort(F.collect_list(F.struct("position", F.concat(F.col("id").cast("string"), F.lit(":"), "moi").alias("r"))))
    return t.associations.where("reviewed").groupBy("hgnc_id").agg(F.array_join(F.transform(rows, lambda r: r["r"]), " ").alias("reviews"))


@query("""
WITH d AS (SELECT hgnc_id, paper_doi FROM citations)
SELECT m.hgnc_id, count(*) FILTER (WHERE p.pmid IS NOT NULL AND d.paper_doi IS NOT NULL) AS evaluated, count(*) FILTER (WHERE p.pmid IS NULL OR d.paper_doi IS NULL) AS independent
FROM mentions m JOIN papers p ON m.paper_doi = p.doi LEFT JOIN d ON d.hgnc_id = m.hgnc_id AND d.paper_doi = m.paper_doi GROUP BY m.hgnc_id""")
def p9_dispute_blocks(t: Tables) -> DataFrame:
    m = P.with_flag(t.mentions, t.citations, [("hgnc_id", "hgnc_id"), ("paper_doi", "paper_doi")], "cited").join(t.papers.select("doi", "pmid"), F.col("paper_doi") == F.col("doi"))
    seen = F.col("pmid").isNotNull() & F.col("cited")
    return m.groupBy("hgnc_id").agg(F.count_if(seen).alias("evaluated"), F.count_if(~seen).alias("independent"))


@query("SELECT hgnc_id, bool_and(families IS NOT NULL) AS in_scope FROM associations GROUP BY hgnc_id")
def p10_scope_check(t: Tables) -> DataFrame:
    g = t.associations.groupBy("hgnc_id").agg(F.collect_list(F.struct("families")).alias("rows"))
    return g.select("hgnc_id", F.forall("rows", lambda r: r["families"].isNotNull()).alias("in_scope"))


@query("SELECT hgnc_id, paper_doi, row_number() OVER (PARTITION BY hgnc_id ORDER BY paper_doi) - 1 AS quote_index FROM (SELECT DISTINCT hgnc_id, paper_doi FROM citations) q")
def p11_quote_index(t: Tables) -> DataFrame:
    w = Window.partitionBy("hgnc_id").orderBy("paper_doi")
    return t.citations.distinct().select("hgnc_id", "paper_doi", (F.row_number().over(w) - 1).cast("long").alias("quote_index"))


@query(f"""
WITH a AS (SELECT hgnc_id, count(*) AS associations, max({_RATING}) AS rating FROM associations GROUP BY hgnc_id),
m AS (SELECT hgnc_id, count(DISTINCT paper_doi) AS papers FROM mentions GROUP BY hgnc_id), c AS (SELECT hgnc_id, count(*) AS cited FROM citations GROUP BY hgnc_id)
SELECT a.hgnc_id, a.associations, a.rating, coalesce(m.papers, 0) AS papers, coalesce(c.cited, 0) AS cited, c.cited IS NULL AS novel FROM a LEFT JOIN m ON a.hgnc_id = m.hgnc_id LEFT JOIN c ON a.hgnc_id = c.hgnc_id""")
def p12_gene_load(t: Tables) -> DataFrame:
    a = _rated(t).groupBy("hgnc_id").agg(F.count("*").alias("associations"), F.max("rating").alias("rating"))
    m = t.mentions.groupBy("hgnc_id").agg(F.countDistinct("paper_doi").alias("papers"))
    c = t.citations.groupBy("hgnc_id").agg(F.count("*").alias("cited"))
    out = a.join(m, "hgnc_id", "left").join(c, "hgnc_id", "left")
    return out.select("hgnc_id", "associations", "rating", F.coalesce("papers", F.lit(0)).alias("papers"), F.coalesce("cited", F.lit(0)).alias("cited"), F.col("cited").isNull().alias("novel"))


@query("SELECT stage, string_agg(DISTINCT model, ' and ' ORDER BY model) AS refusers FROM requests WHERE status = 'refused' GROUP BY stage")
def p13_who_refused(t: Tables) -> DataFrame:
    return t.requests.where("status = 'refused'").groupBy("stage").agg(F.array_join(F.array_sort(F.collect_set("model")), " and ").alias("refusers"))


@query("SELECT count(*) FILTER (WHERE relevant IS NULL) AS unassessed, count(*) FILTER (WHERE relevant AND extraction_json IS NULL) AS unread FROM papers")
def p14_remaining_counters(t: Tables) -> DataFrame:
    return t.papers.agg(F.count_if(F.col("relevant").isNull()).alias("unassessed"), F.count_if(F.col("relevant") & F.col("extraction_json").isNull()).alias("unread"))


@query(f"""
SELECT id, concat_ws('. ', CASE {_FINDING} WHEN 'new_gene' THEN 'New gene for ' || disease WHEN 'upgrade' THEN 'Upgrade of ' || disease ELSE 'Known: ' || disease END, CASE WHEN families IS NOT NULL THEN CAST(families AS VARCHAR) || ' families' END, moi) AS comment FROM associations""")
def p15_prefill_comment(t: Tables) -> DataFrame:
    head = F.when(F.col("finding") == "new_gene", "New gene for ").when(F.col("finding") == "upgrade", "Upgrade of ").otherwise("Known: ")
    families = F.concat(F.col("families").cast("string"), F.lit(" families"))
    return _rated(t).select("id", F.concat_ws(". ", F.concat(head, "disease"), families, "moi").alias("comment"))


@query("""
SELECT r.custom_id, CASE r.stage WHEN 'screen' THEN c.c_name WHEN 'extract' THEN p.title ELSE s.s_name END AS label FROM requests r
LEFT JOIN customer c ON r.subject = CAST(c.c_custkey AS STRING) LEFT JOIN papers p ON '10.1/' || r.subject = p.doi LEFT JOIN supplier s ON r.subject = CAST(s.s_suppkey AS STRING)""")
def p16_subject_labels(t: Tables) -> DataFrame:
    key = lambda df, k, v, n: df.select(F.col(k).cast("string").alias("subject"), F.col(v).alias(n))
    papers = t.papers.select(F.replace("doi", F.lit("10.1/"), F.lit("")).alias("subject"), F.col("title"))
    out = t.requests.join(key(t.customer, "c_custkey", "c_name", "c"), "subject", "left").join(papers, "subject", "left").join(key(t.supplier, "s_suppkey", "s_name", "s"), "subject", "left")
    return out.select("custom_id", F.when(F.col("stage") == "screen", F.col("c")).when(F.col("stage") == "extract", F.col("title")).otherwise(F.col("s")).alias("label"))


@query("SELECT hgnc_id, string_agg(disease, '; ' ORDER BY position) AS brief FROM associations WHERE NOT reviewed AND families >= 2 GROUP BY hgnc_id")
def p17_pursued(t: Tables) -> DataFrame:
    rows = t.associations.groupBy("hgnc_id").agg(F.array_sort(F.collect_list(F.struct("position", "disease", "reviewed", "families"))).alias("rows"))
    kept = rows.withColumn("rows", F.filter("rows", lambda r: ~r["reviewed"] & F.coalesce(r["families"] >= 2, F.lit(False)))).where(F.size("rows") > 0)
    return kept.select("hgnc_id", F.array_join(F.transform("rows", lambda r: r["disease"]), "; ").alias("brief"))


@query("""
WITH g AS (SELECT id, id % 900 AS gene FROM associations)
SELECT a.id, string_agg(CAST(o.id AS VARCHAR), ',' ORDER BY o.id) AS others FROM g a JOIN g o ON a.gene = o.gene AND a.id <> o.id GROUP BY a.id""")
def p18_other_associations(t: Tables) -> DataFrame:
    rows = t.associations.select((F.col("id") % 900).alias("gene"), "id")
    siblings = rows.withColumn("all", F.array_sort(F.collect_list("id").over(Window.partitionBy("gene"))))
    others = siblings.withColumn("others", F.filter("all", lambda x: x != F.col("id"))).where(F.size("others") > 0)
    return others.select("id", F.array_join(F.transform("others", lambda x: x.cast("string")), ",").alias("others"))
