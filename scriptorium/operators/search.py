"""Ranked search of names by weighted tokens, on an inverted index, and what is told of a term."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import folded
from . import graph

# Words that tell nothing in names of diseases, and the names of registries in queries.
STOP_WORDS = ("a", "an", "and", "associated", "by", "due", "for", "in", "of", "or", "related", "the", "to", "type", "with")
XREF = r"(?i)^\s*(OMIM|OMIMPS|Orphanet|ORPHA)\s*:\s*(\d+)\s*$"


def tokens(name: Column) -> Column:
    """Lower-case runs of letters and digits, accents folded, in order, without stop words."""
    return F.filter(F.split(F.lower(folded(name)), "[^a-z0-9]+"), lambda x: (x != "") & ~x.isin(*STOP_WORDS))


def token_weights(names: DataFrame, total: int | Column, listed: Callable[[Column], Column] = tokens) -> DataFrame:
    """(token, df, idf) over terms: a token in several names of a term counts once; idf = ln(1 + N / df).

    ``total`` is N, ``listed`` cuts a name into tokens. Where only null terms have a token, idf is infinite.
    """
    pairs = names.select("term", F.explode(F.array_distinct(listed(F.col("name")))).alias("token")).distinct()
    counted = pairs.groupBy("token").agg(F.count("term").alias("df"))
    share = F.when(F.col("df") > 0, F.lit(total) / F.col("df")).otherwise(float("inf"))
    return counted.select("token", "df", F.round(F.log(1 + share), 9).alias("idf"))


def xref_key(query: Column) -> Column:
    """REGISTRY:number of a query that is such an id, else null."""
    prefix = F.upper(F.regexp_extract(query, XREF, 1))
    prefix = F.when(prefix == "ORPHA", "ORPHANET").otherwise(prefix)
    return F.when(query.rlike(XREF), F.concat(prefix, F.lit(":"), F.regexp_extract(query, XREF, 2)))


def search(names: DataFrame, queries: DataFrame, xrefs: DataFrame | None = None, most: int = 10) -> DataFrame:
    """(query, term, tier, coverage, precision, rank) of the best terms of each query.

    ``names`` is (term, name, kind) with kind 0 for the label, 1 for exact
    synonyms and 2 for others; ``queries`` is (query). Names of the same token
    sequence come first, by kind; then others by the share of the query's
    weight that they cover, then by the share of their tokens that the query
    has, then by the term's label in lower case, then by term. A term is ranked
    by its best name. Tokens that no name has weigh as the rarest could. A query
    that is an id of a registry gives the terms of ``xrefs`` (xref in upper case,
    term) in their order, at tier 0, and is not searched otherwise.
    """
    total = names.select("term").distinct().count()
    weights = token_weights(names, total).drop("df")
    labels = names.where("kind = 0").groupBy("term").agg(F.min(F.lower("name")).alias("label"))
    queries = queries.select("query").distinct()
    listed = tokens(F.col("name"))
    indexed = names.select("term", "name", "kind", listed.alias("tokens")).select("term", "kind", F.array_join("tokens", " ").alias("sequence"), F.array_distinct("tokens").alias("set")).distinct()
    postings = indexed.select("term", "kind", "sequence", F.size("set").alias("size"), F.explode("set").alias("token"))
    plain = queries.where(~F.col("query").rlike(XREF)).select("query", tokens(F.col("query")).alias("tokens"))
    asked = plain.select("query", F.array_join("tokens", " ").alias("asked"), F.explode(F.array_distinct("tokens")).alias("token"))
    asked = asked.join(weights, "token", "left").withColumn("w", F.coalesce("idf", F.log(F.lit(1.0 + total)))).drop("idf")
    asked = asked.withColumn("query_weight", F.sum("w").over(Window.partitionBy("query")))
    hits = asked.join(postings, "token").groupBy("query", "term", "kind", "sequence").agg(F.first("asked").alias("asked"), F.first("query_weight").alias("query_weight"), F.first("size").alias("size"), F.sum("w").alias("common"), F.count("*").alias("shared"))
    same = F.col("sequence") == F.col("asked")
    part = lambda x: F.when(same, 0.0).otherwise(F.round(x, 6))
    scored = hits.select("query", "term", F.when(same, F.col("kind")).otherwise(3).alias("tier"), part(F.col("common") / F.col("query_weight")).alias("coverage"), part(F.col("shared") / F.col("size")).alias("precision"))
    best = scored.groupBy("query", "term").agg(F.min(F.struct("tier", (-F.col("coverage")).alias("c"), (-F.col("precision")).alias("p"))).alias("s"))
    flat = best.select("query", "term", "s.tier", (-F.col("s.c")).alias("coverage"), (-F.col("s.p")).alias("precision"))
    order = Window.partitionBy("query").orderBy("tier", F.desc("coverage"), F.desc("precision"), F.col("label").asc_nulls_last(), "term")
    ranked = flat.join(labels, "term", "left").withColumn("rank", F.row_number().over(order)).drop("label")
    found = ranked.select("query", "term", "tier", "coverage", "precision", "rank")
    if xrefs is not None:
        ids = queries.withColumn("xref", xref_key(F.col("query"))).join(xrefs, "xref")
        numbered = F.row_number().over(Window.partitionBy("query").orderBy("term"))
        found = found.union(ids.select("query", "term", F.lit(0), F.lit(0.0), F.lit(0.0), numbered))
    return found.where(F.col("rank") <= most)


def lookup(terms: DataFrame, edges: DataFrame, asked: DataFrame, most_ancestors: int = 60, depth: int = 3, most_descendants: int = 80) -> DataFrame:
    """What is told of each asked id: (node, status, label, ancestors, ancestors_not_listed, descendants, counts, note).

    ``terms`` is (node, label, obsolete, eligible), ``edges`` (child, parent). The
    status is "ok", "obsolete" or "not found"; only the first has the rest.
    Ancestors are (node, distance), nearest first, then by label; descendants,
    eligible ones only, (node, depth, children), by depth, most children first,
    then by label; both are cut, and ``counts`` has the full number at each depth.
    """
    known = asked.select("node").distinct().join(terms, "node", "left")
    status = F.when(F.col("label").isNull(), "not found").when(F.col("obsolete"), "obsolete").otherwise("ok")
    known = known.withColumn("status", status)
    roots = known.where("status = 'ok'").select(F.col("node").alias("root"))
    up = graph.ancestors(edges, roots).where("distance > 0").join(terms.select("node", "label"), "node")
    listed = F.array_sort(F.collect_list(F.struct("distance", "label", "node")))
    up = up.groupBy("root").agg(listed.alias("up")).select("root", F.transform(F.slice("up", 1, most_ancestors), lambda a: F.struct(a["node"].alias("node"), a["distance"].alias("distance"))).alias("ancestors"), F.greatest(F.size("up") - most_ancestors, F.lit(0)).alias("ancestors_not_listed"))
    eligible = terms.where("eligible").select("node")
    children = edges.distinct().join(eligible.withColumnRenamed("node", "child"), "child", "left_semi").groupBy(F.col("parent").alias("node")).agg(F.count("*").alias("children"))
    down = graph.levels(edges, roots, eligible, depth).join(terms.select("node", F.lower("label").alias("label")), "node").join(children, "node", "left").withColumn("children", F.coalesce("children", F.lit(0)))
    rows = F.array_sort(F.collect_list(F.struct("level", (-F.col("children")).alias("fewer"), "label", "node")))
    of_level = lambda k: F.count_if(F.col("level") == k)
    counts = F.array_compact(F.array(*(F.when(of_level(k) > 0, of_level(k)) for k in range(1, depth + 1))))
    down = down.groupBy("root").agg(rows.alias("down"), counts.alias("counts"))
    down = down.select("root", "counts", F.transform(F.slice("down", 1, most_descendants), lambda d: F.struct(d["node"].alias("node"), d["level"].alias("depth"), (-d["fewer"]).alias("children"))).alias("descendants"))
    out = known.join(up, F.col("node") == up["root"], "left").drop("root").join(down, F.col("node") == down["root"], "left").drop("root")
    note = F.when((F.col("status") == "ok") & ~F.col("eligible"), "not eligible")
    empty = lambda c, of: F.when(F.col("status") == "ok", F.coalesce(c, F.array().cast(of)))
    node = dict(terms.dtypes)["node"]
    return out.select(
        "node", "status", "label", empty("ancestors", f"array<struct<node:{node},distance:int>>").alias("ancestors"), F.when(F.col("status") == "ok", F.coalesce("ancestors_not_listed", F.lit(0))).alias("ancestors_not_listed"),
        empty("descendants", f"array<struct<node:{node},depth:int,children:bigint>>").alias("descendants"), empty("counts", "array<bigint>").alias("counts"), note.alias("note"),
    )
