"""The data part of every stage of a curation run, over a run store and a ledger store.

Model calls, downloads and page rendering are not here: a stage's ``due_*``
function gives the rows to ask about, and its ``store_*`` function takes the
answers as a frame.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import schemas
from .functions import text as T
from .operators import keyed as K
from .operators import latest as L
from .operators import predicates as P
from .store import Store

RELEVANCE, EXTRACTION = "relevance_assessment_json", "evidence_extraction_json"


def _day(text: str) -> Column:
    return F.lit(text).cast("date")


# ------------------------------------------------------------------ ledger


def ledger_init(ledger: Store) -> None:
    if "ledger" in ledger.tables():
        raise ValueError("the ledger exists")
    ledger.commit(ledger=ledger.spark.createDataFrame([], schemas.of("ledger")), sync_state=ledger.spark.createDataFrame([], schemas.of("sync_state")))


_METADATA = ("title", "abstract", "authors", "journal", "journal_issn", "source", "source_date", "source_metadata")


def ledger_upsert(ledger: Store, papers: DataFrame, today: str, ordinal: str = "ordinal") -> tuple[int, int]:
    """Metadata of incoming papers, in order; dispositions stay. Gives (inserted, updated)."""
    stored = ledger.read("ledger")
    rows = papers.withColumns({"first_seen": _day(today), "last_seen": _day(today)})
    folds = {c: K.LAST for c in _METADATA} | {"pmid": K.KNOWN, "first_seen": K.FIRST, "last_seen": K.LAST}
    inserted = rows.select("doi").distinct().join(stored, "doi", "left_anti").count()
    updated = rows.count() - inserted
    ledger.commit(ledger=K.upsert(stored, rows, "doi", ordinal, folds))
    return inserted, updated


def ledger_sync(ledger: Store, files: DataFrame, year: int, today: str, floor: str | None = None) -> int:
    """Apply the files numbered above the cursor: rows of articles with ``number`` and ``ordinal``. A new
    year starts its own numbering. Gives the new cursor; applying the same files again changes nothing."""
    state = ledger.read("sync_state").first()
    cursor = state["last_applied_file_number"] if state and state["baseline_year"] == year else 0
    new = files.where(F.col("number") > cursor)
    top = new.agg(F.max("number")).first()[0]
    if top is None:
        return cursor
    rows = new.where(F.col("source_date") >= _day(floor)) if floor else new
    stored = ledger.read("ledger")
    rows = rows.withColumns({"first_seen": _day(today), "last_seen": _day(today), "_order": F.struct("number", "ordinal")})
    folds = {c: K.LAST for c in _METADATA} | {"pmid": K.KNOWN, "first_seen": K.FIRST, "last_seen": K.LAST}
    cursor_row = ledger.spark.createDataFrame([(year, int(top), today)], schemas.of("sync_state"))
    ledger.commit(ledger=K.upsert(stored, rows, "doi", "_order", folds), sync_state=cursor_row)
    return int(top)


def seed_run(ledger: Store, run: Store, end: str, months: int = 6) -> int:
    """Copy the actionable rows within the closure horizon into a run; papers it has stay. Gives their number."""
    rows = ledger.read("ledger").where(~P.settled() & (F.col("source_date") >= F.add_months(_day(end), -months)))
    status = F.when(F.col("relevant"), F.col("download_status"))
    null = F.lit(None).cast("string")
    new = rows.select("doi", "pmid", *_METADATA, F.lit("initial").alias("source_type"), null.alias("source_details"), status.alias("download_status"), null.alias("relevance_assessment_raw"), RELEVANCE, null.alias("evidence_extraction_raw"), null.alias(EXTRACTION))
    papers = run.read("papers")
    held = rows.select(F.col("doi").alias("_d"), F.col("pmid").alias("_pmid"))
    filled = papers.join(held, papers["doi"] == F.col("_d"), "left").withColumn("pmid", F.coalesce("pmid", "_pmid")).drop("_d", "_pmid")
    added = new.join(papers, "doi", "left_anti")
    n = added.count()
    run.commit(papers=filled.unionByName(added))
    return n


def writeback(ledger: Store, run: Store, name: str, today: str) -> int:
    """Fold a run's dispositions into the ledger; absent rows come with their metadata. Gives the refused ones' number."""
    papers = run.read("papers").withColumn("relevant", F.when(F.col(RELEVANCE).isNotNull(), P.relevant(RELEVANCE)))
    rows = papers.withColumns({"reported_run": F.lit(name), "first_seen": _day(today), "last_seen": _day(today), "ordinal": F.lit(0)})
    only_new = K.Fold(lambda c, o: F.max_by(c, o), lambda old, new: old)
    folds = {c: only_new for c in ("pmid", *_METADATA, "first_seen", "last_seen")} | {c: K.LAST for c in (RELEVANCE, "relevant", "download_status", "reported_run")}
    ledger.commit(ledger=K.upsert(ledger.read("ledger"), rows, "doi", "ordinal", folds))
    return papers.where(P.refused(RELEVANCE)).count()


def seed_ledger(ledger: Store, sources: list[DataFrame]) -> int:
    """Merge dispositions of runs, oldest first: the last verdict that is known, the status furthest on. Rows
    without a DOI are found by PMID in the ledger; those that are not are left out and counted."""
    rows = None
    for k, s in enumerate(sources):
        one = s.select("doi", "pmid", RELEVANCE, "relevant", "download_status").withColumn("ordinal", F.lit(k))
        rows = one if rows is None else rows.unionByName(one)
    stored = ledger.read("ledger")
    index = stored.where("pmid IS NOT NULL").groupBy("pmid").agg(F.min("doi").alias("_doi"))
    found = rows.join(index, "pmid", "left").withColumn("doi", F.coalesce("doi", "_doi"))
    lost = found.where("doi IS NULL").count()
    known = F.when(F.col("relevant").isNotNull(), F.col("ordinal"))
    merged = found.where("doi IS NOT NULL").groupBy("doi").agg(
        F.coalesce(F.max_by(RELEVANCE, known), F.min_by(RELEVANCE, "ordinal")).alias("_json"), F.max_by("relevant", known).alias("_relevant"),
        K.best_by_rank("download_status", ["scheduled", "manual_required", "downloaded"]).alias("_status"),
    )
    joined = stored.join(merged, "doi", "left")
    out = joined.withColumns({RELEVANCE: F.coalesce("_json", RELEVANCE), "relevant": F.coalesce("_relevant", "relevant"), "download_status": F.coalesce("_status", "download_status")})
    ledger.commit(ledger=out.drop("_json", "_relevant", "_status"))
    return lost


# ------------------------------------------------------------------ ingest


def ingest(run: Store, papers: DataFrame, source_details: str, ordinal: str = "ordinal") -> None:
    """Papers of one source and window: a stored one changes only if it is of the same source, initial,
    and of earlier details, as text."""
    rows = papers.withColumns({"source_type": F.lit("initial"), "source_details": F.lit(source_details)})
    newer = lambda old, new: (F.col(f"{old}.source") == F.col(f"{new}.source")) & (F.col(f"{old}.source_type") == "initial") & (F.col(f"{new}.source_details") > F.col(f"{old}.source_details"))
    folds = {c: K.LAST for c in (*_METADATA, "source_type", "source_details")} | {"pmid": K.KNOWN}
    run.commit(papers=K.upsert(run.read("papers"), rows, "doi", ordinal, folds, newer))


def screen_files(run: Store, papers: DataFrame, done: DataFrame) -> None:
    """Papers of files not yet done (``name``) that a classifier keeps; first of a DOI wins, stored ones stay."""
    new = papers.join(done.select("name"), "name", "left_anti").where("positive")
    stored = run.read("papers")
    columns = [c for c in stored.columns if c in new.columns and c != "doi"]
    added = K.ignore_existing(stored, new, "doi", "ordinal", columns)
    run.commit(papers=stored.unionByName(added, allowMissingColumns=True))


# ------------------------------------------------------------------ relevance


def _pending(run: Store, stage: str) -> DataFrame:
    return run.read("llm_requests").where((F.col("stage") == stage) & (F.col("status") == "pending")).select("subject").distinct()


def due_relevance(run: Store, limit: int | None = None) -> DataFrame:
    due = run.read("papers").where(F.col(RELEVANCE).isNull() & P.initial()).join(_pending(run, "relevance"), F.col("doi") == F.col("subject"), "left_anti").orderBy("doi")
    return due.limit(limit) if limit else due


def store_screens(run: Store, answers: DataFrame) -> None:
    """Screens (doi, screen as JSON, genes: array of (hgnc_id, symbol)). A relevant paper without a status is scheduled."""
    papers, mentions = run.read("papers"), run.read("gene_mentions")
    one = answers.groupBy("doi").agg(F.first("screen").alias("_screen"), F.first("genes").alias("genes"))
    yes = P.json_flag("_screen", "$.relevant")
    wrapped = F.concat(F.lit('{"relevant":'), yes.cast("string"), F.lit(',"screen":'), "_screen", F.lit("}"))
    joined = papers.join(one.select("doi", "_screen"), "doi", "left")
    new = F.col("_screen").isNotNull()
    out = joined.withColumns({RELEVANCE: F.when(new, wrapped).otherwise(F.col(RELEVANCE)), "download_status": F.when(new & yes & F.col("download_status").isNull(), "scheduled").otherwise(F.col("download_status"))})
    genes = one.select(F.col("doi").alias("paper_doi"), F.inline("genes")).select("hgnc_id", F.col("symbol").alias("paper_gene_symbol"), "paper_doi", F.lit("recent_evidence").alias("source"))
    genes = genes.dropDuplicates(["hgnc_id", "paper_doi"]).join(mentions, ["paper_doi", "hgnc_id", "source"], "left_anti")
    run.commit(papers=out.drop("_screen"), gene_mentions=mentions.unionByName(genes))


def settle_refused(run: Store, final_model: str) -> int:
    """Papers not assessed and not in flight whose last refusal is of the final model get a refused answer."""
    refused = run.read("llm_requests").where((F.col("stage") == "relevance") & (F.col("status") == "refused") & (F.col("model") == final_model))
    last = L.latest(refused.withColumn("at", F.to_timestamp("completed_at")), ["subject"], ["at", "custom_id"], ["model", "refusal_category"])
    last = last.join(_pending(run, "relevance"), "subject", "left_anti")
    answer = F.to_json(F.struct(F.lit(False).alias("relevant"), F.lit(None).cast("string").alias("screen"), F.struct("model", F.col("refusal_category").alias("category")).alias("refused")), {"ignoreNullFields": "false"})
    settled = last.select(F.col("subject").alias("doi"), answer.alias("_answer"))
    papers = run.read("papers").join(settled, "doi", "left")
    hit = F.col(RELEVANCE).isNull() & F.col("_answer").isNotNull()
    n = papers.where(hit).count()
    run.commit(papers=papers.withColumn(RELEVANCE, F.when(hit, F.col("_answer")).otherwise(F.col(RELEVANCE))).drop("_answer"))
    return n


def reopen_refused(run: Store) -> None:
    papers = run.read("papers")
    run.commit(papers=papers.withColumn(RELEVANCE, F.when(~P.refused(RELEVANCE), F.col(RELEVANCE))))


# ------------------------------------------------------------------ corpus, literature


def run_genes(run: Store) -> DataFrame:
    papers = run.read("papers").withColumn("relevance_json", F.col(RELEVANCE))
    return P.run_genes(papers, run.read("gene_mentions"))


def corpus(run: Store) -> DataFrame:
    """Papers that count: expansion, cited by a run gene, or relevant."""
    cited = P.cited_papers(run.read("panelapp_citations"), run_genes(run))
    flagged = P.with_flag(run.read("papers"), cited, [("doi", "paper_doi")], "cited")
    return flagged.where(P.expansion() | F.col("cited") | P.relevant(RELEVANCE)).drop("cited")


def papers_per_gene(run: Store) -> DataFrame:
    """(hgnc_id, papers) of run genes over their relevant initial papers."""
    relevant = run.read("papers").where(P.relevant(RELEVANCE) & P.initial()).select("doi")
    pairs = run.read("gene_mentions").where("source = 'recent_evidence'").join(relevant, F.col("paper_doi") == F.col("doi"), "left_semi")
    return pairs.groupBy("hgnc_id").agg(F.countDistinct("paper_doi").alias("papers"))


def genes_to_reduce(run: Store, most: int) -> DataFrame:
    """Genes with more than ``most`` papers and no stored selection, the largest first."""
    return papers_per_gene(run).where(F.col("papers") > most).join(run.read("tournament_results"), "hgnc_id", "left_anti").orderBy(F.desc("papers"), "hgnc_id")


def papers_of_small_genes(run: Store, most: int) -> DataFrame:
    small = papers_per_gene(run).where(F.col("papers") <= most)
    relevant = run.read("papers").where(P.relevant(RELEVANCE) & P.initial()).select("doi")
    pairs = run.read("gene_mentions").where("source = 'recent_evidence'").join(small, "hgnc_id", "left_semi")
    return pairs.join(relevant, F.col("paper_doi") == F.col("doi"), "left_semi").select("paper_doi").distinct()


def newest_per_gene(run: Store, genes: DataFrame, most: int, sources: list[str]) -> DataFrame:
    """Each gene's newest papers from the given kinds of mention: (hgnc_id, doi, rank)."""
    pairs = run.read("gene_mentions").where(F.col("source").isin(*sources)).join(genes, "hgnc_id", "left_semi").select("hgnc_id", F.col("paper_doi").alias("doi")).distinct()
    dated = pairs.join(run.read("papers").select("doi", "source_date"), "doi")
    return L.ranked(dated, ["hgnc_id"], [F.desc("source_date"), F.desc("doi")], most).select("hgnc_id", "doi", "rank")


def clear_unselected(run: Store, selected: DataFrame) -> DataFrame:
    """Clear the status of papers not selected (doi); gives cleared and kept by status."""
    flagged = P.with_flag(run.read("papers"), selected, [("doi", "doi")], "_kept")
    counts = flagged.where("download_status IS NOT NULL").groupBy("download_status").agg(F.count_if(~F.col("_kept")).alias("cleared"), F.count_if("_kept").alias("kept"))
    out = counts.sparkSession.createDataFrame(counts.collect(), counts.schema)  # a row for each status
    run.commit(papers=flagged.withColumn("download_status", F.when(F.col("_kept"), F.col("download_status"))).drop("_kept"))
    return out


def store_expansion(run: Store, papers: DataFrame) -> None:
    """Expansion papers (source_details is the gene as text): an older expansion row takes greater details; a status is only filled."""
    rows = papers.withColumns({"source_type": F.lit("expansion"), "ordinal": F.lit(0)})
    best = rows.groupBy("doi").agg(F.max_by(F.struct(*(c for c in rows.columns if c != "doi")), "source_details").alias("_r")).select("doi", "_r.*")
    newer = lambda old, new: (F.col(f"{old}.source_type") == "expansion") & (F.col(f"{new}.source_details") > F.col(f"{old}.source_details"))
    only_new = K.Fold(lambda c, o: F.max_by(c, o), lambda old, new: old)
    folds = {c: only_new for c in ("pmid", *_METADATA, "source_type") if c in rows.columns} | {"source_details": K.LAST, "download_status": K.FILL}
    run.commit(papers=K.upsert(run.read("papers"), best, "doi", "ordinal", folds, newer))


def link_citations(run: Store, cited: DataFrame) -> tuple[int, int]:
    """Replace the citation links by those of (hgnc_id, pmid, doi) rows; linked papers without a status are
    scheduled. Gives (links, papers scheduled)."""
    papers = run.read("papers")
    by_pmid = cited.where("pmid IS NOT NULL").select("hgnc_id", "pmid").join(papers, "pmid").select("hgnc_id", F.col("doi").alias("paper_doi"))
    by_doi = cited.where("doi IS NOT NULL").select("hgnc_id", F.lower("doi").alias("_k")).join(papers.withColumn("_k", F.lower("doi")), "_k").select("hgnc_id", F.col("doi").alias("paper_doi"))
    links = by_pmid.union(by_doi).distinct()
    flagged = P.with_flag(papers, links, [("doi", "paper_doi")], "_linked")
    new = F.col("_linked") & F.col("download_status").isNull()
    counts = links.count(), flagged.where(new).count()
    run.commit(panelapp_citations=links, papers=flagged.withColumn("download_status", F.when(new, "scheduled").otherwise(F.col("download_status"))).drop("_linked"))
    return counts


# ------------------------------------------------------------------ downloads


def manual_worklist(run: Store, skip_genes: DataFrame | None = None) -> DataFrame:
    """Corpus papers to fetch by hand, without those of the given genes."""
    due = corpus(run).where("download_status = 'manual_required'")
    if skip_genes is not None:
        held = run.read("gene_mentions").join(skip_genes, "hgnc_id", "left_semi").select(F.col("paper_doi").alias("doi"))
        due = due.join(held, "doi", "left_anti")
    return due.select("doi")


def register_files(run: Store, files: DataFrame) -> int:
    """Papers whose file is there (name: the DOI percent-encoded, with .pdf) become downloaded. Gives their number."""
    there = files.select(F.regexp_replace("name", r"\.pdf$", "").alias("_key")).distinct().withColumn("_there", F.lit(True))
    papers = run.read("papers").withColumn("_key", T.percent_encode(F.col("doi"))).join(there, "_key", "left")
    new = F.col("_there") & F.col("download_status").isin("scheduled", "manual_required")
    n = papers.where(new).count()
    run.commit(papers=papers.withColumn("download_status", F.when(new, "downloaded").otherwise(F.col("download_status"))).drop("_key", "_there"))
    return n


# ------------------------------------------------------------------ extraction, associations


def due_extraction(run: Store, limit: int | None = None) -> DataFrame:
    due = corpus(run).where((F.col("download_status") == "downloaded") & F.col(EXTRACTION).isNull()).join(_pending(run, "extraction"), F.col("doi") == F.col("subject"), "left_anti").orderBy("doi")
    return due.limit(limit) if limit else due


def store_extraction(run: Store, answers: DataFrame) -> None:
    """Extractions (doi, raw, document as JSON): a paper's document and its mentions are replaced together."""
    papers, mentions = run.read("papers"), run.read("gene_mentions")
    one = answers.groupBy("doi").agg(F.first("raw").alias("_raw"), F.first("document").alias("_doc"))
    joined = papers.join(one, "doi", "left")
    new = F.col("_doc").isNotNull()
    out = joined.withColumns({"evidence_extraction_raw": F.when(new, F.col("_raw")).otherwise(F.col("evidence_extraction_raw")), EXTRACTION: F.when(new, F.col("_doc")).otherwise(F.col(EXTRACTION))})
    evaluations = one.select(F.col("doi").alias("paper_doi"), F.inline(F.from_json("_doc", f"struct<{_struct('extraction')}>", {"mode": "FAILFAST"})["gene_evaluations"]))
    expansion = papers.where(P.expansion()).select(F.col("doi").alias("paper_doi"))
    found = P.with_flag(evaluations, expansion, [("paper_doi", "paper_doi")], "_expansion")
    source = F.when(F.col("_expansion"), "expansion_evidence").otherwise("recent_evidence")
    children = found.where("hgnc_id IS NOT NULL").select("hgnc_id", "paper_gene_symbol", "paper_doi", source.alias("source")).dropDuplicates(["hgnc_id", "paper_doi", "source"])
    parents = one.select(F.col("doi").alias("paper_doi"))
    run.commit(papers=out.drop("_raw", "_doc"), gene_mentions=K.replace_children(mentions, parents, children, "paper_doi"))


def _struct(document: str) -> str:
    from pyspark.sql.types import StructType

    return StructType.fromDDL(schemas.DOCUMENTS[document]).simpleString()[len("struct<") : -1]


def referenced_sources(run: Store) -> DataFrame:
    """(doi, title, context) of earlier reports that the extractions of run genes name."""
    docs = run.read("papers").where(F.col(EXTRACTION).isNotNull()).select("doi", F.from_json(EXTRACTION, f"struct<{_struct('extraction')}>").alias("d"))
    entities = docs.select("doi", F.inline("d.gene_evaluations")).join(run_genes(run), "hgnc_id", "left_semi").select("doi", F.inline("disease_entities"))
    sources = entities.select("doi", F.inline("previously_reported_sources"))
    return sources.where("title <> '' AND title <> 'NR'").distinct()


def due_genes(run: Store, stage: str, done: str) -> DataFrame:
    """Run genes without a row in the table ``done`` and without a pending request."""
    pending = _pending(run, stage)
    return run_genes(run).join(run.read(done), "hgnc_id", "left_anti").join(pending, F.col("hgnc_id").cast("string") == F.col("subject"), "left_anti").orderBy("hgnc_id")


def store_aggregation(run: Store, aggregations: DataFrame, associations: DataFrame) -> None:
    """Genes' assessments, with their associations replaced together; ids go on from the greatest."""
    old, held = run.read("associations"), run.read("gene_aggregations")
    top = old.agg(F.coalesce(F.max("id"), F.lit(0))).first()[0]
    new = associations.join(aggregations, "hgnc_id", "left_semi")
    counts = new.groupBy("hgnc_id").agg(F.count("*").alias("_n"))  # a row for each gene: their ids begin one after the other
    starts = counts.withColumn("_start", F.sum("_n").over(Window.orderBy("hgnc_id").rowsBetween(Window.unboundedPreceding, -1)))
    own = F.row_number().over(Window.partitionBy("hgnc_id").orderBy("position"))
    ids = own + F.coalesce("_start", F.lit(0)) + F.lit(top)
    numbered = new.drop("id").join(starts.drop("_n"), "hgnc_id").withColumn("id", ids).drop("_start")
    run.commit(
        gene_aggregations=K.replace_children(held, aggregations, aggregations, "hgnc_id"),
        associations=old.join(aggregations, "hgnc_id", "left_anti").unionByName(numbered, allowMissingColumns=True),
    )


def live_associations(run: Store) -> DataFrame:
    """Associations whose gene has an aggregation; others are orphans."""
    return run.read("associations").join(run.read("gene_aggregations"), "hgnc_id", "left_semi")


def due_mapping(run: Store) -> DataFrame:
    due = live_associations(run).where("mondo_id IS NULL OR mondo_match = 'gencc'")
    return due.join(_pending(run, "map_mondo"), F.col("id").cast("string") == F.col("subject"), "left_anti").orderBy("id")


def due_matching(run: Store) -> DataFrame:
    due = live_associations(run).where("matched_panels_json IS NULL")
    return due.join(_pending(run, "match_panels"), F.col("id").cast("string") == F.col("subject"), "left_anti").orderBy("id")


def store_columns(run: Store, table: str, answers: DataFrame, key: str) -> None:
    """Answers overwrite columns of their rows; the last of a key counts by ``ordinal``."""
    columns = [c for c in answers.columns if c not in (key, "ordinal")]
    run.commit(**{table: K.upsert(run.read(table), answers.join(run.read(table), key, "left_semi"), key, "ordinal", {c: K.LAST for c in columns})})


# ------------------------------------------------------------------ journals, requests


def due_journals(run: Store) -> DataFrame:
    return run.read("papers").where("journal_issn IS NOT NULL").select(F.upper("journal_issn").alias("issn")).distinct().join(run.read("journal_metrics"), "issn", "left_anti")


def store_journals(run: Store, asked: DataFrame, sources: DataFrame, now: str) -> None:
    """Metrics of the ISSNs asked for, from sources (id, name, issns, works, citedness, ordinal): of several,
    that with most works, the first on ties; a row of nulls where there is none."""
    one = sources.select(F.explode("issns").alias("issn"), "id", "name", "works", "citedness", "ordinal").withColumn("issn", F.upper("issn"))
    best = one.groupBy("issn").agg(F.max_by(F.struct("id", "name", "citedness"), F.struct("works", -F.col("ordinal"))).alias("s"))
    rows = asked.select(F.upper("issn").alias("issn")).distinct().join(best, "issn", "left")
    new = rows.select("issn", F.col("s.id").alias("openalex_source_id"), F.col("s.name").alias("openalex_display_name"), F.col("s.citedness").alias("two_year_mean_citedness"), F.lit(now).alias("fetched_at"))
    run.commit(journal_metrics=K.replace_children(run.read("journal_metrics"), new, new, "issn"))


def record_results(run: Store, results: DataFrame, now: str) -> None:
    """Results of requests, by custom_id; a batch is collected once none of its requests is pending."""
    requests = run.read("llm_requests")
    identity = {"custom_id", "batch_id", "stage", "subject", "round", "model"}
    changes = [c for c in results.columns if c not in identity]
    only_new = K.Fold(lambda c, o: F.max_by(c, o), lambda old, new: old)
    folds = {c: only_new for c in results.columns if c in identity - {"custom_id"}} | {c: K.LAST for c in changes}
    out = K.upsert(requests, results.withColumn("_n", F.lit(0)), "custom_id", "_n", folds)
    open_ = out.where("status = 'pending'").select("batch_id").distinct()
    batches = P.with_flag(run.read("llm_batches"), open_, [("batch_id", "batch_id")], "_open")
    collected = F.when(F.col("_open"), F.col("collected_at")).otherwise(F.coalesce("collected_at", F.lit(now)))
    run.commit(llm_requests=out, llm_batches=batches.withColumn("collected_at", collected).drop("_open"))


def costs(run: Store, prices: DataFrame, batch_factor: float = 0.5) -> DataFrame:
    """Requests, outcomes, tokens and USD by stage, model and tier. ``prices``: model, and per million tokens
    input, output, write_5m, write_1h, read."""
    tokens = ("input_tokens", "output_tokens", "cache_write_5m_tokens", "cache_write_1h_tokens", "cache_read_tokens")
    g = run.read("llm_requests").groupBy("stage", "model", "service_tier").agg(
        F.count("*").alias("requests"),
        *(F.count_if(F.col("status") == s).alias(s) for s in ("succeeded", "refused", "errored", "expired", "canceled", "pending")),
        *(F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in tokens),
    )
    cost = sum((F.col(c) * F.col(p) for c, p in zip(tokens, ("input", "output", "write_5m", "write_1h", "read"))), F.lit(0.0))
    tier = F.when(F.col("service_tier") == "batch", batch_factor).otherwise(1.0)
    return g.join(prices, "model", "left").select("stage", "model", "service_tier", "requests", "succeeded", "refused", "errored", "expired", "canceled", "pending", *tokens, F.round(cost / 1e6 * tier, 6).alias("usd"))


def refusals(run: Store) -> DataFrame:
    """Refused requests with the last settled outcome of their subject."""
    r = run.read("llm_requests").withColumn("at", F.to_timestamp("completed_at"))
    last = L.latest(r.where("status <> 'pending'"), ["stage", "subject"], ["at", "custom_id"], ["status"]).withColumnRenamed("status", "outcome")
    return r.where("status = 'refused'").join(last, ["stage", "subject"]).select("stage", "subject", "model", "refusal_category", "outcome", "completed_at")


# ------------------------------------------------------------------ training data, gene texts


def mark_positives(training: DataFrame, positives: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The training rows with listed DOIs (value) marked relevant, and the listed DOIs that are missing."""
    marked = P.with_flag(training, positives, [("doi", "value")], "_positive")
    out = marked.withColumn("is_relevant", F.col("_positive") | F.col("is_relevant")).drop("_positive")
    return out, positives.select("value").distinct().join(training, F.col("value") == F.col("doi"), "left_anti")


def gene_texts(entries: DataFrame) -> DataFrame:
    """(symbol, text): the comments of a gene's reviews, in order, joined by blank lines; genes without text
    are left out. ``entries``: symbol, ordinal, evaluations array<struct<comments:array<struct<comment:string>>>>."""
    rows = entries.select("symbol", "ordinal", F.posexplode("evaluations").alias("n", "e")).select("symbol", "ordinal", "n", F.posexplode("e.comments").alias("m", "c"))
    texts = rows.select("symbol", "ordinal", "n", "m", F.trim("c.comment").alias("t")).where("t <> ''")
    by = texts.groupBy("symbol").agg(F.array_sort(F.collect_list(F.struct("ordinal", "n", "m", "t"))).alias("rows"))
    return by.select("symbol", F.array_join(F.transform("rows", lambda r: r["t"]), "\n\n").alias("text"))


def days(start: str, end: str, spark) -> DataFrame:
    """The calendar days of a window, both ends included."""
    return spark.range(1).select(F.explode(F.sequence(_day(start), _day(end))).alias("day"))
