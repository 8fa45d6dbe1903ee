"""Stages over small stores: the corpus, due sets, ledgers, replacement of children, journals."""

from __future__ import annotations

import datetime
import json

import pytest

from scriptorium import cli, schemas, stages
from scriptorium.store import Store

YES = json.dumps({"relevant": True, "screen": {"relevant": True}})
NO = json.dumps({"relevant": False, "screen": {"relevant": False}})
DAY = datetime.date(2024, 5, 1)


def frame(spark, table, rows):
    fields = schemas.of(table)
    return spark.createDataFrame([tuple(r.get(f.name) for f in fields) for r in rows], fields)


def paper(doi, **more):
    return {"doi": doi, "title": doi, "source": "pubmed", "source_type": "initial", "source_date": DAY} | more


@pytest.fixture
def run(spark, tmp_path):
    store = Store(spark, str(tmp_path / "run"))
    papers = [
        paper("10.1/relevant", relevance_assessment_json=YES, download_status="downloaded", pmid=1),
        paper("10.1/not", relevance_assessment_json=NO, download_status="downloaded"),
        paper("10.1/cited", download_status="downloaded", pmid=3),
        paper("10.1/CASE", download_status="manual_required"),
        paper("10.1/new"),
        paper("10.1/expansion", source_type="expansion", source_details="9"),
    ]
    mentions = [(1, "10.1/relevant", "recent_evidence"), (2, "10.1/not", "recent_evidence"), (3, "10.1/expansion", "expansion_evidence"), (5, "10.1/relevant", "relevance_assessment")]
    store.commit(
        papers=frame(spark, "papers", papers),
        gene_mentions=frame(spark, "gene_mentions", [{"hgnc_id": g, "paper_doi": d, "source": s, "paper_gene_symbol": "G"} for g, d, s in mentions]),
        panelapp_citations=frame(spark, "panelapp_citations", [{"hgnc_id": 1, "paper_doi": "10.1/cited"}, {"hgnc_id": 2, "paper_doi": "10.1/new"}]),
    )
    return store


def ids(df, column="doi"):
    return sorted(r[column] for r in df.collect())


def test_corpus_and_due_sets(spark, run):
    assert ids(stages.run_genes(run), "hgnc_id") == [1]
    assert ids(stages.corpus(run)) == ["10.1/cited", "10.1/expansion", "10.1/relevant"]
    assert ids(stages.due_extraction(run)) == ["10.1/cited", "10.1/relevant"]
    assert ids(stages.due_relevance(run)) == ["10.1/CASE", "10.1/cited", "10.1/new"]
    assert ids(stages.due_relevance(run, 1)) == ["10.1/CASE"]
    run.commit(llm_requests=frame(spark, "llm_requests", [{"custom_id": "a", "stage": "extraction", "subject": "10.1/cited", "round": 1, "model": "m", "status": "pending"}]))
    assert ids(stages.due_extraction(run)) == ["10.1/relevant"]


def test_reduction_counts(run):
    assert [tuple(r) for r in stages.genes_to_reduce(run, 0).collect()] == [(1, 1)]
    assert not stages.genes_to_reduce(run, 1).collect()
    assert ids(stages.papers_of_small_genes(run, 1), "paper_doi") == ["10.1/relevant"]


def test_screens_are_stored_once(spark, run):
    answers = spark.createDataFrame([("10.1/new", '{"relevant":true}', [(7, "G7"), (7, "G7")])], "doi string, screen string, genes array<struct<hgnc_id:long,symbol:string>>")
    for _ in range(2):
        stages.store_screens(run, answers)
    row = run.read("papers").where("doi = '10.1/new'").first()
    assert row["download_status"] == "scheduled" and json.loads(row["relevance_assessment_json"])["relevant"] is True
    assert run.read("gene_mentions").where("hgnc_id = 7").count() == 1


def test_refusals_settle_and_reopen(spark, run):
    request = {"stage": "relevance", "subject": "10.1/new", "round": 1, "status": "refused", "refusal_category": "bio"}
    run.commit(llm_requests=frame(spark, "llm_requests", [request | {"custom_id": "a", "model": "last", "completed_at": "2024-01-01T00:00:00Z"}, request | {"custom_id": "b", "model": "first", "subject": "10.1/CASE", "completed_at": "2024-01-01T00:00:00Z"}]))
    assert stages.settle_refused(run, "last") == 1
    stored = json.loads(run.read("papers").where("doi = '10.1/new'").first()["relevance_assessment_json"])
    assert stored == {"relevant": False, "screen": None, "refused": {"model": "last", "category": "bio"}}
    assert {(r["subject"], r["outcome"]) for r in stages.refusals(run).collect()} == {("10.1/new", "refused"), ("10.1/CASE", "refused")}
    stages.reopen_refused(run)
    assert run.read("papers").where("doi = '10.1/new'").first()["relevance_assessment_json"] is None


def test_citation_links(spark, run):
    cited = spark.createDataFrame([(1, 3, None), (1, None, "10.1/case"), (2, None, "10.1/NEW"), (2, 99, None)], "hgnc_id long, pmid long, doi string")
    assert stages.link_citations(run, cited) == (3, 1)
    assert {(r["hgnc_id"], r["paper_doi"]) for r in run.read("panelapp_citations").collect()} == {(1, "10.1/cited"), (1, "10.1/CASE"), (2, "10.1/new")}
    assert run.read("papers").where("doi = '10.1/new'").first()["download_status"] == "scheduled"
    assert ids(stages.manual_worklist(run)) == ["10.1/CASE"]


def test_expansion_compares_genes_as_text(spark, run):
    new = frame(spark, "papers", [paper("10.1/expansion", source_details="10", download_status="scheduled"), paper("10.1/relevant", source_details="99"), paper("10.1/more", source_details="4")])
    stages.store_expansion(run, new)
    rows = {r["doi"]: r for r in run.read("papers").collect()}
    assert rows["10.1/expansion"]["source_details"] == "9" and rows["10.1/relevant"]["source_type"] == "initial" and rows["10.1/more"]["source_type"] == "expansion"


def test_files_and_clearing(spark, run):
    files = spark.createDataFrame([("10.1%2FCASE.pdf",), ("other.pdf",)], "name string")
    assert stages.register_files(run, files) == 1
    counts = stages.clear_unselected(run, spark.createDataFrame([("10.1/cited",)], "doi string")).collect()
    assert [tuple(r) for r in counts] == [("downloaded", 3, 1)]
    assert ids(run.read("papers").where("download_status IS NOT NULL")) == ["10.1/cited"]


def test_extraction_replaces_mentions(spark, run):
    doc = {"gene_evaluations": [{"hgnc_id": 1, "paper_gene_symbol": "A", "disease_entities": [{"previously_reported_sources": [{"title": "T", "context": "c"}, {"title": "NR"}]}]}, {"hgnc_id": 4, "paper_gene_symbol": "D"}]}
    stages.store_extraction(run, spark.createDataFrame([("10.1/relevant", "raw", json.dumps(doc))], "doi string, raw string, document string"))
    got = {(r["hgnc_id"], r["source"]) for r in run.read("gene_mentions").where("paper_doi = '10.1/relevant'").collect()}
    assert got == {(1, "recent_evidence"), (4, "recent_evidence")}
    assert [(r["doi"], r["title"]) for r in stages.referenced_sources(run).collect()] == [("10.1/relevant", "T")]


def test_aggregations_and_orphans(spark, run):
    agg = frame(spark, "gene_aggregations", [{"hgnc_id": 1, "assessment_raw": "r", "paper_id_mapping": "{}", "panelapp_context_json": "{}", "unassessed_reports_json": "[]"}])
    children = lambda n: frame(spark, "associations", [{"hgnc_id": 1, "position": k, "assessment_json": "{}"} for k in range(n)] + [{"hgnc_id": 8, "position": 0, "assessment_json": "{}"}]).drop("id")
    stages.store_aggregation(run, agg, children(2))
    stages.store_aggregation(run, agg, children(3))
    assert [(r["id"], r["hgnc_id"], r["position"]) for r in run.read("associations").orderBy("id").collect()] == [(3, 1, 0), (4, 1, 1), (5, 1, 2)]
    assert stages.due_mapping(run).count() == stages.due_matching(run).count() == 3
    stages.store_columns(run, "associations", spark.createDataFrame([(4, "M:1", "exact", 1), (99, "M:2", "exact", 1)], "id long, mondo_id string, mondo_match string, ordinal int"), "id")
    assert stages.due_mapping(run).count() == 2 and run.read("associations").count() == 3
    assert stages.due_genes(run, "assess_genes", "gene_aggregations").count() == 0
    run.commit(gene_aggregations=run.read("gene_aggregations").where("false"))
    assert stages.live_associations(run).count() == 0


def test_journals(spark, run):
    sources = spark.createDataFrame([("s1", "One", ["1111-111x", "2222-2222"], 5, 1.5, 0), ("s2", "Two", ["1111-111X"], 5, 2.5, 1), ("s3", "Three", ["2222-2222"], 9, 3.5, 2)], "id string, name string, issns array<string>, works long, citedness double, ordinal int")
    asked = spark.createDataFrame([("1111-111x",), ("2222-2222",), ("9999-9999",)], "issn string")
    stages.store_journals(run, asked, sources, "now")
    assert {r["issn"]: r["openalex_source_id"] for r in run.read("journal_metrics").collect()} == {"1111-111X": "s1", "2222-2222": "s3", "9999-9999": None}


def test_requests_and_costs(spark, run):
    base = {"stage": "s", "subject": "x", "round": 1, "model": "m", "batch_id": "b", "service_tier": "batch"}
    run.commit(llm_requests=frame(spark, "llm_requests", [base | {"custom_id": k, "status": "pending"} for k in "ab"]), llm_batches=frame(spark, "llm_batches", [{"batch_id": "b", "stage": "s", "round": 1, "model": "m", "submitted_at": "t"}]))
    done = lambda k: spark.createDataFrame([(k, "succeeded", 1_000_000, 100_000)], "custom_id string, status string, input_tokens long, output_tokens long")
    stages.record_results(run, done("a"), "t1")
    assert run.read("llm_batches").first()["collected_at"] is None
    stages.record_results(run, done("b"), "t2")
    assert run.read("llm_batches").first()["collected_at"] == "t2"
    prices = spark.createDataFrame([("m", 5.0, 25.0, 6.0, 10.0, 0.5)], "model string, input double, output double, write_5m double, write_1h double, read double")
    row = stages.costs(run, prices).first()
    assert (row["requests"], row["succeeded"], row["usd"]) == (2, 2, 7.5)


def test_ledger_round(spark, tmp_path, run):
    ledger = Store(spark, str(tmp_path / "ledger"))
    stages.ledger_init(ledger)
    rows = frame(spark, "papers", [paper("10.1/a", pmid=1), paper("10.1/b"), paper("10.1/old", source_date=datetime.date(2020, 1, 1)), paper("10.1/relevant")]).selectExpr("*", "1 AS number", "0 AS ordinal")
    assert stages.ledger_sync(ledger, rows, 24, "2024-05-02") == 1
    before = sorted(map(tuple, ledger.read("ledger").collect()), key=repr)
    assert stages.ledger_sync(ledger, rows, 24, "2024-06-02") == 1
    assert sorted(map(tuple, ledger.read("ledger").collect()), key=repr) == before
    assert stages.ledger_sync(ledger, rows.where("doi = '10.1/a'"), 25, "2025-01-01") == 1  # a new year counts anew
    assert stages.seed_run(ledger, run, "2024-06-01") == 2
    assert stages.writeback(ledger, run, "r1", "2024-06-03") == 0
    got = {r["doi"]: r for r in ledger.read("ledger").collect()}
    assert got["10.1/relevant"]["relevant"] and got["10.1/relevant"]["download_status"] == "downloaded" and got["10.1/not"]["relevant"] is False
    assert str(got["10.1/old"]["first_seen"]) == "2024-05-02" and got["10.1/old"]["relevant"] is None
    other = Store(spark, str(tmp_path / "again"))
    assert stages.seed_run(ledger, other, "2024-06-01") == len([1 for r in got.values() if r["relevant"] is not False and r["download_status"] != "downloaded" and r["source_date"] >= datetime.date(2023, 12, 1)])


def test_merging_runs_into_a_ledger(spark, tmp_path):
    ledger = Store(spark, str(tmp_path / "ledger"))
    ledger.commit(ledger=frame(spark, "ledger", [{"doi": "a", "pmid": 1, "title": "a", "source": "s", "first_seen": DAY, "last_seen": DAY}, {"doi": "b", "title": "b", "source": "s", "first_seen": DAY, "last_seen": DAY}]))
    schema = "doi string, pmid long, relevance_assessment_json string, relevant boolean, download_status string"
    old = spark.createDataFrame([("a", None, YES, True, "downloaded"), ("b", None, NO, False, None)], schema)
    new = spark.createDataFrame([(None, 1, None, None, "scheduled"), (None, 77, None, True, None), ("b", None, YES, True, None)], schema)
    assert stages.seed_ledger(ledger, [old, new]) == 1
    got = {r["doi"]: (r["relevant"], r["download_status"]) for r in ledger.read("ledger").collect()}
    assert got == {"a": (True, "downloaded"), "b": (True, None)}


def test_guarded_ingest(spark, run):
    rows = lambda d, title: frame(spark, "papers", [paper(d) | {"title": title}]).withColumn("ordinal", stages.F.lit(0)).drop("source_type", "source_details")
    stages.ingest(run, rows("10.1/x", "one"), "2024-02")
    stages.ingest(run, rows("10.1/x", "two"), "2024-01")
    assert run.read("papers").where("doi = '10.1/x'").first()["title"] == "one"
    stages.ingest(run, rows("10.1/x", "three"), "2024-03")
    assert run.read("papers").where("doi = '10.1/x'").first()["title"] == "three"


def test_enumerations_are_checked(spark, run):
    with pytest.raises(Exception, match="download_status: lost"):
        run.commit(papers=frame(spark, "papers", [paper("x", download_status="lost")]))
    assert run.read("papers").count() == 6  # the failed commit changed nothing


def test_texts_and_days(spark):
    entries = spark.createDataFrame([("A", 0, [([(" one ",), ("",)],), ([("two",)],)]), ("B", 1, [([("  ",)],)])], "symbol string, ordinal int, evaluations array<struct<comments:array<struct<comment:string>>>>")
    assert [tuple(r) for r in stages.gene_texts(entries).collect()] == [("A", "one\n\ntwo")]
    assert stages.days("2024-02-28", "2024-03-01", spark).count() == 3
    training = spark.createDataFrame([("a", False), ("b", False)], "doi string, is_relevant boolean")
    marked, missing = stages.mark_positives(training, spark.createDataFrame([("a",), ("z",)], "value string"))
    assert {r["doi"]: r["is_relevant"] for r in marked.collect()} == {"a": True, "b": False} and ids(missing, "value") == ["z"]


def test_command_line(spark, run, tmp_path, capsys):
    out = str(tmp_path / "out")
    assert cli.main(["due-extraction", "--run", run.folder, "--out", out, "--limit", "1"], spark) == 0
    assert ids(spark.read.parquet(out)) == ["10.1/cited"]
    cli.main(["ledger-init", "--ledger", str(tmp_path / "l")], spark)
    cli.main(["ledger-seed-run", "--ledger", str(tmp_path / "l"), "--run", run.folder, "--end", "2024-06-01"], spark)
    assert capsys.readouterr().out.strip() == "0"
