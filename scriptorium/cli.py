"""Command line: ``python -m scriptorium <command> ...`` over stores and files."""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession

from . import stages
from .store import Store
from .workers import reach


def _frame(spark: SparkSession, path: str) -> DataFrame:
    """A parquet folder, or JSON lines by the ending ``.json`` or ``.jsonl``."""
    return spark.read.json(path) if path.endswith((".json", ".jsonl")) else spark.read.parquet(path)


def _parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="scriptorium", description="Curation stages over versioned parquet stores.")
    sub = p.add_subparsers(dest="command", required=True)

    def command(name: str, *options: str, **kinds) -> None:
        c = sub.add_parser(name)
        for o in options:
            optional = o.endswith("?")
            c.add_argument(f"--{o.rstrip('?')}", required=not optional, type=kinds.get(o.rstrip("?"), str))

    command("query", "name", "tables", "out?")
    command("ledger-init", "ledger")
    command("ledger-sync", "ledger", "articles", "year", "today", "floor?", year=int)
    command("ledger-seed", "ledger", "runs")
    command("ledger-seed-run", "ledger", "run", "end", "months?", months=int)
    command("ledger-writeback", "ledger", "run", "name", "today")
    command("ingest-articles", "run", "path", "details")
    command("due-relevance", "run", "out", "limit?", limit=int)
    command("store-screens", "run", "answers")
    command("settle-refused", "run", "model")
    command("reopen-refused", "run")
    command("genes-to-reduce", "run", "most", "out", most=int)
    command("clear-unselected", "run", "selected")
    command("link-citations", "run", "cited")
    command("manual-worklist", "run", "out")
    command("register-files", "run", "files")
    command("due-extraction", "run", "out", "limit?", limit=int)
    command("store-extraction", "run", "answers")
    command("referenced-sources", "run", "out")
    command("store-aggregation", "run", "aggregations", "associations")
    command("store-expansion", "run", "papers")
    command("due-mapping", "run", "out")
    command("due-matching", "run", "out")
    command("due-journals", "run", "out")
    command("costs", "run", "prices")
    command("refusals", "run")
    command("vacuum", "run")
    return p


def main(args: list[str] | None = None, spark: SparkSession | None = None) -> int:
    a = _parser().parse_args(args)
    spark = reach(spark or SparkSession.builder.appName("scriptorium").config("spark.sql.session.timeZone", "UTC").getOrCreate())
    run = Store(spark, a.run) if getattr(a, "run", None) else None
    ledger = Store(spark, a.ledger) if getattr(a, "ledger", None) else None
    write = lambda df: df.write.mode("overwrite").parquet(a.out)
    match a.command:
        case "query":
            from .registry import QUERIES

            df = QUERIES[a.name](spark, a.tables)
            write(df) if a.out else df.show(50, truncate=False)
        case "ledger-init":
            stages.ledger_init(ledger)
        case "ledger-sync":
            print(stages.ledger_sync(ledger, _frame(spark, a.articles), a.year, a.today, a.floor))
        case "ledger-seed":  # run folders, oldest first, with commas between
            print(stages.seed_ledger(ledger, [Store(spark, folder).read("papers") for folder in a.runs.split(",")]))
        case "ledger-seed-run":
            print(stages.seed_run(ledger, run, a.end, a.months or 6))
        case "ledger-writeback":
            print(stages.writeback(ledger, run, a.name, a.today))
        case "ingest-articles":
            from pyspark.sql import functions as F

            from .sources.bibliography import read_article_sets

            papers, skipped = read_article_sets(spark, a.path)
            rows = papers.withColumnRenamed("issn", "journal_issn").withColumns({"source": F.lit("pubmed"), "source_metadata": F.lit(None).cast("string"), "ordinal": F.monotonically_increasing_id()})
            stages.ingest(run, rows, a.details)
            skipped.show()
        case "due-relevance":
            write(stages.due_relevance(run, a.limit))
        case "store-screens":
            stages.store_screens(run, _frame(spark, a.answers))
        case "settle-refused":
            print(stages.settle_refused(run, a.model))
        case "reopen-refused":
            stages.reopen_refused(run)
        case "genes-to-reduce":
            write(stages.genes_to_reduce(run, a.most))
        case "clear-unselected":
            stages.clear_unselected(run, _frame(spark, a.selected)).show()
        case "link-citations":
            print(*stages.link_citations(run, _frame(spark, a.cited)))
        case "manual-worklist":
            write(stages.manual_worklist(run))
        case "register-files":
            print(stages.register_files(run, _frame(spark, a.files)))
        case "due-extraction":
            write(stages.due_extraction(run, a.limit))
        case "store-extraction":
            stages.store_extraction(run, _frame(spark, a.answers))
        case "referenced-sources":
            write(stages.referenced_sources(run))
        case "store-aggregation":
            stages.store_aggregation(run, _frame(spark, a.aggregations), _frame(spark, a.associations))
        case "store-expansion":
            stages.store_expansion(run, _frame(spark, a.papers))
        case "vacuum":
            print(run.vacuum())
        case "due-mapping":
            write(stages.due_mapping(run))
        case "due-matching":
            write(stages.due_matching(run))
        case "due-journals":
            write(stages.due_journals(run))
        case "costs":
            stages.costs(run, _frame(spark, a.prices)).show(200, truncate=False)
        case "refusals":
            stages.refusals(run).show(200, truncate=False)
    return 0
