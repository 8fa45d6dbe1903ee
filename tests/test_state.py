"""Keyed state: folds, guards, replay, and the exact partition of due and settled rows."""

from __future__ import annotations

import datetime
import itertools

import pytest
from pyspark.sql import functions as F

from scriptorium.operators import keyed as K
from scriptorium.operators import predicates as P
from scriptorium.streaming.sync import Ledger, sync, working_set

DAY = datetime.date(2024, 1, 5)


@pytest.mark.parametrize("start, months, want", [("2026-06-23", 6, "2025-12-23"), ("2026-03-31", 1, "2026-02-28"), ("2024-03-31", 1, "2024-02-29"), ("2026-01-15", 1, "2025-12-15"), ("2027-01-31", 1, "2026-12-31")])
def test_months_before(spark, start, months, want):
    got = spark.range(1).select(F.add_months(F.lit(start).cast("date"), -months).cast("string").alias("d")).first()["d"]
    assert got == want


def test_settled_and_actionable_part_all_rows(spark):
    rows = list(itertools.product([None, False, True], [None, "scheduled", "manual_required", "downloaded"]))
    df = spark.createDataFrame(rows, "relevant boolean, download_status string").withColumn("settled", P.settled())
    for r in df.collect():
        assert r["settled"] == (r["relevant"] is False or r["download_status"] == "downloaded")
    assert df.where(P.settled()).count() + df.where(~P.settled()).count() == 12


def test_upsert_folds_in_order(spark):
    stored = spark.createDataFrame([("a", 1, "old", "kept"), ("b", None, "b", None)], "doi string, pmid long, title string, status string")
    incoming = spark.createDataFrame([("a", None, "one", 1), ("a", 7, "two", 2), ("a", None, "three", 3), ("c", None, "c", 1)], "doi string, pmid long, title string, n long")
    folds = {"pmid": K.KNOWN, "title": K.LAST}
    once = K.upsert(stored, incoming, "doi", "n", folds)
    want = [("a", 7, "three", "kept"), ("b", None, "b", None), ("c", None, "c", None)]
    assert [tuple(r) for r in once.orderBy("doi").collect()] == want
    assert [tuple(r) for r in K.upsert(once, incoming, "doi", "n", folds).orderBy("doi").collect()] == want


def test_guarded_upsert_compares_text(spark):
    stored = spark.createDataFrame([("a", "10"), ("b", "9")], "doi string, d string")
    incoming = spark.createDataFrame([("a", "9", 1), ("b", "10", 1)], "doi string, d string, n long")
    out = K.upsert(stored, incoming, "doi", "n", {"d": K.LAST}, lambda old, new: F.col(f"{new}.d") > F.col(f"{old}.d"))
    assert {r["doi"]: r["d"] for r in out.collect()} == {"a": "9", "b": "9"}


def test_rank_merge(spark):
    df = spark.createDataFrame([("a", None), ("a", "scheduled"), ("a", "downloaded"), ("b", None)], "k string, s string")
    got = df.groupBy("k").agg(K.best_by_rank("s", ["scheduled", "manual_required", "downloaded"]).alias("s"))
    assert {r["k"]: r["s"] for r in got.collect()} == {"a": "downloaded", "b": None}


def test_flags_never_multiply_rows(spark):
    df = spark.createDataFrame([("a",), ("b",), (None,)], "doi string")
    keys = spark.createDataFrame([("a",), ("a",), (None,)], "k string")
    got = P.with_flag(df, keys, [("doi", "k")], "hit").collect()
    assert sorted((r["doi"] or "", r["hit"]) for r in got) == [("", False), ("a", True), ("b", False)]


SCHEMA = "number long, ordinal long, doi string, pmid long, title string, source_date date, relevant boolean, download_status string"


def _file(spark, folder, number, rows):
    df = spark.createDataFrame([(number, k, *r, None, None) for k, r in enumerate(rows)], SCHEMA)
    df.coalesce(1).write.mode("append").parquet(folder)


def test_files_are_applied_once_in_order_and_replay_changes_nothing(spark, tmp_path):
    files, ledger = str(tmp_path / "files"), Ledger(spark, str(tmp_path / "ledger"))
    _file(spark, files, 1, [("a", 1, "first", DAY), ("b", None, "b", DAY)])
    sync(spark, files, SCHEMA, ledger, str(tmp_path / "check"), "2024-02-01")
    _file(spark, files, 2, [("a", None, "second", DAY), ("old", 9, "late", datetime.date(2020, 1, 1))])
    sync(spark, files, SCHEMA, ledger, str(tmp_path / "check"), "2024-02-02")
    rows = {r["doi"]: r for r in ledger.read().collect()}
    assert rows["a"]["title"] == "second" and rows["a"]["pmid"] == 1
    assert str(rows["a"]["first_seen"]) == "2024-02-01" and str(rows["a"]["last_seen"]) == "2024-02-02"
    assert ledger.state()[2] == 2
    before = sorted(map(tuple, ledger.read().collect()), key=repr)
    sync(spark, files, SCHEMA, ledger, str(tmp_path / "check"), "2024-02-03")
    sync(spark, files, SCHEMA, ledger, str(tmp_path / "other"), "2024-02-03")  # all files met again
    assert sorted(map(tuple, ledger.read().collect()), key=repr) == before
    assert {r["doi"] for r in working_set(ledger.read(), "2024-06-30").collect()} == {"a", "b"}


def test_floor_leaves_old_rows_out(spark, tmp_path):
    files, ledger = str(tmp_path / "files"), Ledger(spark, str(tmp_path / "ledger"))
    _file(spark, files, 1, [("a", 1, "x", DAY), ("old", 2, "y", datetime.date(2020, 1, 1))])
    sync(spark, files, SCHEMA, ledger, str(tmp_path / "check"), "2024-02-01", floor="2023-01-01")
    assert [r["doi"] for r in ledger.read().collect()] == ["a"]


def test_a_batch_of_files_rewrites_only_the_buckets_it_touches(spark, tmp_path):
    files, ledger = str(tmp_path / "files"), Ledger(spark, str(tmp_path / "ledger"), buckets=8)
    _file(spark, files, 1, [(f"k{k}", k, "x", DAY) for k in range(100)])
    sync(spark, files, SCHEMA, ledger, str(tmp_path / "check"), "2024-02-01")
    first = ledger.state()[1]
    assert set(first) == set(range(8)) and len(set(first.values())) == 1
    _file(spark, files, 2, [("k7", None, "two", DAY)])
    _file(spark, files, 3, [("k7", None, "three", DAY)])
    sync(spark, files, SCHEMA, ledger, str(tmp_path / "check"), "2024-02-02")
    second = ledger.state()[1]
    assert sum(first[b] != second[b] for b in first) == 1 and ledger.state()[2] == 3
    rows = {r["doi"]: r["title"] for r in ledger.read().collect()}
    assert len(rows) == 100 and rows["k7"] == "three" and rows["k8"] == "x"
    before = ledger.read().count()
    _file(spark, files, 4, [(f"k{k}", k, "y", DAY) for k in range(100)])
    sync(spark, files, SCHEMA, ledger, str(tmp_path / "check"), "2024-02-03")
    assert ledger.vacuum() == 2 and ledger.read().count() == before


def test_of_two_writers_from_one_state_the_later_fails(spark, tmp_path):
    from scriptorium import schemas
    from scriptorium.store import Conflict, Store

    table = next(iter(schemas.TABLES)) if hasattr(schemas, "TABLES") else "journals"
    frame = spark.createDataFrame([], schemas.of(table))
    a, b = Store(spark, str(tmp_path / "run")), Store(spark, str(tmp_path / "run"))
    a.commit(**{table: frame})
    state = b._last()
    a.commit(**{table: frame})
    b._last = lambda: state
    with pytest.raises(Conflict):
        b.commit(**{table: frame})
    assert a._last()[0] == 2 and a.read(table).count() == 0
    assert a.vacuum() >= 1 and a.read(table).count() == 0
