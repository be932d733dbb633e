"""Ledger, batch checks, watch list and table report."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from rolecall.operators import (
    add_terms,
    batch_gates,
    break_runs,
    close_runs,
    failed_keywords,
    fold_runs,
    list_terms,
    open_runs,
    remove_terms,
    run_status,
    schema_report,
    seed_terms,
)
from rolecall.schemas import JOBS, RUNS, SEED_TERMS, WATCHED

AT = datetime(2024, 1, 1)
LATER = datetime(2024, 1, 2)


@pytest.mark.parametrize(
    "counts, want",
    [((0, 0, 0, 0), "success"), ((0, 0, 3, 1), "partial"), ((0, 0, 0, 2), "failed"), ((1, 0, 0, 0), "success"),
     ((0, 1, 0, 5), "partial")],
)
def test_status(spark, counts, want):
    assert spark.range(1).select(run_status(*map(F.lit, counts))).first()[0] == want


def runs(spark, *ids):
    rows = [(i, f"kw {i}", AT, LATER) for i in ids]
    return spark.createDataFrame(rows, "run_id string, keyword string, started_at timestamp_ntz, completed_at timestamp_ntz")


def test_open_and_close(spark):
    opened = open_runs(runs(spark, "a", "b", "c"))
    assert opened.columns == RUNS.names
    assert {(r.status, r.completed_at, r.fetched_count) for r in opened.collect()} == {("running", None, 0)}
    outcomes = spark.createDataFrame(
        [("a", "inserted"), ("a", "updated"), ("a", "skipped"), ("a", "failed"), ("b", "inserted")],
        "run_id string, outcome string",
    )
    errors = spark.createDataFrame([("b",)], "run_id string")
    closed = close_runs(opened, outcomes, errors, completed_at=LATER)
    got = {r.run_id: tuple(r)[2:8] + (r.errored,) for r in closed.collect()}
    assert got == {
        "a": (4, 1, 1, 1, 1, "partial", False),
        "b": (0, 0, 0, 0, 0, "failed", True),
        "c": (0, 0, 0, 0, 0, "success", False),
    }
    assert {r.completed_at for r in closed.collect()} == {LATER}
    assert {r.completed_at for r in close_runs(runs(spark, "a"), outcomes).collect()} == {LATER}


def test_gates(spark):
    outcomes = spark.createDataFrame([("a", "inserted"), ("a", "failed"), ("c", "failed")], "run_id string, outcome string")
    errors = spark.createDataFrame([("b",)], "run_id string")
    closed = close_runs(runs(spark, "a", "b", "c"), outcomes, errors)
    watched = closed.select("keyword")

    def gate(ledger, terms, **limits):
        row = batch_gates(ledger, terms, **limits).first()
        return row.ok, row.reason

    assert gate(closed, watched) == (False, "only 2 of 3 keywords succeeded, 3 required; failed: kw b")
    assert gate(closed, watched, min_succeeded=2) == (True, None)
    assert gate(closed, watched, min_succeeded=2, min_inserted=2) == (False, "inserted 1 postings, 2 required")
    assert gate(closed.limit(0), watched.limit(0)) == (False, "no search terms are watched")
    row = batch_gates(closed, watched).first()
    assert (row.keywords, row.succeeded, row.required, row.inserted) == (3, 2, 3, 1)


def test_gates_go_by_keyword(spark):
    rows = [("1", "a", "success", False, 5), ("2", "a", "partial", False, 2), ("3", "b", "failed", True, 0),
            ("4", "other", "success", False, 9), ("5", "c", "running", False, 0)]
    facts = spark.createDataFrame(rows, "run_id string, keyword string, status string, errored boolean, inserted_count long")

    def gate(*terms, **limits):
        row = batch_gates(facts, keywords(spark, *terms), **limits).first()
        return row.ok, row.reason, row.succeeded, row.inserted

    assert gate("a") == (True, None, 1, 7)
    assert gate("a", "b") == (False, "only 1 of 2 keywords succeeded, 2 required; failed: b", 1, 7)
    assert gate("a", "z", "c", "c") == (False, "only 1 of 3 keywords succeeded, 3 required; failed: c, z (not run)", 1, 7)
    assert gate("a", "z", min_succeeded=1, min_inserted=8) == (False, "inserted 7 postings, 8 required", 1, 7)
    many = [f"k{i:02}" for i in range(14)]
    assert gate(*many)[1].endswith("k09 (not run) and 4 more")
    assert [tuple(r) for r in failed_keywords(facts, keywords(spark, "a", "z", "b")).collect()] == [("b", True), ("z", False)]


def test_one_row_per_run(spark):
    closed = close_runs(runs(spark, "a", "b"), spark.createDataFrame([("a", "inserted"), ("b", "failed")], "run_id string, outcome string"))
    again = close_runs(runs(spark, "a"), spark.createDataFrame([("a", "skipped"), ("a", "failed")], "run_id string, outcome string"))
    opened, broken = open_runs(runs(spark, "c")), break_runs(runs(spark, "b", "d"))
    rows = fold_runs(closed.unionByName(again).unionByName(opened).unionByName(broken)).collect()
    got = {r.run_id: (r.fetched_count, r.inserted_count, r.skipped_count, r.failed_count, r.status, r.errored) for r in rows}
    assert got == {
        "a": (3, 1, 1, 1, "partial", False), "b": (1, 0, 0, 1, "partial", True),
        "c": (0, 0, 0, 0, "running", False), "d": (0, 0, 0, 0, "failed", True),
    }
    assert [f.name for f in fold_runs(closed).schema] == RUNS.names


def keywords(spark, *terms):
    return spark.createDataFrame([(t,) for t in terms], "keyword string")


def names(rows):
    return [r.keyword for r in rows.collect()]


def test_watch_list(spark):
    seeded = seed_terms(spark, None, AT)
    assert names(list_terms(seeded)) == sorted(SEED_TERMS)
    assert seeded.schema.simpleString() == WATCHED.simpleString()
    again = seed_terms(spark, seeded, LATER)
    assert {r.created_at for r in again.collect()} == {AT}
    more, added = add_terms(seeded, keywords(spark, " Data  ENGINEER", "new One", "NEW one"), LATER)
    assert names(added) == ["new one"] and more.count() == 5
    fewer, removed = remove_terms(more, keywords(spark, "New one", "absent"))
    assert names(removed) == ["new one"] and fewer.count() == 4
    with pytest.raises(Exception, match="keyword must not be empty"):
        names(add_terms(seeded, keywords(spark, "  "), AT)[0])
    with pytest.raises(Exception, match="not be longer than 255"):
        names(add_terms(seeded, keywords(spark, "x" * 256), AT)[0])
    assert names(add_terms(seeded, keywords(spark, " " + "x" * 255), AT)[1]) == ["x" * 255]
    with pytest.raises(ValueError, match="keep at least 1"):
        remove_terms(seeded, keywords(spark, *SEED_TERMS), min_terms=1)
    remove_terms(seeded, keywords(spark, *SEED_TERMS[1:]), min_terms=1)


def test_report(spark):
    rows = spark.createDataFrame([(None, "x" * 11), ("1", "US")], "external_id string, country string")
    table = rows.select(
        *[(F.col(f.name) if f.name in rows.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in JOBS]
    )
    report = schema_report(table).collect()
    assert [r.column_name for r in report] == JOBS.names
    assert report[0][1:] == ("external_id", "string", False, 1, 0)
    assert report[4][1:] == ("country", "string", True, 0, 1)
    assert report[12].data_type == "array<string>"
