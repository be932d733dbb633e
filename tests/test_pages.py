"""Page-run assembly against a sequential reading of the rules."""

import random
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from rolecall.operators import (
    assemble_runs,
    clean_postings,
    dropped_results,
    failed_runs,
    flatten_postings,
    split_rejected,
)
from rolecall.plans.ingest import prepare
from rolecall.schemas import PAGE
from rolecall.sources import conf_set, read_pages

AT = datetime(2024, 1, 1)


def page(run, number, ids, count=None, error=None):
    results = None if ids is None else [{"id": i} for i in ids]
    return (run, f"kw {run}", number, count, AT, error, results)


def frame(spark, pages):
    return spark.createDataFrame(pages, PAGE)


def by_run(rows):
    found = {}
    for r in rows.orderBy("run_id", "page", "position").collect():
        found.setdefault(r.run_id, []).append((r.page, r.position, r.posting.id))
    return found


def sequential(pages, size, cap):
    """The rules, one page after the other."""
    runs, failed = {}, set()
    for run in sorted({p[0] for p in pages}):
        seen, kept = set(), []
        mine = sorted((p for p in pages if p[0] == run and p[2] <= cap), key=lambda p: p[2])
        for _, _, number, count, _, error, results in mine:
            if error:
                failed.add(run)
                kept = []
                break
            results = results or []
            for position, posting in enumerate(results):
                key = posting["id"]
                if key is None or key not in seen:
                    seen.add(key)
                    kept.append((number, position, key))
            if len(results) < size or (count is not None and len(kept) >= count):
                break
        if kept:
            runs[run] = kept
    return runs, failed


def test_stops(spark):
    pages = [
        page("short", 1, ["a", "b"]), page("short", 2, ["c"]), page("short", 3, ["d", "e"]),
        page("empty", 1, ["a", "b"]), page("empty", 2, []), page("empty", 3, ["c", "d"]),
        page("null", 1, ["a", "b"]), page("null", 2, None), page("null", 3, ["c", "d"]),
        page("count", 1, ["a", "b"], 3), page("count", 2, ["b", "c"], 3), page("count", 3, ["d", "e"], 3),
        page("none", 1, [None, None]), page("none", 2, [None, "x"]),
        page("cap", 1, ["a", "b"]), page("cap", 2, ["c", "d"]), page("cap", 3, ["e", "f"]), page("cap", 4, ["g", "h"]),
        page("first", 1, ["x"]),
        page("nothing", 1, []),
        page("error", 1, ["a", "b"]), page("error", 2, None, error="HTTP 503"),
        page("late error", 1, ["a"]), page("late error", 2, None, error="HTTP 503"),
    ]
    rows = frame(spark, pages)
    got = by_run(assemble_runs(rows, results_per_page=2, max_pages=3))
    want, failed = sequential(pages, 2, 3)
    assert got == want
    assert {r.run_id for r in failed_runs(rows, 2, 3).collect()} == failed == {"error"}
    assert [i for *_, i in got["short"]] == ["a", "b", "c"]
    assert [i for *_, i in got["count"]] == ["a", "b", "c"]
    assert got["none"] == [(1, 0, None), (1, 1, None), (2, 0, None), (2, 1, "x")]
    assert len(got["cap"]) == 6


def test_random_runs(spark):
    rng = random.Random(3)
    pages = []
    for run in range(120):
        count = rng.choice([None, rng.randint(0, 12)])
        for number in range(1, 8):
            ids = [rng.choice([None, *"abcdefgh"]) for _ in range(rng.choice([3, 3, 3, 3, 2, 0, 4]))]
            error = "x" if rng.random() < 0.04 else None
            pages.append(page(f"r{run:03}", number, None if error else ids, count, error))
    rows = frame(spark, pages).repartition(7)
    want, failed = sequential(pages, 3, 5)
    assert by_run(assemble_runs(rows, 3, 5)) == want
    assert {r.run_id for r in failed_runs(rows, 3, 5).collect()} == failed


def test_one_shuffle(spark):
    pages = frame(spark, [page("a", 1, ["x"])])
    plan = assemble_runs(pages, 50, 5)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1


def test_cap_must_be_positive(spark):
    with pytest.raises(ValueError):
        assemble_runs(frame(spark, []), results_per_page=50, max_pages=0)
    with pytest.raises(ValueError):
        assemble_runs(frame(spark, []), max_pages=3)


def test_all_landed_pages_count(spark):
    """Without the paging rule nothing is left out but repeated ids and broken runs."""
    pages = [page("long", n, [f"{n}a", f"{n}b"], 3) for n in range(1, 8)]
    pages += [page("gap", 1, ["x"]), page("gap", 2, []), page("gap", 9, ["x", "y", None, None])]
    pages += [page("error", 1, ["a"]), page("error", 2, [], error="HTTP 503")]
    pages += [page("twice", 1, ["a", "b"]), ("twice", "kw twice", 1, None, datetime(2024, 1, 2), None, [{"id": "b"}, {"id": "c"}])]
    rows = frame(spark, pages).repartition(5)
    got = by_run(assemble_runs(rows))
    assert len(got["long"]) == 14
    assert got["gap"] == [(1, 0, "x"), (9, 1, "y"), (9, 2, None), (9, 3, None)]
    assert sorted(i for *_, i in got["twice"]) == ["a", "b", "c"]
    assert {r.run_id for r in failed_runs(rows).collect()} == {"error"} and "error" not in got
    assert {r.dropped_count for r in dropped_results(rows).collect()} == {0}
    ruled = {r.run_id: r.dropped_count for r in dropped_results(rows, 2, 3).collect()}
    assert ruled == {"long": 10, "gap": 4, "error": 0, "twice": 0}


def test_no_window_over_a_run(spark):
    plan = assemble_runs(frame(spark, [page("a", 1, ["x"])]))._jdf.queryExecution().optimizedPlan().toString()
    windows = [line.split("windowspecdefinition(")[1] for line in plan.splitlines() if "Window [" in line]
    assert windows and all(w.split(" ASC")[0].count(",") >= 3 for w in windows)


def test_a_hot_run_is_dealt(spark):
    """Without broadcasts and adaptive changes, no task gets most of the rows of one run."""
    plain = {"autoBroadcastJoinThreshold": "-1", "adaptive.enabled": "false", "shuffle.partitions": "16"}
    before = {key: spark.conf.get(f"spark.sql.{key}") for key in plain}
    try:
        for key, value in plain.items():
            spark.conf.set(f"spark.sql.{key}", value)
        pages = [page("hot", n, [f"{n}-{i}" for i in range(20)] + ["same"]) for n in range(1, 201)]
        pages += [page("cold", 1, ["x"]), page("bad", 1, ["y"]), page("bad", 2, None, error="e")]
        rows = prepare(frame(spark, pages)).withColumn("_task", F.spark_partition_id())
        tasks = [r["count"] for r in rows.groupBy("_task").count().collect()]
        assert sum(tasks) == 200 * 20 + 2 and max(tasks) < 0.25 * sum(tasks)
        got = assemble_runs(frame(spark, pages)).withColumn("_task", F.spark_partition_id())
        tasks = [r["count"] for r in got.groupBy("_task").count().collect()]
        assert sum(tasks) == 200 * 20 + 2 and max(tasks) < 0.25 * sum(tasks)
        assert {r.run_id for r in got.select("run_id").distinct().collect()} == {"hot", "cold"}
    finally:
        for key, value in before.items():
            spark.conf.set(f"spark.sql.{key}", value)


def test_rejected_lines(spark, shared):
    good = '{"run_id":"r","keyword":"k","page":%s,"landed_at":"2024-01-01T06:00:00","results":[{"id":1}]}'
    lines = [good % 1, good % '"1"', good % 2 + "}", (good % 3)[:60], good % 0, good % "null", "nonsense",
             good.replace('"keyword":"k",', "") % 4, good.replace('"run_id":"r",', "") % 5,
             good.replace("2024-01-01T06", "yesterday") % 6, good.replace('"k"', '"' + "k" * 256 + '"') % 7]
    spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.text(shared)
    kept, rejected = split_rejected(read_pages(spark, shared))
    assert kept.columns == PAGE.names and [r.page for r in kept.collect()] in ([1], [1, 2])
    found = rejected.collect()
    assert len(found) == len(lines) - kept.count()
    reasons = {r.line: r.reason for r in found}
    assert reasons[good % '"1"'] == reasons["nonsense"] == reasons[(good % 3)[:60]] == "malformed"
    assert sorted(set(reasons.values())) == [
        "keyword too long", "malformed", "no keyword", "no landing time", "no page number", "no run_id"]


def test_json_pages(spark, shared):
    lines = [
        '{"run_id":"r","keyword":"k","page":1,"count":3,"landed_at":"2024-01-01T06:00:00","results":['
        '{"id":17,"title":"dev - remote","company":{"display_name":"Ann\'s"},"location":{"display_name":"NYC",'
        '"area":["US","NY"]},"salary_min":120000.5,"salary_max":"$130,000","description":"SQL",'
        '"redirect_url":"u","created":"2024-01-01T00:00:00Z"},'
        '{"id":"18","company":null,"location":{"area":[]}},{"title":"no id"}]}',
        '{"run_id":"r","keyword":"k","page":2,"count":"3"}',
    ]
    spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.text(shared)
    pages = read_pages(spark, shared)
    assert sorted((p.page, p["count"]) for p in pages.collect()) == [(1, 3), (2, None)]
    rows = clean_postings(flatten_postings(assemble_runs(pages))).orderBy("position").collect()
    a, b, c = rows
    assert (a.external_id, a.title, a.company, a.location, a.country) == ("17", "Dev", "Ann's", "NYC", "US")
    assert (str(a.salary_min), str(a.salary_max), a.is_remote, a.skills) == ("120000.50", "130000.00", True, ["sql"])
    assert (a.date_posted, a.fetched_at, a.failure) == (AT, datetime(2024, 1, 1, 6), None)
    assert (b.external_id, b.title, b.company, b.country, b.skills, b.failure) == ("18", "", None, None, [], None)
    assert (c.external_id, c.failure) == ("", "missing_id")


def test_pages_move_once_for_facts_of_their_run(spark):
    """Runs that failed, runs that are spoiled and times of completion meet the pages in one join."""
    pages = [page("a", 1, ["x", "y"]), page("a", 2, ["y"]), page("b", 1, ["x"]), page("c", 1, ["z"]), page("c", 2, None, error="e")]
    spoiled = spark.createDataFrame([("b",)], "run_id string")
    with conf_set(spark, {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}):
        rows = prepare(frame(spark, pages), spoiled=spoiled)
        lines = rows._jdf.queryExecution().executedPlan().toString().splitlines()
        found = rows.collect()
    moved = [a for a, b in zip(lines, lines[1:]) if "Exchange hashpartitioning" in a and "results" in b]
    assert len(moved) == 1, moved
    assert sorted((r.run_id, r.external_id) for r in found) == [("a", "x"), ("a", "y")]
    ruled = prepare(frame(spark, pages), 2, 3, spoiled).collect()
    assert sorted((r.run_id, r.external_id) for r in ruled) == [("a", "x"), ("a", "y"), ("c", "z")]
    assert {r._completed for r in found + ruled} == {AT}
