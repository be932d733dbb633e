"""Market questions: hand-made tables, plans, skew and partitioning."""

from datetime import date, datetime, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from rolecall.plans import market
from rolecall.schemas import JOBS
from rolecall.sources import read_postings

D = Decimal
MONDAY = datetime(2024, 1, 1)


def job(n, company=None, low=None, high=None, remote=False, posted=None, fetched=None, skills=(), title="Dev"):
    money = [None if x is None else D(x) for x in (low, high)]
    return (str(n), title, company, None, None, *money, remote, None, None, posted, fetched, list(skills))


@pytest.fixture(scope="module")
def jobs(spark):
    rows = [
        job(1, "a", 100, 200, True, MONDAY, MONDAY, ["sql", "java"], "Data Engineer"),
        job(2, "a", 101, 151, False, MONDAY + timedelta(days=6), MONDAY, ["sql"], "data engineer"),
        job(3, "a", None, 900, None, None, MONDAY + timedelta(hours=5), [], "Director"),
        job(4, "b", 50, 60, True, MONDAY + timedelta(days=7), None, ["sql", "sql"], "Director Of X"),
        job(5, None, 70, 90, False, MONDAY + timedelta(days=7), MONDAY + timedelta(days=40), ["dbt"]),
        job(6, None, "0.01", None, True, MONDAY, MONDAY + timedelta(microseconds=1), ["java"]),
    ]
    return spark.createDataFrame(rows, JOBS).repartition(3)


def rows(frame):
    return [tuple(r) for r in frame.collect()]


def test_counts(jobs):
    assert rows(market.top_companies_all(jobs)) == [("a", 3), (None, 2), ("b", 1)]
    assert rows(market.top_companies_named(jobs, 1)) == [("a", 3)]
    assert rows(market.chart_companies(jobs)) == [("b", 1), ("a", 3)]
    assert rows(market.top_locations(jobs)) == [(None, 6)]
    assert rows(market.top_skills(jobs)) == [("sql", 4), ("java", 2), ("dbt", 1)]
    assert rows(market.chart_skills(jobs, 2)) == [("java", 2), ("sql", 4)]
    assert rows(market.remote_breakdown(jobs)) == [(None, 1, 16.67), (True, 3, 50.0), (False, 2, 33.33)]
    assert sorted(rows(market.remote_split(jobs)), key=str) == [
        (False, 2, "On-site"), (None, 1, None), (True, 3, "Remote"),
    ]
    assert rows(market.mixed_remote_companies(jobs)) == [("a", 1, 1, 3)]


def test_estimated_companies(spark, jobs):
    exact, estimated = rows(market.kpis(jobs)), rows(market.kpis(jobs, log_size=12))
    assert estimated == exact  # few companies are counted as they are
    assert rows(market.kpis(jobs.limit(0), log_size=12))[0][2] == 0
    n = 60_000
    many = spark.range(4 * n).select(F.concat(F.lit("c"), F.col("id") % n).alias("company"), (F.col("id") % 7).alias("day"))
    many = many.unionByName(spark.range(9).select(F.lit(None).cast("string").alias("company"), F.col("id").alias("day")))
    daily = market.company_sketches(many, "day", log_size=14)
    assert daily.count() == 9
    merged = market.merge_sketches(daily)
    (total, companies), = rows(merged.select("total_jobs", "unique_companies"))
    assert total == 4 * n + 9 and abs(companies - n) < 4 * 1.04 / 2**7 * n
    # Sketches of sketches, in any grouping, give what one over all rows gives.
    by_half = market.merge_sketches(daily.withColumn("half", F.col("day") % 2), "half")
    assert rows(market.merge_sketches(by_half).select("unique_companies")) == [(companies,)]
    assert rows(market.merge_sketches(daily.limit(0)).select("total_jobs", "unique_companies")) == [(0, 0)]


def test_time(jobs):
    assert rows(market.jobs_per_day(jobs)) == [
        (date(2024, 1, 8), 2), (date(2024, 1, 7), 1), (date(2024, 1, 1), 2),
    ]
    assert rows(market.weekly_volume(jobs)) == [(date(2024, 1, 8), 2), (date(2024, 1, 1), 3)]
    assert rows(market.running_total(jobs)) == [
        (date(2024, 1, 1), "Data Engineer", "a", 2),
        (date(2024, 1, 1), "data engineer", "a", 2),
        (date(2024, 1, 1), "Dev", None, 3),
        (date(2024, 1, 1), "Director", "a", 4),
        (date(2024, 2, 10), "Dev", None, 5),
    ]
    assert rows(market.skill_trend(jobs)) == [
        ("dbt", date(2024, 1, 8), 1, 50.0, None, 3),
        ("java", date(2024, 1, 1), 2, 66.67, None, 1),
        ("java", date(2024, 1, 8), 0, 0.0, -2, 2),
        ("sql", date(2024, 1, 1), 2, 66.67, None, 2),
        ("sql", date(2024, 1, 8), 2, 100.0, 0, 1),
    ]


def test_trend_over_a_gap(jobs):
    """A week without a skill, and one without any posting, count as zero."""
    gap = jobs.filter("external_id IN ('1', '2')").withColumn(
        "date_posted", F.when(F.col("external_id") == "1", F.lit("2024-01-03")).otherwise(F.lit("2024-01-17")).cast("timestamp_ntz")
    ).withColumn("skills", F.array(F.lit("sql")))
    assert rows(market.skill_trend(gap)) == [
        ("sql", date(2024, 1, 1), 1, 100.0, None, 1),
        ("sql", date(2024, 1, 8), 0, None, -1, 1),
        ("sql", date(2024, 1, 15), 1, 100.0, 1, 1),
    ]


def test_salaries(jobs):
    assert rows(market.salary_insights(jobs)) == [(D("0.01"), D("101.00"), 64.2, D("60.00"), D("200.00"), 125.25)]
    assert rows(market.salary_by_title(jobs, 2)) == [("data engineer", 2, 100.5), ("director of x", 1, 50.0)]
    assert rows(market.remote_salary(jobs)) == [(True, 3, 50.0), (False, 2, 85.5)]
    assert rows(market.director_salary(jobs)) == [(False, 4, 67.75), (True, 1, 50.0)]
    assert rows(market.salary_range_width(jobs)) == [
        ("a", "Data Engineer", D("100.00"), 75.0),
        ("a", "data engineer", D("50.00"), 75.0),
        (None, "Dev", D("20.00"), 20.0),
        ("b", "Director Of X", D("10.00"), 10.0),
    ]


def test_company_skills_counts_postings_without_skills(jobs):
    # b has one posting only, and a posting without skills counts for a.
    assert rows(market.company_skills(jobs)) == [("a", "sql", 2), ("a", "java", 1)]
    two = jobs.filter("external_id IN ('2', '3')")
    assert rows(market.company_skills(two)) == [("a", "sql", 1)]
    bare = two.withColumn("skills", F.when(F.col("external_id") == "2", F.col("skills")))
    assert rows(market.company_skills(bare)) == [("a", "sql", 1)]


def test_key_figures(jobs):
    last = MONDAY + timedelta(days=40)
    assert rows(market.ingestion_summary(jobs)) == [(6, last)]
    assert rows(market.kpis(jobs)) == [(6, last, 2, 50.0, 64.2)]
    assert rows(market.kpi_labels(jobs)) == [("6", "2024-02-10 00:00", "2", "50.0%", "$64")]
    none = jobs.limit(0)
    assert rows(market.kpis(none)) == [(0, None, 0, None, None)]
    assert rows(market.kpi_labels(none)) == [("0", "N/A", "0", "N/A", "N/A")]
    assert rows(market.salary_insights(none)) == [(None,) * 6]
    assert rows(market.running_total(none)) == rows(market.company_skills(none)) == []


def test_salary_label_rounds_half_to_even(spark):
    for low, want in (("1234.50", "$1,234"), ("1235.50", "$1,236"), ("2000000.49", "$2,000,000")):
        one = spark.createDataFrame([job(1, low=low)], JOBS)
        assert market.kpi_labels(one).first().avg_salary == want


def test_latest_and_search(jobs):
    latest = rows(market.latest_postings(jobs, 3))
    assert [r[0] for r in latest] == ["Director Of X", "Dev", "Director"]  # no fetch time comes first
    assert [r[0] for r in rows(market.title_search(jobs, "^dir.*r$", 3))] == ["Director"]
    assert rows(market.title_search(jobs, "", 3)) == latest
    assert rows(market.title_search(jobs, "data", 3)) == []  # the search is within the latest
    untitled = jobs.withColumn("title", F.lit(None).cast("string"))
    assert rows(market.title_search(untitled, ".*", 3)) == []


ALL = [
    market.top_companies_all, market.top_companies_named, market.top_locations, market.remote_breakdown,
    market.remote_split, market.salary_insights, market.salary_by_title, market.remote_salary,
    market.director_salary, market.jobs_per_day, market.weekly_volume, market.top_skills, market.company_skills,
    market.skill_trend, market.salary_range_width, market.running_total, market.mixed_remote_companies,
    market.ingestion_summary, market.kpis, market.kpi_labels, market.latest_postings,
]


@pytest.fixture(scope="module")
def many(spark):
    """20,000 postings; a third share company, fetch time and skill."""
    n, hot = F.col("id"), F.col("id") % 3 == 0
    columns = {
        "external_id": n.cast("string"),
        "title": F.concat(F.lit("T"), (n % 50).cast("string")),
        "company": F.when(hot, "hot").when(n % 7 != 0, F.concat(F.lit("c"), (n % 900).cast("string"))),
        "salary_min": F.when(n % 5 != 0, n / 3),
        "salary_max": F.when(n % 4 != 0, n / 2),
        "is_remote": F.when(n % 11 != 0, n % 2 == 0),
        "date_posted": F.timestamp_seconds(1_600_000_000 + n % 400 * 40_000),
        "fetched_at": F.when(hot, F.lit("2024-05-05 05:05:05")).when(
            n % 13 != 0, F.timestamp_micros(1_700_000_000_000_000 + n % 7_000 * 150_000)
        ),
        "skills": F.when(hot, F.array(F.lit("sql"))).otherwise(F.array(F.lit("java"), (n % 20).cast("string"))),
    }
    made = spark.range(20_000).select(
        *[columns.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in JOBS]
    )
    from rolecall.sources import shared_dir

    path = shared_dir(spark)
    made.repartition(4).write.parquet(path)
    return read_postings(spark, path)


@pytest.mark.parametrize("question", ALL, ids=lambda q: q.__name__)
def test_partitioning_does_not_matter(many, question):
    order = (lambda r: str(r)) if question is market.remote_split else (lambda r: 0)  # unordered
    whole = sorted(rows(question(many.repartition(1))), key=order)
    assert sorted(rows(question(many.repartition(64))), key=order) == whole
    assert whole


def test_running_total_equals_brute_force(many):
    times = sorted(r.fetched_at for r in many.select("fetched_at").collect() if r.fetched_at)
    upto = {t: i for i, t in enumerate(times, 1)}
    got = sorted(r.running_total for r in market.running_total(many).select("running_total").collect())
    assert got == sorted(upto[t] for t in times)
    assert got[-1] == len(times)


def test_percentages_add_up(many):
    assert abs(sum(r.percentage for r in market.remote_breakdown(many).collect()) - 100) < 0.02


def executed(frame):
    frame.collect()
    plan = frame._jdf.queryExecution().executedPlan().toString()
    return plan.split("== Initial Plan ==")[0]


@pytest.mark.parametrize(
    "question", [q for q in ALL if q.__name__.startswith(("top_", "salary_by", "latest"))], ids=lambda q: q.__name__
)
def test_cuts_are_top_k(many, question):
    plan = executed(question(many))
    assert "TakeOrderedAndProject" in plan and "rangepartitioning" not in plan


@pytest.mark.parametrize("question", ALL, ids=lambda q: q.__name__)
def test_no_python_workers(many, question):
    assert "EvalPython" not in executed(question(many))


def test_scan_is_pruned_and_filtered(many):
    plan = market.salary_by_title(many)._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(salary_min)]" in plan
    assert "ReadSchema: struct<title:string,salary_min:decimal(10,2)>" in plan


def test_running_total_scans_twice_and_sums_in_slices(many):
    plan = executed(market.running_total(many))
    assert plan.count("FileScan") == 2
    # Only the days, counted before, meet in one task.
    single = plan.split("Exchange SinglePartition")
    assert len(single) == 2 and "keys=[_day#" in single[1].split("\n")[1]


@pytest.mark.parametrize("question", [market.salary_range_width, market.running_total], ids=lambda q: q.__name__)
def test_hot_group_is_split_over_tasks(spark, many, question):
    conf = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20k",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "40k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    }
    want = rows(question(many))
    for key, value in conf.items():
        spark.conf.set(key, value)
    try:
        frame = question(many.repartition(32))
        assert "SortMergeJoin(skew=true)" in executed(frame)
        assert rows(frame) == want
    finally:
        for key in conf:
            spark.conf.unset(key)
