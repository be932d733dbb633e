"""One registered query per operator, each over the whole supplied tables."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from checks import inputs
from rolecall import functions as fn
from rolecall.operators import (
    add_terms,
    assemble_runs,
    batch_gates,
    clean_postings,
    flatten_postings,
    list_terms,
    open_runs,
    quarantine_counts,
    remove_terms,
    run_manifest,
    schema_report,
    seed_terms,
)
from rolecall.operators.chain import integer_levels
from rolecall.operators.upsert import classify
from rolecall.plans import market
from rolecall.plans.ingest import ingest, upsert_into
from rolecall.schemas import MAX_PAGES, RESULTS_PER_PAGE
from rolecall.sources import PostingStore, read_pages, read_postings, shared_dir, shuffles_released
from rolecall.streaming import ingest_landed

Query = Callable[[SparkSession, str], DataFrame]

# For many small files. Each task puts its files in place, not the driver one after the other;
# and a local file has no checksum file, as Spark starts a process for each file it makes.
MANY_FILES = {
    "mapreduce.fileoutputcommitter.algorithm.version": "2",
    "fs.file.impl": "org.apache.hadoop.fs.RawLocalFileSystem",
    "fs.file.impl.disable.cache": "true",
}
WATCHED_SINCE = datetime(2024, 1, 1)


def comparable(rows: DataFrame) -> DataFrame:
    """Decimals as double, times as text and arrays as one text, for any engine's hash."""

    def plain(field: T.StructField):
        column = F.col(field.name)
        if isinstance(field.dataType, T.DecimalType):
            return column.cast("double").alias(field.name)
        if isinstance(field.dataType, (T.DateType, T.TimestampNTZType)):
            return column.cast("string").alias(field.name)
        if isinstance(field.dataType, T.ArrayType):
            return F.array_join(column, "|").alias(field.name)
        return column

    return rows.select(*[plain(f) for f in rows.schema])


def _over_jobs(question: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: comparable(question(inputs.jobs(spark, sf_dir)))


def _over_raw(**columns: Callable[[Column], Column]) -> Query:
    """Order number and, by name, columns computed from the raw column of that name."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        made = [make(F.col(name)).alias(name) for name, make in columns.items()]
        return comparable(inputs.raw_postings(spark, sf_dir).select("order_no", *made))

    return query


def detect_remote(spark: SparkSession, sf_dir: str) -> DataFrame:
    flag = fn.detect_remote(F.col("title"), F.col("description"))
    return inputs.raw_postings(spark, sf_dir).select("order_no", flag.alias("is_remote"))


def extract_skills(spark: SparkSession, sf_dir: str) -> DataFrame:
    skills = fn.extract_skills(F.col("description"))
    return comparable(
        inputs.raw_postings(spark, sf_dir).select("order_no", skills.alias("skills"))
    )


def _land(pages: DataFrame, path: str) -> None:
    with shuffles_released(pages.sparkSession):
        pages.write.option("compression", "gzip").json(path)


def flatten_posting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landed page files, read back and flattened without any paging rule."""
    path = shared_dir(spark)
    _land(inputs.landed_pages(spark, sf_dir).drop("day"), path)
    rows = read_pages(spark, path).select(
        "run_id", "page", "landed_at", F.posexplode("results").alias("position", "posting")
    )
    return comparable(flatten_postings(rows))


def page_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The runs of all landed pages."""
    rows = assemble_runs(inputs.landed_pages(spark, sf_dir))
    return rows.select("run_id", "keyword", "page", "position", F.col("posting.id").alias("id"))


def cleaned(spark: SparkSession, sf_dir: str) -> DataFrame:
    return comparable(clean_postings(inputs.raw_postings(spark, sf_dir)))


def quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quarantine_counts(clean_postings(inputs.raw_postings(spark, sf_dir)))


def postings_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_dir(spark)
    inputs.jobs(spark, sf_dir).write.parquet(path)
    return comparable(read_postings(spark, path))


def _upsert(spark: SparkSession, sf_dir: str) -> tuple[PostingStore, DataFrame]:
    """Store holding the postings, and a batch staged for it. Derived once, then read."""
    store = PostingStore(spark, shared_dir(spark), buckets=8)
    store.commit(inputs.jobs(spark, sf_dir), "first", range(store.buckets))
    coarse, fine = integer_levels(F.col("arrival"))
    batch = inputs.incoming(spark, store.read())
    batch = batch.withColumns({"_slice": coarse, "_arrival": fine})
    return store, store.stage(batch)


SLICED = [["_slice"], ["_arrival"]]


def upsert_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    store, staged = _upsert(spark, sf_dir)
    upsert_into(store, staged, SLICED, "second")
    return comparable(store.read())


def upsert_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    store, staged = _upsert(spark, sf_dir)
    return classify(staged, store.digests(), SLICED).select("external_id", "arrival", "outcome")


def _ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ledger after one batch with both days' runs, put into an empty store, while a batch
    with the second day's searches is at work."""
    root = shared_dir(spark)
    _land(inputs.landed_pages(spark, sf_dir).drop("day"), f"{root}/pages")
    store = PostingStore(spark, f"{root}/store", buckets=8)
    pages = read_pages(spark, f"{root}/pages")
    ingest(store, pages, "both days")
    again = run_manifest(pages.filter("run_id LIKE 'run-2-%'")).withColumn("run_id", F.concat(F.lit("next-"), "run_id"))
    store.begin("third day", open_runs(again))
    return store.ledger()


def run_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    return comparable(_ledger(spark, sf_dir))


def run_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _ledger(spark, sf_dir).groupBy("status", "errored").agg(F.count("*").alias("runs"))


def gates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Checks over the batch under different demands; the watch list is not the ledger's."""
    ledger = _ledger(spark, sf_dir)
    watched = spark.sql(inputs.WATCHLIST, raw=inputs.raw_postings(spark, sf_dir))
    cases = {
        "all": (watched, {}),
        "some": (watched, {"min_succeeded": 1}),
        "many inserted": (watched, {"min_succeeded": 1, "min_inserted": 10**9}),
        "ran": (watched.filter("ran"), {}),
        "none": (watched.limit(0), {}),
    }
    rows = [batch_gates(ledger, terms, **limits).withColumn("demand", F.lit(name)) for name, (terms, limits) in cases.items()]
    return reduce(DataFrame.unionByName, rows)


def stream_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both days' pages, one in a file of its own, through the stream into a store."""
    root = shared_dir(spark)
    store = PostingStore(spark, f"{root}/store", buckets=8)
    _land(inputs.landed_pages(spark, sf_dir), f"{root}/pages")  # unordered copy, derived once for both days
    landed = read_pages(spark, f"{root}/pages").withColumn("day", F.dayofmonth("landed_at") - 1)
    for day in (1, 2):
        one = landed.filter(F.col("day") == day).drop("day", "bad_line")
        one.write.mode("append").options(**MANY_FILES).option("maxRecordsPerFile", 1).json(f"{root}/landing")
        ingest_landed(spark, f"{root}/landing", store, f"{root}/checkpoint", files_per_batch=500)
    return comparable(store.read())


def _watched(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = spark.sql(inputs.TERMS, part=inputs.table(spark, sf_dir, "part"))
    empty = seed_terms(spark, None, WATCHED_SINCE).limit(0)
    return add_terms(empty, names, WATCHED_SINCE)[0]


def watch_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    return list_terms(_watched(spark, sf_dir))


def watch_add(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Seeding a list twice adds the starting terms once."""
    once = seed_terms(spark, _watched(spark, sf_dir), WATCHED_SINCE)
    return list_terms(seed_terms(spark, once, WATCHED_SINCE))


def watch_remove(spark: SparkSession, sf_dir: str) -> DataFrame:
    gone = (
        inputs.table(spark, sf_dir, "part")
        .filter("p_name LIKE 'blue%'")
        .select(F.concat("p_name", F.lit(" X")).alias("keyword"))
    )
    return list_terms(remove_terms(_watched(spark, sf_dir), gone)[0])


# Questions to the posting table.
STORED: dict[str, Callable[[DataFrame], DataFrame]] = {
    "schema_report": schema_report,
    "ingestion_summary": market.ingestion_summary,
    "top_companies_all": market.top_companies_all,
    "remote_breakdown": market.remote_breakdown,
    "salary_insights": market.salary_insights,
    "top_locations": market.top_locations,
    "jobs_per_day": market.jobs_per_day,
    "top_skills": market.top_skills,
    "salary_by_title": market.salary_by_title,
    "remote_salary": market.remote_salary,
    "company_skills": market.company_skills,
    "weekly_volume": market.weekly_volume,
    "salary_range_width": market.salary_range_width,
    "running_total": market.running_total,
    "mixed_remote_companies": market.mixed_remote_companies,
    "kpis": market.kpis,
    "kpi_labels": market.kpi_labels,
    "remote_split": market.remote_split,
    "top_companies_named": market.top_companies_named,
    "latest_postings": market.latest_postings,
    "title_search": lambda jobs: market.title_search(jobs, "eng.*r$"),
    "chart_skills": market.chart_skills,
    "chart_companies": market.chart_companies,
    "skill_trend": market.skill_trend,
    "director_salary": market.director_salary,
}

QUERIES: dict[str, Query] = {
    # preparation
    "flatten_posting": flatten_posting,
    "page_runs": page_runs,
    "normalize_title": _over_raw(title=fn.normalize_title),
    "normalize_salary": _over_raw(salary_min=fn.normalize_salary, salary_max=fn.normalize_salary),
    "detect_remote": detect_remote,
    "extract_skills": extract_skills,
    "parse_posted": _over_raw(date_posted=fn.parse_posted),
    "clean_postings": cleaned,
    "quarantine_counts": quarantine,
    # table, upsert, runs
    "postings_scan": postings_scan,
    "upsert_outcomes": upsert_outcomes,
    "upsert_state": upsert_state,
    "stream_upsert": stream_upsert,
    "run_ledger": run_ledger,
    "run_status": run_status,
    "batch_gates": gates,
    "watch_list": watch_list,
    "watch_add": watch_add,
    "watch_remove": watch_remove,
    # questions
    **{key: _over_jobs(question) for key, question in STORED.items()},
}
