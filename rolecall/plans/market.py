"""The fixed market questions, one function each over the posting table.

NULLs sort as greatest, and every cut-off has a unique last sort column, so results do not
depend on the partitioning.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from rolecall.functions import avg_money, percentage, posted_day, posted_week
from rolecall.operators.chain import running_sum


def _cents(amount: Column) -> Column:
    return F.round(avg_money(amount), 2).cast("double")


def _top(jobs: DataFrame, column: str, name: str, n: int) -> DataFrame:
    counts = jobs.groupBy(column).agg(F.count("*").alias(name))
    return counts.orderBy(F.desc(name), F.asc_nulls_last(column)).limit(n)


def top_companies_all(jobs: DataFrame, n: int = 10) -> DataFrame:
    """Companies with most postings; postings without company count as one of them."""
    return _top(jobs, "company", "job_count", n)


def top_companies_named(jobs: DataFrame, n: int = 10) -> DataFrame:
    """Named companies with most postings."""
    return _top(jobs.filter("company IS NOT NULL"), "company", "count", n)


def top_locations(jobs: DataFrame, n: int = 10) -> DataFrame:
    """Locations with most postings, the missing location included."""
    return _top(jobs, "location", "job_count", n)


def remote_breakdown(jobs: DataFrame) -> DataFrame:
    """Postings and share per remote flag."""
    counts = jobs.groupBy("is_remote").agg(F.count("*").alias("job_count"))
    # At most three rows reach this window.
    total = F.sum("job_count").over(Window.partitionBy())
    share = percentage(F.col("job_count"), total, 2).cast("double")
    return counts.withColumn("percentage", share).orderBy(F.desc_nulls_first("is_remote"))


def remote_split(jobs: DataFrame) -> DataFrame:
    """Postings per remote flag with a label; an unknown flag has none."""
    label = F.when(F.col("is_remote"), "Remote").when(~F.col("is_remote"), "On-site")
    return jobs.groupBy("is_remote").agg(F.count("*").alias("count")).withColumn("label", label)


def salary_insights(jobs: DataFrame) -> DataFrame:
    """Lowest, highest and mean salary bounds of the postings that state a lower bound."""
    return jobs.filter("salary_min IS NOT NULL").agg(
        *[
            expr.alias(f"{name}_{c}")
            for c in ("salary_min", "salary_max")
            for name, expr in (("min", F.min(c)), ("max", F.max(c)), ("avg", _cents(F.col(c))))
        ]
    )


def salary_by_title(jobs: DataFrame, n: int = 10) -> DataFrame:
    """Best paid titles, letter case aside."""
    return (
        jobs.filter("salary_min IS NOT NULL")
        .groupBy(F.lower("title").alias("title"))
        .agg(F.count("*").alias("posting_count"), _cents(F.col("salary_min")).alias("avg_salary_min"))
        .orderBy(F.desc("avg_salary_min"), F.asc_nulls_last("title"))
        .limit(n)
    )


def remote_salary(jobs: DataFrame) -> DataFrame:
    """Postings and mean salary per remote flag."""
    return (
        jobs.filter("salary_min IS NOT NULL")
        .groupBy("is_remote")
        .agg(F.count("*").alias("job_count"), _cents(F.col("salary_min")).alias("avg_salary"))
        .orderBy(F.desc_nulls_first("is_remote"))
    )


def director_salary(jobs: DataFrame) -> DataFrame:
    """Mean salary of titles that name a director, and of all others."""
    title = F.coalesce(F.lower("title"), F.lit(""))
    return (
        jobs.filter("salary_min IS NOT NULL")
        .groupBy(F.contains(title, F.lit("director")).alias("is_director"))
        .agg(F.count("*").alias("posting_count"), _cents(F.col("salary_min")).alias("avg_salary_min"))
        .orderBy("is_director")
    )


def jobs_per_day(jobs: DataFrame) -> DataFrame:
    """Postings per calendar day, newest first."""
    return (
        jobs.filter("date_posted IS NOT NULL")
        .groupBy(posted_day(F.col("date_posted")).alias("posted_date"))
        .agg(F.count("*").alias("job_count"))
        .orderBy(F.desc("posted_date"))
    )


def weekly_volume(jobs: DataFrame) -> DataFrame:
    """Postings per week from Monday, newest first."""
    return (
        jobs.filter("date_posted IS NOT NULL")
        .groupBy(posted_week(F.col("date_posted")).alias("week_start"))
        .agg(F.count("*").alias("job_count"))
        .orderBy(F.desc("week_start"))
    )


def top_skills(jobs: DataFrame, n: int = 15) -> DataFrame:
    """Skills named by most postings."""
    return _top(jobs.select(F.explode("skills").alias("skill")), "skill", "job_count", n)


def _skills_and_posting(jobs: DataFrame, *columns: Column | str) -> DataFrame:
    """One row per skill, plus one per posting (`_posting`), from a single scan."""
    skills = F.coalesce("skills", F.array().cast("array<string>"))
    return jobs.select(
        *columns,
        F.size(skills).alias("_size"),
        F.posexplode(F.array_append(skills, F.lit(None))).alias("_at", "skill"),
    ).withColumn("_posting", F.col("_at") == F.col("_size"))


def company_skills(jobs: DataFrame) -> DataFrame:
    """Skill counts of companies with more than one posting.

    Skills and postings are counted in one pre-aggregated pass. The window then sees a
    company's few counted rows, never its postings.
    """
    counts = (
        _skills_and_posting(jobs.filter("company IS NOT NULL"), "company")
        .groupBy("company", "_posting", "skill")
        .agg(F.count("*").alias("skill_count"))
    )
    postings = F.max(F.when(F.col("_posting"), F.col("skill_count")))
    return (
        counts.withColumn("_postings", postings.over(Window.partitionBy("company")))
        .filter(~F.col("_posting") & (F.col("_postings") > 1))
        .select("company", "skill", "skill_count")
        .orderBy("company", F.desc("skill_count"), F.asc_nulls_last("skill"))
    )


def skill_trend(jobs: DataFrame) -> DataFrame:
    """Postings per skill and week, share of that week's postings, change to the week before,
    and the place among the week's skills by that change, the fastest-rising first.

    A skill has every week from its first to the last of all postings, with no postings in
    some; the first has no change. Windows cover counted rows only: one per skill and week.
    """
    counts = (
        _skills_and_posting(
            jobs.filter("date_posted IS NOT NULL"),
            posted_week(F.col("date_posted")).alias("week_start"),
        )
        .groupBy("week_start", "_posting", "skill")
        .agg(F.count("*").alias("job_count"))
    )
    weeks = counts.filter("_posting").select("week_start", F.col("job_count").alias("_postings"))
    found = counts.filter(~F.col("_posting")).drop("_posting")
    last = F.broadcast(weeks.agg(F.max("week_start").alias("_last")))  # one row
    spine = found.groupBy("skill").agg(F.min("week_start").alias("_first")).join(last)
    spine = spine.select(
        "skill", F.explode(F.sequence("_first", "_last", F.expr("INTERVAL 7 DAYS"))).alias("week_start")
    )
    dense = spine.join(found, (spine["skill"].eqNullSafe(found["skill"])) & (spine["week_start"] == found["week_start"]), "left").select(
        spine["skill"], spine["week_start"], F.coalesce("job_count", F.lit(0).cast("long")).alias("job_count")
    )
    change = F.col("job_count") - F.lag("job_count").over(Window.partitionBy("skill").orderBy("week_start"))
    rise = Window.partitionBy("week_start").orderBy(F.desc_nulls_last("change"), "skill")
    return (
        dense.join(weeks, "week_start", "left")
        .select(
            "skill", "week_start", "job_count",
            percentage(F.col("job_count"), F.col("_postings"), 2).cast("double").alias("share_pct"),
            change.alias("change"),
        )
        .withColumn("rise_rank", F.row_number().over(rise).cast("long"))
        .orderBy("skill", "week_start")
    )


def salary_range_width(jobs: DataFrame) -> DataFrame:
    """Salary range of each posting beside its company's mean range, widest mean first.

    Means are aggregated and joined back, so no window holds a whole company. The mean
    side is unique per company: adaptive execution broadcasts it when it is small, and
    otherwise splits an over-large company on the posting side. `external_id` in the sort
    lets the range sort split one as well.
    """
    both = jobs.filter("salary_min IS NOT NULL AND salary_max IS NOT NULL").select(
        "external_id", "company", "title",
        (F.col("salary_max") - F.col("salary_min")).alias("salary_range"),
    )
    means = both.groupBy(F.col("company").alias("_company")).agg(
        _cents(F.col("salary_range")).alias("company_avg_range")
    )
    return (
        both.join(means, F.col("company").eqNullSafe(F.col("_company")))
        .orderBy(F.desc("company_avg_range"), F.asc_nulls_last("company"), "external_id")
        .select("company", "title", "salary_range", "company_avg_range")
    )


def running_total(jobs: DataFrame) -> DataFrame:
    """Each fetched posting with the number of postings fetched up to its time.

    Postings of the same time share the total. Counts per distinct time are summed within
    the second, seconds within the day, days overall, so no task sorts more than the
    86,400 seconds of a day, the million microseconds of a second or the days on record.
    """
    fetched = jobs.filter("fetched_at IS NOT NULL").select(
        "external_id", "fetched_at", "title", "company"
    )
    time = F.col("fetched_at")
    day = F.unix_date(F.to_date(time))
    clock = F.hour(time) * 3600 + F.minute(time) * 60 + F.second(time)
    # Known not to be NULL, the slices need no filter below the shuffle of the counts, so
    # that all levels share that one shuffle and its scan.
    slices = {
        "_day": F.coalesce(day, F.lit(0)),
        "_second": F.coalesce(day.cast("long") * 86400 + clock, F.lit(0)),
    }
    ticks = fetched.groupBy("fetched_at").agg(F.count("*").alias("_n")).withColumns(slices)
    totals = running_sum(ticks, "fetched_at", "_n", list(slices), "running_total")
    return (
        fetched.join(totals.select("fetched_at", "running_total"), "fetched_at")
        .orderBy("fetched_at", "external_id")
        .select(F.to_date("fetched_at").alias("fetched_date"), "title", "company", "running_total")
    )


def mixed_remote_companies(jobs: DataFrame) -> DataFrame:
    """Companies with both remote and on-site postings."""
    return (
        jobs.filter("company IS NOT NULL")
        .groupBy("company")
        .agg(
            F.count_if("is_remote").alias("remote_count"),
            F.count_if(~F.col("is_remote")).alias("non_remote_count"),
            F.count("*").alias("total_jobs"),
        )
        .filter("remote_count >= 1 AND non_remote_count >= 1")
        .orderBy(F.desc("total_jobs"), "company")
    )


def ingestion_summary(jobs: DataFrame) -> DataFrame:
    """Number of postings and time of the last fetch."""
    return jobs.agg(F.count("*").alias("total"), F.max("fetched_at").alias("last_fetched"))


def company_sketches(jobs: DataFrame, *by: str, log_size: int = 12) -> DataFrame:
    """Per group of `by` (or for all rows): `total_jobs` and `companies`, a mergeable sketch.

    A sketch has 2^`log_size` places at most, whatever the number of companies, and a standard
    error of about 1.04 / 2^(`log_size` / 2). Kept per day or per bucket, only the groups that
    changed need a new one.
    """
    sketch = F.hll_sketch_agg("company", F.lit(log_size))
    return jobs.groupBy(*by).agg(F.count("*").alias("total_jobs"), sketch.alias("companies"))


def merge_sketches(sketches: DataFrame, *by: str) -> DataFrame:
    """Sketches of `company_sketches` brought together by fewer columns, with their estimate.

    Sketches of different sizes merge to the smallest; no sketches give no companies.
    """
    merged = F.hll_union_agg("companies", F.lit(True))
    rows = sketches.groupBy(*by).agg(
        F.coalesce(F.sum("total_jobs"), F.lit(0)).alias("total_jobs"), merged.alias("companies")
    )
    estimate = F.coalesce(F.hll_sketch_estimate("companies"), F.lit(0))
    return rows.withColumn("unique_companies", estimate)


def _key_figures(jobs: DataFrame, log_size: int | None = None) -> DataFrame:
    companies = F.count_distinct("company")
    if log_size is not None:
        companies = F.hll_sketch_estimate(F.hll_sketch_agg("company", F.lit(log_size)))
    return jobs.agg(
        F.count("*").alias("total_jobs"),
        F.max("fetched_at").alias("last_updated"),
        companies.alias("unique_companies"),
        percentage(F.count_if("is_remote"), F.count("*"), 1).alias("remote_pct"),
        avg_money(F.col("salary_min")).alias("avg_salary"),
    )


def kpis(jobs: DataFrame, log_size: int | None = None) -> DataFrame:
    """Key figures; the remote share is NULL for an empty table.

    With `log_size`, companies are estimated (see `company_sketches`) and not shuffled.
    """
    return (
        _key_figures(jobs, log_size)
        .withColumn("remote_pct", F.col("remote_pct").cast("double"))
        .withColumn("avg_salary", F.round("avg_salary", 2).cast("double"))
    )


def kpi_labels(jobs: DataFrame) -> DataFrame:
    """Key figures as display texts."""
    missing = F.lit("N/A")
    share = F.col("remote_pct").cast("decimal(10,1)").cast("string")
    return _key_figures(jobs).select(
        F.format_number("total_jobs", 0).alias("total_jobs"),
        F.coalesce(F.substring(F.col("last_updated").cast("string"), 1, 16), missing).alias(
            "last_updated"
        ),
        F.format_number("unique_companies", 0).alias("unique_companies"),
        F.coalesce(F.concat(share, F.lit("%")), missing).alias("remote_pct"),
        F.coalesce(F.concat(F.lit("$"), F.format_number("avg_salary", 0)), missing).alias(
            "avg_salary"
        ),
    )


def latest_postings(jobs: DataFrame, n: int = 100) -> DataFrame:
    """The postings fetched last; one without fetch time comes first."""
    return (
        jobs.orderBy(F.desc_nulls_first("fetched_at"), "external_id")
        .limit(n)
        .select("title", "company", "location", "is_remote", "salary_min", "date_posted")
    )


def title_search(jobs: DataFrame, pattern: str, n: int = 100) -> DataFrame:
    """Latest postings whose title matches a regular expression, letter case aside."""
    latest = latest_postings(jobs, n)
    return latest.filter(F.rlike("title", F.lit("(?iu)" + pattern))) if pattern else latest


def chart_skills(jobs: DataFrame, n: int = 15) -> DataFrame:
    """Top skills from the smallest count up, as a bar chart stacks them."""
    return top_skills(jobs, n).orderBy("job_count", F.desc("skill"))


def chart_companies(jobs: DataFrame, n: int = 10) -> DataFrame:
    """Top named companies from the smallest count up."""
    return top_companies_named(jobs, n).orderBy("count", F.desc("company"))
