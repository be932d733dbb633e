"""Table schemas and the fixed word lists of the posting pipeline."""

from __future__ import annotations

from pyspark.sql import types as T

POSTING = T.StructType(
    [
        T.StructField("id", T.StringType()),
        T.StructField("title", T.StringType()),
        T.StructField("company", T.StructType([T.StructField("display_name", T.StringType())])),
        T.StructField(
            "location",
            T.StructType(
                [
                    T.StructField("display_name", T.StringType()),
                    T.StructField("area", T.ArrayType(T.StringType())),
                ]
            ),
        ),
        # Numbers and texts both occur; a string column keeps either one as written.
        T.StructField("salary_min", T.StringType()),
        T.StructField("salary_max", T.StringType()),
        T.StructField("description", T.StringType()),
        T.StructField("redirect_url", T.StringType()),
        T.StructField("created", T.StringType()),
    ]
)

# One landed search-result page. `error` is set instead of `results` when the fetch
# of that page failed for good; such a run persists nothing.
PAGE = T.StructType(
    [
        T.StructField("run_id", T.StringType()),
        T.StructField("keyword", T.StringType()),
        T.StructField("page", T.IntegerType()),
        T.StructField("count", T.LongType()),
        T.StructField("landed_at", T.TimestampNTZType()),
        T.StructField("error", T.StringType()),
        T.StructField("results", T.ArrayType(POSTING)),
    ]
)

# The same as text: landing times may come with a zone. A line that does not parse is kept
# whole in `bad_line`.
LANDED_PAGE = T.StructType(
    [
        *[T.StructField(f.name, T.StringType()) if f.name == "landed_at" else f for f in PAGE],
        T.StructField("bad_line", T.StringType()),
    ]
)

MONEY = T.DecimalType(10, 2)
# The least amount that rounds to more than the column holds.
MONEY_LIMIT = 99_999_999.995

JOBS = T.StructType(
    [
        T.StructField("external_id", T.StringType(), False),
        T.StructField("title", T.StringType()),
        T.StructField("company", T.StringType()),
        T.StructField("location", T.StringType()),
        T.StructField("country", T.StringType()),
        T.StructField("salary_min", MONEY),
        T.StructField("salary_max", MONEY),
        T.StructField("is_remote", T.BooleanType()),
        T.StructField("description", T.StringType()),
        T.StructField("url", T.StringType()),
        T.StructField("date_posted", T.TimestampNTZType()),
        T.StructField("fetched_at", T.TimestampNTZType()),
        T.StructField("skills", T.ArrayType(T.StringType())),
    ]
)

RUNS = T.StructType(
    [
        T.StructField("run_id", T.StringType(), False),
        T.StructField("keyword", T.StringType(), False),
        T.StructField("fetched_count", T.LongType(), False),
        T.StructField("inserted_count", T.LongType(), False),
        T.StructField("updated_count", T.LongType(), False),
        T.StructField("skipped_count", T.LongType(), False),
        T.StructField("failed_count", T.LongType(), False),
        T.StructField("status", T.StringType(), False),
        T.StructField("started_at", T.TimestampNTZType(), False),
        T.StructField("completed_at", T.TimestampNTZType()),
        T.StructField("errored", T.BooleanType(), False),
        T.StructField("dropped_count", T.LongType(), False),
    ]
)

WATCHED = T.StructType(
    [
        T.StructField("keyword", T.StringType(), False),
        T.StructField("created_at", T.TimestampNTZType(), False),
    ]
)

# Longest text each column may hold, in characters.
MAX_LENGTH = {
    "external_id": 100,
    "title": 255,
    "company": 255,
    "location": 255,
    "country": 10,
}

# Fixed value: the longest search term, in characters.
MAX_KEYWORD = 255

# An upsert rewrites a stored posting when any of these differs.
COMPARED = (
    "title", "company", "location", "country", "salary_min", "salary_max",
    "is_remote", "description", "url", "date_posted", "skills",
)

# Skill terms, in the order in which a posting lists them.
SKILLS = (
    "python", "sql", "spark", "kafka", "airflow", "aws", "gcp", "azure",
    "docker", "kubernetes", "postgresql", "mysql", "snowflake", "dbt",
    "pandas", "pyspark", "tableau", "power bi", "scala", "java",
    "javascript", "terraform", "redshift", "bigquery", "databricks",
)

# Phrases that mark a posting as remote.
REMOTE_KEYWORDS = (
    "remote", "work from home", "wfh", "fully distributed", "anywhere in the us",
)

# Title endings to remove, in this order and once each.
TITLE_NOISE = (
    r"\s*-\s*Remote\s*$", r"\s*\(Remote\)\s*$", r"\s*US-\s*$", r"\s*-\s*USA\s*$",
)

# Currency signs and separators ignored in a salary text.
SALARY_SIGNS = "$£€¥,"

# Search terms a new watch list starts with.
SEED_TERMS = (
    "data engineer", "data analyst", "machine learning engineer", "backend engineer",
)

# The paging rule of a search run.
RESULTS_PER_PAGE = 50
MAX_PAGES = 5
