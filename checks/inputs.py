"""Posting data derived from the supplied tables.

The tables hold no job postings, so these views derive them from `orders`, `customer` and
`nation` by key arithmetic. Every order takes part. The SQL here is portable: Spark runs
it over DataFrames, the oracle over its views of the same tables.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from rolecall.operators import clean_postings, split_failures
from rolecall.schemas import JOBS, PAGE

# One dirty posting per order.
RAW = """
SELECT o_orderkey AS order_no,
  CASE WHEN o_orderkey % 97 = 5 THEN '' ELSE CAST(o_orderkey AS STRING) END AS external_id,
  CASE WHEN o_orderkey % 61 = 4 THEN NULL ELSE concat('  ',
    CASE o_custkey % 4 WHEN 0 THEN 'senior ' WHEN 1 THEN 'lead ' WHEN 2 THEN 'director of ' ELSE '' END,
    CASE substr(o_orderpriority, 1, 1) WHEN '1' THEN 'data engineer' WHEN '2' THEN 'analytics engineer'
      WHEN '3' THEN CASE WHEN o_orderkey % 2 = 0 THEN 'ingénieur de données' ELSE 'data analyst' END WHEN '4' THEN 'machine-learning engineer' ELSE 'dev''s backend engineer' END,
    CASE o_orderkey % 6 WHEN 0 THEN ' - Remote ' WHEN 1 THEN ' (remote)' WHEN 2 THEN ' - USA'
      WHEN 3 THEN ' US-' ELSE '' END) END AS title,
  CASE WHEN o_custkey % 50 = 0 THEN NULL ELSE c_name END AS company,
  CASE WHEN o_orderkey % 67 = 2 THEN NULL ELSE concat(n_name, ', ', c_mktsegment) END AS location,
  CASE WHEN o_orderkey % 101 = 7 THEN concat(n_name, ' (long)') ELSE n_name END AS country,
  CASE WHEN o_orderkey % 83 = 9 THEN '999999999999'
    ELSE CASE o_orderkey % 5 WHEN 0 THEN NULL
      WHEN 1 THEN concat('$', CAST(CAST(floor(o_totalprice) AS BIGINT) AS STRING))
      WHEN 2 THEN concat(CAST(CAST(floor(o_totalprice / 1000) AS BIGINT) AS STRING), ',000')
      WHEN 3 THEN 'negotiable'
      ELSE concat(CAST(CAST(floor(o_totalprice) AS BIGINT) AS STRING), '.25') END END AS salary_min,
  CASE WHEN o_orderkey % 7 = 0 THEN NULL
    ELSE CAST(CAST(floor(o_totalprice) AS BIGINT) + 10000 AS STRING) END AS salary_max,
  CASE WHEN o_orderkey % 11 = 0 THEN NULL ELSE concat('Need ',
    CASE o_orderkey % 9 WHEN 0 THEN 'Python' WHEN 1 THEN 'SQL' WHEN 2 THEN 'PySpark' WHEN 3 THEN 'kafka'
      WHEN 4 THEN 'Power BI' WHEN 5 THEN 'JavaScript' WHEN 6 THEN 'PostgreSQL' WHEN 7 THEN 'dbt' ELSE 'AWS' END, ', ',
    CASE (o_orderkey * 7 + o_custkey) % 10 WHEN 0 THEN 'python' WHEN 1 THEN 'Airflow' WHEN 2 THEN 'Azure'
      WHEN 3 THEN 'Scala' WHEN 4 THEN 'Docker' WHEN 5 THEN 'Kubernetes' WHEN 6 THEN 'MySQL' WHEN 7 THEN 'Java'
      WHEN 8 THEN 'sql_x' ELSE 'Terraform' END, ' and ',
    CASE o_custkey % 8 WHEN 0 THEN 'GCP' WHEN 1 THEN 'Snowflake' WHEN 2 THEN 'pandas' WHEN 3 THEN 'Tableau'
      WHEN 4 THEN 'Redshift' WHEN 5 THEN 'BigQuery' WHEN 6 THEN 'Databricks' ELSE 'Spark' END, '.',
    CASE o_orderkey % 13 WHEN 0 THEN ' Work From Home ok.' WHEN 1 THEN ' Not remotely dull.'
      ELSE ' On-site.' END) END AS description,
  concat('https://jobs.example/', CAST(o_orderkey AS STRING)) AS url,
  CASE WHEN o_orderkey % 89 = 3 THEN 'not a date' WHEN o_orderkey % 17 = 0 THEN NULL
    ELSE concat(CAST(CAST(o_orderdate AS DATE) AS STRING),
      CASE o_orderkey % 13 WHEN 4 THEN 'T08:30:00+02:00' WHEN 5 THEN 'T20:30:00-0500' ELSE 'T08:30:00Z' END) END AS date_posted,
  CASE WHEN o_orderkey % 211 = 1 THEN NULL
    ELSE o_orderdate + INTERVAL '1' HOUR * CAST(o_orderkey % 24 AS INT) END AS fetched_at
FROM {orders} JOIN {customer} ON o_custkey = c_custkey JOIN {nation} ON c_nationkey = n_nationkey
"""

# The postings as search results of two days: 300 orders make up a run, so runs grow in
# number, not in size. Of five runs one has a short page, one an empty page (its page 2
# lists nothing) and, at times, one a page that failed. Of twelve, one has good postings only
# and one has none with an id. The second day changes some postings and renames some ids.
ITEMS = """
SELECT day, concat('run-', CAST(day AS STRING), '-', CAST(g AS STRING)) AS run_id,
  concat('term ', CAST(day AS STRING), '-', CAST(g AS STRING)) AS keyword, CAST(page AS INT) AS page,
  CAST(row_number() OVER (PARTITION BY day, g, page ORDER BY pos) - 1 AS INT) AS pos,
  CAST(CASE WHEN g % 3 = 0 THEN NULL ELSE 120 + g % 7 * 20 END AS BIGINT) AS total,
  CASE WHEN g % 20 = 19 AND page = 4 THEN 'HTTP 503' ELSE NULL END AS error,
  CAST('2024-01-01 00:00:00' AS {ntz}) + INTERVAL '1' DAY * day
    + INTERVAL '1' MINUTE * CAST(g % 1440 AS INT) + INTERVAL '1' SECOND * CAST(page AS INT) AS landed_at,
  CASE WHEN order_no % 37 = 0 OR g % 12 = 6 THEN NULL
    WHEN order_no % 10 = 0 THEN CAST(order_no - 7 AS STRING)
    WHEN day = 2 AND order_no % 9 = 4 THEN concat(external_id, '-b')
    ELSE external_id END AS id,
  CASE WHEN day = 2 AND order_no % 4 = 1 THEN 'chief ' || trim(title) ELSE title END AS title,
  company, location, country, salary_min, salary_max,
  CASE WHEN day = 2 AND order_no % 8 = 2 THEN NULL ELSE description END AS description,
  url, date_posted, g % 5 = 2 AS gap
FROM (
  SELECT *,
    CASE WHEN g % 5 = 1 THEN CASE WHEN x < 50 THEN 1 WHEN x < 80 THEN 2 ELSE 3 + floor((x - 80) / 50) END
      WHEN g % 5 = 2 AND x >= 50 THEN 2 + floor(x / 50)
      ELSE 1 + floor(x / 50) END AS page,
    CASE WHEN g % 5 = 1 AND x >= 80 THEN (x - 80) % 50 ELSE x % 50 END AS pos
  FROM (
    SELECT *, CAST(floor(order_no / 300) AS BIGINT) AS g, order_no % 300 AS x
    FROM (SELECT *, {each_day} AS day FROM {raw}) daily
  ) numbered
) placed
WHERE NOT (g % 12 = 4 AND (order_no % 97 = 5 OR order_no % 101 = 7 OR order_no % 83 = 9 OR order_no % 89 = 3
  OR order_no % 37 = 0))
"""

# A watch list of its own: searches of both days, and two that nobody runs. `ran` says which.
WATCHLIST = """
SELECT DISTINCT concat('term ', CAST(day AS STRING), '-', CAST(g AS STRING)) AS keyword, g % 20 <> 19 AS ran
FROM (SELECT CAST(floor(order_no / 300) AS BIGINT) AS g, 1 + order_no % 2 AS day FROM {raw}) searches
WHERE g % 20 = 0 OR g % 20 = 19
UNION ALL SELECT 'never one', false UNION ALL SELECT 'never two', false
"""

# A batch over the stored postings: new ids, changed and unchanged content, every posting
# a second time, and one id that a third of that second pass shares.
INCOMING = """
SELECT CASE WHEN order_no % 3 = 0 THEN concat('new-', external_id) ELSE external_id END AS external_id,
  CASE WHEN order_no % 4 = 0 THEN NULL ELSE title END AS title, company, location, country,
  salary_min, salary_max, is_remote, description, url, date_posted,
  fetched_at + INTERVAL '1' DAY AS fetched_at, skills, order_no AS arrival
FROM {jobs}
UNION ALL
SELECT CASE WHEN order_no % 3 = 1 THEN 'hot' ELSE external_id END, title, company, location, country,
  salary_min, salary_max, is_remote, description, url, date_posted,
  fetched_at + INTERVAL '2' DAY, CASE WHEN order_no % 8 = 0 THEN {reverse}(skills) ELSE skills END,
  1099511627776 + order_no
FROM {jobs}
"""

TERMS = "SELECT concat('  ', upper(p_name), '   X ') AS keyword FROM {part}"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(rows: DataFrame, key: str, least: int = 10_000, most: int = 10_000_000) -> DataFrame:
    """Rows of a small file, dealt over all cores: its one row group would be one task.

    A larger file has row groups enough, and is read as it lies.
    """
    small = least < rows.count() < most
    return rows.repartition(rows.sparkSession.sparkContext.defaultParallelism, key) if small else rows


def raw_postings(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = {n: table(spark, sf_dir, n) for n in ("orders", "customer", "nation")}
    tables["orders"] = spread(tables["orders"], "o_orderkey")
    return spark.sql(RAW, **tables)


def jobs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The posting table; some flags are not known."""
    rows = split_failures(clean_postings(raw_postings(spark, sf_dir)))[0]
    known = F.when(F.col("order_no") % 59 != 0, F.col("is_remote"))
    return rows.withColumn("is_remote", known).select(*JOBS.names)


def incoming(spark: SparkSession, stored: DataFrame) -> DataFrame:
    """The batch for stored postings, whose ids are their order numbers."""
    sql = INCOMING.replace("{reverse}", "reverse")
    return spark.sql(sql, jobs=stored.withColumn("order_no", F.col("external_id").cast("long")))


def landed_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Search pages of both days in the landing schema, and `day`."""
    sql = ITEMS.replace("{ntz}", "TIMESTAMP_NTZ").replace("{each_day}", "explode(array(1, 2))")
    # Postings are put together by run once, not for each day.
    raw = raw_postings(spark, sf_dir).repartition(F.expr("CAST(floor(order_no / 300) AS BIGINT)"))
    items = spark.sql(sql, raw=raw)
    posting = F.struct(
        "id", "title",
        F.struct(F.col("company").alias("display_name")).alias("company"),
        F.struct(
            F.col("location").alias("display_name"), F.array("country").alias("area")
        ).alias("location"),
        "salary_min", "salary_max", "description",
        F.col("url").alias("redirect_url"),
        F.col("date_posted").alias("created"),
    )
    page = ("day", "run_id", "keyword", "page", "total", "landed_at", "error")
    # A page has at most 50 results.
    results = F.array_sort(F.collect_list(F.struct("pos", posting.alias("posting"))))["posting"]
    pages = items.groupBy(*page).agg(
        F.when(F.col("error").isNull(), results).alias("results")
    )
    empty = (
        items.filter("gap AND page = 1")
        .select(*page)
        .distinct()
        .withColumn("page", F.lit(2))
        .withColumn("results", F.array().cast(PAGE["results"].dataType))
    )
    both = reduce(DataFrame.unionByName, (pages, empty)).withColumnRenamed("total", "count")
    return both.select("day", *PAGE.names)
