"""The registered queries in DuckDB SQL, written independently of the Spark code."""

from __future__ import annotations

from checks.inputs import INCOMING, ITEMS, RAW, TERMS, WATCHLIST
from rolecall.schemas import COMPARED, JOBS, MAX_LENGTH, REMOTE_KEYWORDS, SKILLS, TITLE_NOISE

_BASE = {n: n for n in ("orders", "customer", "nation", "part")}


def _fill(sql: str, **names: str) -> str:
    for name, text in {**_BASE, **names}.items():
        sql = sql.replace("{" + name + "}", text)
    return sql


def _title(column: str) -> str:
    bare = f"regexp_replace(coalesce({column}, ''), '^\\s+|\\s+$', '', 'g')"
    for end in TITLE_NOISE:
        bare = f"regexp_replace({bare}, '{end}', '', 'i')"
    runs = f"regexp_extract_all(trim({bare}), '\\p{{L}}+|\\P{{L}}+')"
    return f"array_to_string(list_transform({runs}, lambda r: upper(r[1]) || lower(r[2:])), '')"


def _salary(column: str) -> str:
    bare = f"regexp_replace(trim({column}), '[$£€¥,]', '', 'g')"
    number = "[+-]?(\\d+\\.?\\d*|\\.\\d+)([eE][+-]?\\d+)?"
    return f"CASE WHEN regexp_full_match({bare}, '{number}') THEN TRY_CAST({bare} AS DOUBLE) END"


def _money(column: str) -> str:
    return f"CASE WHEN abs(round({column}, 2)) < 1e8 THEN CAST({column} AS DECIMAL(10,2)) END"


_REMOTE = (
    "regexp_matches(lower(coalesce(title, '') || ' ' || coalesce(description, '')), '"
    + "|".join(REMOTE_KEYWORDS) + "')"
)
_SKILLS = (
    "list_filter([" + ", ".join(f"'{s}'" for s in SKILLS)
    + "], lambda s: regexp_matches(coalesce(description, ''), '\\b' || s || '\\b', 'i'))"
)
_WALL = "CAST(replace(substr(date_posted, 1, 19), 'T', ' ') AS TIMESTAMP)"
_POSTED = (
    f"CASE WHEN date_posted LIKE '____-__-__T__:__:__Z' THEN {_WALL} "
    f"WHEN date_posted LIKE '____-__-__T__:__:__+02:00' THEN {_WALL} - INTERVAL 2 HOUR "
    f"WHEN date_posted LIKE '____-__-__T__:__:__-0500' THEN {_WALL} + INTERVAL 5 HOUR END"
)


def _cleaned(source: str, extra: str) -> str:
    """Posting columns, `failure` and `extra` over a source with raw posting columns."""
    too_long = " OR ".join(f"length({c}) > {n}" for c, n in MAX_LENGTH.items())
    return f"""
SELECT {extra}, external_id, title, company, location, country, {_money('low')} AS salary_min,
  {_money('high')} AS salary_max, is_remote, description, url, date_posted, fetched_at, skills,
  CASE WHEN external_id IS NULL OR external_id = '' THEN 'missing_id'
    WHEN created <> '' AND date_posted IS NULL THEN 'bad_date'
    WHEN abs(round(low, 2)) >= 1e8 OR abs(round(high, 2)) >= 1e8 THEN 'numeric_overflow'
    WHEN {too_long} THEN 'too_long' END AS failure
FROM (SELECT * REPLACE ({_title('title')} AS title, {_POSTED} AS date_posted),
    date_posted AS created, {_salary('salary_min')} AS low, {_salary('salary_max')} AS high,
    {_REMOTE} AS is_remote, {_SKILLS} AS skills FROM {source}) staged
"""


_JOB_COLUMNS = ", ".join(JOBS.names)
_RAW_CTE = f"raw AS ({_fill(RAW)})"
_CLEAN_CTE = f"{_RAW_CTE}, cleaned AS ({_cleaned('raw', 'order_no')})"
_JOBS_CTE = (
    f"{_CLEAN_CTE}, jobs AS (SELECT * EXCLUDE (failure) "
    "REPLACE (CASE WHEN order_no % 59 <> 0 THEN is_remote END AS is_remote) FROM cleaned WHERE failure IS NULL)"
)


def _over_raw(sql: str) -> str:
    return f"WITH {_RAW_CTE} {sql}"


def _over_jobs(sql: str) -> str:
    return f"WITH {_JOBS_CTE} {sql}"


_SHOWN = {
    "salary_min": "CAST(salary_min AS DOUBLE)",
    "salary_max": "CAST(salary_max AS DOUBLE)",
    "date_posted": "CAST(date_posted AS VARCHAR)",
    "fetched_at": "CAST(fetched_at AS VARCHAR)",
    "skills": "array_to_string(skills, '|')",
}


def _shown(columns: list[str]) -> str:
    return ", ".join(f"{_SHOWN.get(c, c)} AS {c}" for c in columns)


def _mean(column: str) -> str:
    """Exact mean to two decimals, from integer cents."""
    c, n = f"sum(CAST({column} * 100 AS HUGEINT))", f"count({column})"
    return f"CAST(sign({c}) * ((2 * abs({c}) + {n}) // (2 * {n})) AS DOUBLE) / 100"


def _percent(part: str, whole: str, scale: int) -> str:
    p, w = f"CAST({part} AS HUGEINT)", f"CAST({whole} AS HUGEINT)"
    return f"CAST((2 * {100 * 10**scale} * {p} + {w}) // (2 * {w}) AS DOUBLE) / {10**scale}"


# --- search pages -------------------------------------------------------------------

_ITEMS_CTE = f"{_RAW_CTE}, items AS ({_fill(ITEMS, raw='raw', ntz='TIMESTAMP', each_day='unnest([1, 2])')})"

_ASSEMBLED_CTE = f"""{_ITEMS_CTE},
live AS (SELECT * FROM items WHERE page <= 5 AND error IS NULL),
firsts AS (SELECT *, id IS NULL OR row_number() OVER (PARTITION BY run_id, id ORDER BY page, pos) = 1 AS fresh
  FROM live),
page_facts AS (
  SELECT run_id, page, any_value(total) AS total, count(*) AS len, count(*) FILTER (fresh) AS fresh
  FROM firsts GROUP BY run_id, page
  UNION ALL SELECT DISTINCT run_id, 2, total, 0, 0 FROM items WHERE gap AND page = 1
  UNION ALL SELECT DISTINCT run_id, page, total, 0, 0 FROM items WHERE error IS NOT NULL),
sums AS (SELECT *, sum(fresh) OVER (PARTITION BY run_id ORDER BY page) AS kept FROM page_facts),
stops AS (SELECT run_id, min(page) FILTER (len < 50 OR kept >= total) AS stop FROM sums GROUP BY run_id),
broken AS (SELECT DISTINCT run_id FROM items JOIN stops USING (run_id)
  WHERE error IS NOT NULL AND page <= coalesce(stop, 5)),
assembled AS (SELECT firsts.* FROM firsts JOIN stops USING (run_id)
  WHERE fresh AND page <= coalesce(stop, 5) AND run_id NOT IN (SELECT run_id FROM broken))"""

# All landed pages of runs without a failed page; an id counts once per run.
_FETCHED_CTE = f"""{_ITEMS_CTE},
broken AS (SELECT DISTINCT run_id FROM items WHERE error IS NOT NULL),
fetched AS (SELECT *, max(landed_at) OVER (PARTITION BY run_id) AS own_end,
    id IS NULL OR row_number() OVER (PARTITION BY run_id, id ORDER BY page, pos) = 1 AS fresh FROM items),
assembled AS (SELECT * FROM fetched WHERE fresh AND run_id NOT IN (SELECT run_id FROM broken)),
flat AS (SELECT * EXCLUDE (id, landed_at), id AS external_id, landed_at AS fetched_at FROM assembled),
cleaned AS ({_cleaned('flat', 'run_id, keyword, page, pos, own_end')}),
placed AS (SELECT *, row_number() OVER (ORDER BY own_end, keyword, run_id, page, pos) AS arrival
  FROM cleaned WHERE failure IS NULL)"""


def _chain(rows: str, state: str | None) -> str:
    """Outcomes of `rows` in arrival order, each compared with its predecessor."""
    start = f"UNION ALL SELECT {_JOB_COLUMNS}, CAST(-1 AS BIGINT), CAST(NULL AS VARCHAR) FROM {state}" if state else ""
    run = "CAST(NULL AS VARCHAR)" if state else "run_id"
    content = ", ".join(f"{c} := {c}" for c in COMPARED)
    return f"""
events_ AS (SELECT {_JOB_COLUMNS}, arrival, {run} AS run_id FROM {rows} {start}),
ranked AS (SELECT *, row_number() OVER keys AS rn, lag(content) OVER keys AS before
  FROM (SELECT *, hash(struct_pack({content})) AS content FROM events_)
  WINDOW keys AS (PARTITION BY external_id ORDER BY arrival)),
outcomes AS (SELECT * EXCLUDE (content, before), CASE WHEN arrival = -1 THEN 'stored' WHEN rn = 1 THEN 'inserted'
    WHEN content <> before THEN 'updated' ELSE 'skipped' END AS outcome FROM ranked),
writes AS (SELECT external_id, max(arrival) AS arrival FROM outcomes WHERE outcome <> 'skipped' GROUP BY external_id),
final AS (SELECT o.* REPLACE (w.fetched_at AS fetched_at) FROM
  (SELECT * FROM outcomes QUALIFY row_number() OVER (PARTITION BY external_id ORDER BY arrival DESC) = 1) o
  JOIN (SELECT external_id, fetched_at FROM outcomes JOIN writes USING (external_id, arrival)) w USING (external_id))"""


_INCOMING_CTE = f"""{_JOBS_CTE}, incoming AS ({_fill(INCOMING, jobs='jobs', reverse='list_reverse')}),
{_chain('incoming', 'jobs')}"""

_LEDGER_CTE = f"""{_FETCHED_CTE}, {_chain('placed', None)},
counted AS (SELECT run_id, outcome FROM outcomes
  UNION ALL SELECT run_id, 'failed' FROM cleaned WHERE failure IS NOT NULL),
landings AS (SELECT run_id, keyword, landed_at FROM items
  UNION ALL SELECT run_id, keyword, landed_at FROM items WHERE gap AND page = 1),
ledger AS (SELECT r.run_id, r.keyword, count(outcome) AS fetched_count,
    count(*) FILTER (outcome = 'inserted') AS inserted_count, count(*) FILTER (outcome = 'updated') AS updated_count,
    count(*) FILTER (outcome = 'skipped') AS skipped_count, count(*) FILTER (outcome = 'failed') AS failed_count,
    r.started_at, r.completed_at, bool_or(b.run_id IS NOT NULL) AS errored
  FROM (SELECT run_id, keyword, min(landed_at) AS started_at, max(landed_at) AS completed_at
    FROM landings GROUP BY run_id, keyword) r
  LEFT JOIN counted c ON c.run_id = r.run_id LEFT JOIN broken b ON b.run_id = r.run_id
  GROUP BY r.run_id, r.keyword, r.started_at, r.completed_at),
statuses AS (SELECT *, CASE WHEN errored THEN 'failed' WHEN failed_count = 0 THEN 'success'
  WHEN inserted_count + updated_count + skipped_count > 0 THEN 'partial' ELSE 'failed' END AS status,
  CAST(0 AS BIGINT) AS dropped_count FROM ledger
  UNION ALL SELECT 'next-' || run_id, keyword, 0, 0, 0, 0, 0, min(landed_at), NULL, false, 'running', 0
  FROM landings WHERE run_id LIKE 'run-2-%' GROUP BY run_id, keyword)"""

_TERMS_CTE = f"""names AS ({_fill(TERMS)}),
terms AS (SELECT DISTINCT lower(trim(regexp_replace(keyword, '\\s+', ' ', 'g'))) AS keyword FROM names)"""

_SKILL_ROWS = "SELECT *, unnest(skills) AS skill FROM jobs"

_SCHEMA = ", ".join(
    f"({i}, '{f.name}', '{f.dataType.simpleString()}', {str(f.nullable).lower()}, "
    f"(SELECT count(*) FILTER ({f.name} IS NULL) FROM jobs), "
    + (f"(SELECT count(*) FILTER (length({f.name}) > {MAX_LENGTH[f.name]}) FROM jobs))"
       if f.name in MAX_LENGTH else "CAST(0 AS BIGINT))")
    for i, f in enumerate(JOBS, 1)
)

_LATEST = (
    "SELECT title, company, location, is_remote, CAST(salary_min AS DOUBLE) AS salary_min, "
    "CAST(date_posted AS VARCHAR) AS date_posted FROM jobs "
    "ORDER BY fetched_at DESC NULLS FIRST, external_id LIMIT 100"
)

_NAMED = (
    "SELECT company, count(*) AS count FROM jobs WHERE company IS NOT NULL "
    "GROUP BY company ORDER BY count DESC, company LIMIT 10"
)

_TOP_SKILLS = (
    f"SELECT skill, count(*) AS job_count FROM ({_SKILL_ROWS}) "
    "GROUP BY skill ORDER BY job_count DESC, skill LIMIT 15"
)

ORACLE = {
    # preparation
    "flatten_posting": f"""WITH {_ITEMS_CTE} SELECT run_id, page, pos AS position, coalesce(id, '') AS external_id,
  title, company, location, country, salary_min, salary_max, description, url, date_posted,
  CAST(landed_at AS VARCHAR) AS fetched_at FROM items WHERE error IS NULL""",
    "page_runs": f"WITH {_FETCHED_CTE} SELECT run_id, keyword, page, pos AS position, id FROM assembled",
    "normalize_title": _over_raw(f"SELECT order_no, {_title('title')} AS title FROM raw"),
    "normalize_salary": _over_raw(
        f"SELECT order_no, {_salary('salary_min')} AS salary_min, {_salary('salary_max')} AS salary_max FROM raw"
    ),
    "detect_remote": _over_raw(f"SELECT order_no, {_REMOTE} AS is_remote FROM raw"),
    "extract_skills": _over_raw(
        f"SELECT order_no, array_to_string({_SKILLS}, '|') AS skills FROM raw"
    ),
    "parse_posted": _over_raw(f"SELECT order_no, CAST({_POSTED} AS VARCHAR) AS date_posted FROM raw"),
    "clean_postings": f"WITH {_CLEAN_CTE} SELECT order_no, {_shown(JOBS.names)}, failure FROM cleaned",
    "quarantine_counts": f"WITH {_CLEAN_CTE} SELECT failure, count(*) AS postings FROM cleaned "
    "WHERE failure IS NOT NULL GROUP BY failure",
    # table, upsert, runs
    "postings_scan": _over_jobs(f"SELECT {_shown(JOBS.names)} FROM jobs"),
    "upsert_outcomes": f"WITH {_INCOMING_CTE} SELECT external_id, arrival, outcome FROM outcomes WHERE outcome <> 'stored'",
    "upsert_state": f"WITH {_INCOMING_CTE} SELECT {_shown(JOBS.names)} FROM final",
    "stream_upsert": f"WITH {_LEDGER_CTE} SELECT {_shown(JOBS.names)} FROM final",
    "run_ledger": f"""WITH {_LEDGER_CTE} SELECT * REPLACE (CAST(started_at AS VARCHAR) AS started_at,
  CAST(completed_at AS VARCHAR) AS completed_at) FROM statuses""",
    "run_status": f"WITH {_LEDGER_CTE} SELECT status, errored, count(*) AS runs FROM statuses GROUP BY status, errored",
    "batch_gates": f"""WITH {_LEDGER_CTE}, watchlist AS ({_fill(WATCHLIST, raw='raw')}),
results AS (SELECT w.keyword, w.ran AS fine, count(s.keyword) > 0 AS ran,
    coalesce(bool_or(NOT errored AND status <> 'running'), false) AS succeeded,
    coalesce(sum(inserted_count) FILTER (NOT errored AND status <> 'running'), 0) AS inserted
  FROM watchlist w LEFT JOIN statuses s ON s.keyword = w.keyword GROUP BY ALL),
demands AS (SELECT * FROM (VALUES ('all', NULL, 0), ('some', 1, 0), ('many inserted', 1, 1000000000), ('ran', NULL, 0),
  ('none', NULL, 0)) t(demand, least, least_inserted)),
counted_ AS (SELECT demand, least, least_inserted, count(r.keyword) AS keywords,
    count(*) FILTER (succeeded) AS succeeded, CAST(coalesce(sum(inserted), 0) AS BIGINT) AS inserted,
    list_sort(list(r.keyword || CASE WHEN ran THEN '' ELSE ' (not run)' END) FILTER (NOT succeeded)) AS names
  FROM demands LEFT JOIN results r ON demand <> 'none' AND (demand <> 'ran' OR fine) GROUP BY ALL)
SELECT demand, keywords, succeeded, coalesce(least, keywords) AS required, inserted, reason IS NULL AS ok, reason FROM (
  SELECT *, CASE WHEN keywords = 0 THEN 'no search terms are watched'
    WHEN succeeded < coalesce(least, keywords) THEN
      printf('only %d of %d keywords succeeded, %d required; failed: %s', succeeded, keywords, coalesce(least, keywords),
        array_to_string(names[1:10], ', '))
      || CASE WHEN len(names) > 10 THEN printf(' and %d more', len(names) - 10) ELSE '' END
    WHEN inserted < least_inserted THEN printf('inserted %d postings, %d required', inserted, least_inserted) END AS reason
  FROM counted_)""",
    "watch_list": f"WITH {_TERMS_CTE} SELECT keyword FROM terms",
    "watch_add": f"""WITH {_TERMS_CTE} SELECT keyword FROM terms UNION
SELECT unnest(['data engineer', 'data analyst', 'machine learning engineer', 'backend engineer'])""",
    "watch_remove": f"""WITH {_TERMS_CTE} SELECT keyword FROM terms WHERE keyword NOT IN
  (SELECT lower(trim(p_name)) || ' x' FROM part WHERE p_name LIKE 'blue%')""",
    "schema_report": _over_jobs(
        "SELECT * FROM (VALUES " + _SCHEMA
        + ") t(ordinal, column_name, data_type, is_nullable, null_count, too_long_count)"
    ),
    "ingestion_summary": _over_jobs(
        "SELECT count(*) AS total, CAST(max(fetched_at) AS VARCHAR) AS last_fetched FROM jobs"
    ),
    # questions
    "top_companies_all": _over_jobs(
        "SELECT company, count(*) AS job_count FROM jobs GROUP BY company "
        "ORDER BY job_count DESC, company NULLS LAST LIMIT 10"
    ),
    "remote_breakdown": _over_jobs(
        f"SELECT is_remote, n AS job_count, {_percent('n', 'sum(n) OVER ()', 2)} AS percentage "
        "FROM (SELECT is_remote, count(*) AS n FROM jobs GROUP BY is_remote)"
    ),
    "salary_insights": _over_jobs(
        "SELECT CAST(min(salary_min) AS DOUBLE) AS min_salary_min, CAST(max(salary_min) AS DOUBLE) AS max_salary_min, "
        f"{_mean('salary_min')} AS avg_salary_min, CAST(min(salary_max) AS DOUBLE) AS min_salary_max, "
        f"CAST(max(salary_max) AS DOUBLE) AS max_salary_max, {_mean('salary_max')} AS avg_salary_max "
        "FROM jobs WHERE salary_min IS NOT NULL"
    ),
    "top_locations": _over_jobs(
        "SELECT location, count(*) AS job_count FROM jobs GROUP BY location "
        "ORDER BY job_count DESC, location NULLS LAST LIMIT 10"
    ),
    "jobs_per_day": _over_jobs(
        "SELECT strftime(date_posted, '%Y-%m-%d') AS posted_date, count(*) AS job_count FROM jobs "
        "WHERE date_posted IS NOT NULL GROUP BY 1"
    ),
    "top_skills": _over_jobs(_TOP_SKILLS),
    "salary_by_title": _over_jobs(
        f"SELECT lower(title) AS title, count(*) AS posting_count, {_mean('salary_min')} AS avg_salary_min "
        "FROM jobs WHERE salary_min IS NOT NULL GROUP BY lower(title) "
        "ORDER BY avg_salary_min DESC, lower(title) LIMIT 10"
    ),
    "remote_salary": _over_jobs(
        f"SELECT is_remote, count(*) AS job_count, {_mean('salary_min')} AS avg_salary "
        "FROM jobs WHERE salary_min IS NOT NULL GROUP BY is_remote"
    ),
    "company_skills": _over_jobs(
        f"SELECT company, skill, count(*) AS skill_count FROM ({_SKILL_ROWS}) JOIN "
        "(SELECT company FROM jobs WHERE company IS NOT NULL GROUP BY company HAVING count(*) > 1) "
        "USING (company) GROUP BY company, skill"
    ),
    "weekly_volume": _over_jobs(
        "SELECT strftime(date_trunc('week', date_posted), '%Y-%m-%d') AS week_start, count(*) AS job_count "
        "FROM jobs WHERE date_posted IS NOT NULL GROUP BY 1"
    ),
    "salary_range_width": _over_jobs(
        "SELECT company, title, CAST(salary_max - salary_min AS DOUBLE) AS salary_range, "
        "CAST(sign(c) * ((2 * abs(c) + n) // (2 * n)) AS DOUBLE) / 100 AS company_avg_range FROM "
        "(SELECT *, sum(CAST((salary_max - salary_min) * 100 AS HUGEINT)) OVER (PARTITION BY company) AS c, "
        "count(*) OVER (PARTITION BY company) AS n FROM jobs "
        "WHERE salary_min IS NOT NULL AND salary_max IS NOT NULL)"
    ),
    "running_total": _over_jobs(
        "SELECT strftime(fetched_at, '%Y-%m-%d') AS fetched_date, title, company, "
        "CAST(sum(1) OVER (ORDER BY fetched_at) AS BIGINT) AS running_total "
        "FROM jobs WHERE fetched_at IS NOT NULL"
    ),
    "mixed_remote_companies": _over_jobs(
        "SELECT company, count(*) FILTER (is_remote) AS remote_count, "
        "count(*) FILTER (NOT is_remote) AS non_remote_count, count(*) AS total_jobs FROM jobs "
        "WHERE company IS NOT NULL GROUP BY company "
        "HAVING count(*) FILTER (is_remote) >= 1 AND count(*) FILTER (NOT is_remote) >= 1"
    ),
    "kpis": _over_jobs(
        "SELECT count(*) AS total_jobs, CAST(max(fetched_at) AS VARCHAR) AS last_updated, "
        "count(DISTINCT company) AS unique_companies, "
        f"{_percent('count(*) FILTER (is_remote)', 'count(*)', 1)} AS remote_pct, "
        f"{_mean('salary_min')} AS avg_salary FROM jobs"
    ),
    "kpi_labels": _over_jobs(
        "SELECT format('{:,}', count(*)) AS total_jobs, strftime(max(fetched_at), '%Y-%m-%d %H:%M') AS last_updated, "
        "format('{:,}', count(DISTINCT company)) AS unique_companies, "
        f"printf('%.1f%%', {_percent('count(*) FILTER (is_remote)', 'count(*)', 1)}) AS remote_pct, "
        "'$' || format('{:,}', CAST(round_even(CAST(sum(CAST(salary_min * 100 AS HUGEINT)) AS DECIMAL(38, 10)) "
        "/ (100 * count(salary_min)), 0) AS BIGINT)) AS avg_salary FROM jobs"
    ),
    "remote_split": _over_jobs(
        "SELECT is_remote, count(*) AS count, CASE is_remote WHEN true THEN 'Remote' WHEN false THEN 'On-site' END "
        "AS label FROM jobs GROUP BY is_remote"
    ),
    "top_companies_named": _over_jobs(_NAMED),
    "latest_postings": _over_jobs(_LATEST),
    "title_search": _over_jobs(f"SELECT * FROM ({_LATEST}) WHERE regexp_matches(title, 'eng.*r$', 'i')"),
    "chart_skills": _over_jobs(f"SELECT * FROM ({_TOP_SKILLS}) ORDER BY job_count"),
    "chart_companies": _over_jobs(f"SELECT * FROM ({_NAMED}) ORDER BY count"),
    "skill_trend": _over_jobs(
        f"SELECT *, row_number() OVER (PARTITION BY week_start ORDER BY change DESC NULLS LAST, skill) AS rise_rank FROM (WITH "
        f"counted AS (SELECT skill, CAST(date_trunc('week', date_posted) AS TIMESTAMP) AS w, count(*) AS n FROM ({_SKILL_ROWS}) "
        "WHERE date_posted IS NOT NULL GROUP BY ALL), "
        "weeks AS (SELECT CAST(date_trunc('week', date_posted) AS TIMESTAMP) AS w, count(*) AS postings FROM jobs "
        "WHERE date_posted IS NOT NULL GROUP BY ALL), "
        "spine AS (SELECT skill, unnest(generate_series(min(w), (SELECT max(w) FROM weeks), INTERVAL 7 DAY)) AS w FROM counted GROUP BY skill), "
        "dense AS (SELECT skill, w, coalesce(n, 0) AS n, postings FROM spine LEFT JOIN counted USING (skill, w) LEFT JOIN weeks USING (w)) "
        f"SELECT skill, strftime(w, '%Y-%m-%d') AS week_start, n AS job_count, {_percent('n', 'postings', 2)} AS share_pct, "
        "n - lag(n) OVER (PARTITION BY skill ORDER BY w) AS change FROM dense)"
    ),
    "director_salary": _over_jobs(
        f"SELECT title ILIKE '%director%' AS is_director, count(*) AS posting_count, {_mean('salary_min')} "
        "AS avg_salary_min FROM jobs WHERE salary_min IS NOT NULL GROUP BY 1"
    ),
}
