"""Golden rows of the column functions."""

from datetime import datetime
from decimal import Decimal

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from rolecall import functions as fn
from rolecall.functions.text import BLANK_TEXT


def apply(spark, make, *values, schema="v string"):
    rows = spark.createDataFrame([v if isinstance(v, tuple) else (v,) for v in values], schema)
    names = rows.columns
    indexed = rows.coalesce(1).select(make(*[F.col(n) for n in names]).alias("r"))
    return [r.r for r in indexed.collect()]


def test_title(spark):
    cases = {
        None: "",
        "  senior data engineer - Remote  ": "Senior Data Engineer",
        "Data Engineer": "Data Engineer",
        "o'neil's data-engineer 3d": "O'Neil'S Data-Engineer 3D",
        "x - USA - Remote": "X",
        "x - Remote - USA": "X - Remote",
        "bonus-": "Bon",
        "analyst (REMOTE)": "Analyst",
        "two  spaces kept": "Two  Spaces Kept",
    }
    assert apply(spark, fn.normalize_title, *cases) == list(cases.values())


def test_title_case_as_python(spark):
    texts = ["élan VITAL", "x--y z_q", "中文abc", "ﬁne", "ßtraße", "ΑΣ ΟΔΟΣ", "ǆabc", "a\tb\nc", "ʰello"]
    assert apply(spark, fn.title_case, *texts) == [t.title() for t in texts]


@settings(max_examples=5, deadline=None, derandomize=True, suppress_health_check=list(HealthCheck))
@given(st.lists(st.text(st.characters(max_codepoint=0x17F), max_size=20), min_size=50, max_size=50))
def test_title_case_of_any_latin_text(spark, texts):
    # Beyond these letters Python and the JVM may follow different Unicode versions.
    texts = [t.replace(chr(0x130), "") for t in texts]
    assert apply(spark, fn.title_case, *texts) == [t.title() for t in texts]


def test_blanks_are_those_of_python():
    assert set(BLANK_TEXT) == {chr(c) for c in range(0x10000) if chr(c).isspace()}


def test_salary(spark):
    cases = {
        None: None, " 12 ": 12.0, "-5": -5.0, "1e5": 100000.0, "120k": None, "": None,
        "€1,5": 15.0, "$ 120": 120.0, "1_000": 1000.0, "1__0": None, ".5": 0.5, "5.": 5.0,
        "12d": None, "nan": None, "Infinity": float("inf"), "150000.50": 150000.5, ".": None,
    }
    assert apply(spark, fn.normalize_salary, *cases) == list(cases.values())


def test_money_rounds_half_away_from_zero_and_rejects_overflow(spark):
    values = [0.125, -0.125, 99999999.99, 99999999.995, None]
    got = apply(spark, fn.to_money, *values, schema="v double")
    assert got == [Decimal("0.13"), Decimal("-0.13"), Decimal("99999999.99"), None, None]


def test_remote(spark):
    cases = [
        (("Work from", "home office"), True),
        (("Data Engineer", "On-site in NYC."), False),
        (("x - REMOTE", None), True),
        ((None, None), False),
        (("a", "not remotely"), True),
        (("a", "Anywhere in the US"), True),
    ]
    rows = [c for c, _ in cases]
    got = apply(spark, fn.detect_remote, *rows, schema="t string, d string")
    assert got == [want for _, want in cases]


def test_skills(spark):
    cases = {
        None: [],
        "": [],
        "Need Python, SQL, Spark, and AWS. Work from home 2 days/week.": ["python", "sql", "spark", "aws"],
        "Python and PostgreSQL required. On-site in NYC.": ["python", "postgresql"],
        "sql_x MySQL": ["mysql"],
        "power  bi": [],
        "POWER BI, not powerbi": ["power bi"],
        "Scala/Java, java": ["scala", "java"],
        "sql²": [],
        "aİrflow ſql Kafka": ["sql", "kafka", "airflow"],
        "cafésql sqlé": [],
    }
    assert apply(spark, fn.extract_skills, *cases) == list(cases.values())


def test_skills_of_an_awkward_lexicon(spark):
    lexicon = ("data", "data lake", "c++", "lake house")
    got = apply(spark, lambda c: fn.extract_skills(c, lexicon), "a data lake house", "c++x", "data-lake c++ ")
    # A boundary after "+" needs a word character there.
    assert got == [["data", "data lake", "lake house"], ["c++"], ["data"]]
    assert apply(spark, lambda c: fn.extract_skills(c, ("Go", "é")), "go É", "ago") == [["Go", "é"], []]


def test_posted(spark):
    cases = {
        None: None,
        "": None,
        "2024-01-02T08:30:00Z": datetime(2024, 1, 2, 8, 30),
        "2024-01-02T08:30:00+02:00": datetime(2024, 1, 2, 6, 30),
        "2024-01-02T08:30:00.25-0530": datetime(2024, 1, 2, 14, 0, 0, 250000),
        "2024-03-10T02:30:00": datetime(2024, 3, 10, 2, 30),
        "2024-01-02": datetime(2024, 1, 2),
        "2024-02-31": None,
        "12:30": None,
        "not a date": None,
        "20240105T083000Z": datetime(2024, 1, 5, 8, 30),
        "20240105T0830+0200": datetime(2024, 1, 5, 6, 30),
        "20240105": datetime(2024, 1, 5),
        "20240231": None,
        "2024-005": datetime(2024, 1, 5),
        "2024366T12:00:00.5Z": datetime(2024, 12, 31, 12, 0, 0, 500000),
        "2023-366": None,
        "2024-000": None,
        "2024-W01-5": datetime(2024, 1, 5),
        "2020W537T2359": datetime(2021, 1, 3, 23, 59),
        "2024-W53-1": None,
        "2024-W00-1": None,
        "2024-W01": None,
        "20240105T08300": None,
        "120000": None,
    }
    assert apply(spark, fn.parse_posted, *cases) == list(cases.values())


def test_keyword(spark):
    cases = {"  Data   ENGINEER ": "data engineer", None: "", " x\t\ny ": "x y"}
    assert apply(spark, fn.normalize_keyword, *cases) == list(cases.values())


def test_average_is_rounded_once(spark):
    # The mean is 0.0049999...: rounding it to six decimals first would give a whole cent.
    rows = spark.range(5_000_000).select(
        F.when(F.col("id") < 2_499_999, "0.01").otherwise("0.00").cast("decimal(10,2)").alias("x")
    )
    assert rows.agg(F.round(fn.avg_money(F.col("x")), 2)).first()[0] == Decimal("0.00")


@pytest.mark.parametrize("part, whole, want", [(1, 3, "33.33"), (1, 800, "0.13"), (0, 0, None)])
def test_percentage(spark, part, whole, want):
    got = spark.range(1).select(fn.percentage(F.lit(part), F.lit(whole), 2)).first()[0]
    assert got == (want and Decimal(want))
