"""Column functions. All are built-in Spark expressions; none starts a Python worker."""

from rolecall.functions.dates import parse_posted, posted_day, posted_week, utc_time
from rolecall.functions.money import avg_money, normalize_salary, percentage, to_money
from rolecall.functions.text import (
    detect_remote,
    extract_skills,
    normalize_keyword,
    normalize_title,
    strip,
    title_case,
)

__all__ = [
    "avg_money",
    "detect_remote",
    "extract_skills",
    "normalize_keyword",
    "normalize_salary",
    "normalize_title",
    "parse_posted",
    "percentage",
    "posted_day",
    "posted_week",
    "strip",
    "title_case",
    "to_money",
    "utc_time",
]
