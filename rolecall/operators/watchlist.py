"""The set of watched search terms: `keyword, created_at`."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession, functions as F

from rolecall.functions import normalize_keyword, utc_time
from rolecall.schemas import MAX_KEYWORD, SEED_TERMS, WATCHED


def _terms(keywords: DataFrame) -> DataFrame:
    """Distinct normalised terms; an empty or over-long one fails the job."""
    term = normalize_keyword(F.col("keyword"))
    too_long = f"keyword must not be longer than {MAX_KEYWORD} characters"
    checked = (
        F.when(term == "", F.raise_error(F.lit("keyword must not be empty")))
        .when(F.length(term) > MAX_KEYWORD, F.raise_error(F.lit(too_long)))
        .otherwise(term)
    )
    return keywords.select(checked.alias("keyword")).distinct()


def list_terms(watched: DataFrame) -> DataFrame:
    """Terms in alphabetical order."""
    return watched.select("keyword").orderBy("keyword")


def add_terms(
    watched: DataFrame, new: DataFrame, created_at: datetime
) -> tuple[DataFrame, DataFrame]:
    """`(watch list, added)`; a term that is present already keeps its row."""
    added = _terms(new).join(watched, "keyword", "left_anti")
    added = added.withColumn("created_at", utc_time(created_at))
    return watched.unionByName(added), added


def remove_terms(
    watched: DataFrame, gone: DataFrame, min_terms: int = 0
) -> tuple[DataFrame, DataFrame]:
    """`(watch list, removed)`; an error if fewer than `min_terms` would remain."""
    terms = _terms(gone)
    left = watched.join(terms, "keyword", "left_anti")
    removed = watched.join(terms, "keyword", "left_semi")
    if min_terms and left.limit(min_terms).count() < min_terms:
        raise ValueError(f"keep at least {min_terms} search term(s)")
    return left, removed


def seed_terms(spark: SparkSession, watched: DataFrame | None, created_at: datetime) -> DataFrame:
    """Watch list with the starting terms in it; running it again changes nothing."""
    if watched is None:
        watched = spark.createDataFrame([], WATCHED)
    seeds = spark.createDataFrame([(t,) for t in SEED_TERMS], "keyword string")
    return add_terms(watched, seeds, created_at)[0]
