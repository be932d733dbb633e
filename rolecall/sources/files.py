"""File sources."""

from __future__ import annotations

import uuid
from collections.abc import Iterator, Mapping
from contextlib import AbstractContextManager, contextmanager

from pyspark.sql import DataFrame, SparkSession, functions as F

from rolecall.functions import parse_posted
from rolecall.schemas import JOBS, LANDED_PAGE

_KEEP_BAD = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "bad_line"}


def typed_pages(landed: DataFrame) -> DataFrame:
    """Landed pages in the page schema."""
    return landed.withColumn("landed_at", parse_posted(F.col("landed_at")))


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    """Landed search pages, one JSON object per line; see `operators.split_rejected`."""
    return typed_pages(spark.read.schema(LANDED_PAGE).options(**_KEEP_BAD).json(path))


def stream_pages(spark: SparkSession, path: str, files_per_batch: int) -> DataFrame:
    """The same as a stream of newly landed files."""
    reader = spark.readStream.schema(LANDED_PAGE).options(**_KEEP_BAD)
    return typed_pages(reader.option("maxFilesPerTrigger", files_per_batch).json(path))


def read_postings(spark: SparkSession, path: str) -> DataFrame:
    """A posting table kept as Parquet."""
    return spark.read.schema(JOBS).parquet(path)


def shared_dir(spark: SparkSession) -> str:
    """A fresh folder that driver and executors share.

    It lies below `spark.checkpoint.dir`, or below the warehouse where that is unset.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base is None:
        base = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/scratch"
    return f"{base}/rolecall-{uuid.uuid4().hex}"


def shuffles_released(spark: SparkSession) -> AbstractContextManager[None]:
    """Shuffle files of what runs in the block go as it ends. Else they stay until the driver's
    garbage collector comes to what they belong to, and a few steps' take more disk than the data.
    """
    return conf_set(spark, {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"})


@contextmanager
def conf_set(spark: SparkSession, values: Mapping[str, object]) -> Iterator[None]:
    """The session with other settings, for as long as the block takes."""
    before = {name: spark.conf.get(name, None) for name in values}
    for name, value in values.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)
