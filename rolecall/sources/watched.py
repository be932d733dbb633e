"""The stored watch list."""

from __future__ import annotations

import uuid
from datetime import datetime

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window, functions as F, types as T

from rolecall.operators.watchlist import add_terms, remove_terms, seed_terms
from rolecall.schemas import WATCHED

CHANGES = T.StructType(
    [*WATCHED, T.StructField("step", T.LongType()), T.StructField("present", T.BooleanType())]
)


class WatchedTerms:
    """Watched search terms in a folder, as the changes made to them.

    Each change is one file in a folder of its own name, which appears in one piece, so no
    writer replaces or waits for another's. A change counts as later than all it has seen.
    Of changes that have not seen each other, those to different terms all hold; of those to
    one term an addition wins over a removal, and the earliest `created_at` stays.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root

    def _changes(self) -> DataFrame:
        try:
            rows = self.spark.read.schema(CHANGES).parquet(f"{self.root}/change=*")
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], CHANGES)
        return rows.select(*CHANGES.names)

    def _current(self) -> tuple[int, DataFrame]:
        """The last step and the list after it."""
        changes = self._changes()
        last = changes.agg(F.max("step")).first()[0] or 0
        newest = Window.partitionBy("keyword").orderBy(F.desc("step"), F.desc("present"), "created_at")
        rows = changes.withColumn("_newest", F.row_number().over(newest) == 1)
        return last, rows.filter("_newest AND present").select(*WATCHED.names)

    def _append(self, step: int, rows: DataFrame, present: bool) -> None:
        change = rows.select(*WATCHED.names, F.lit(step).cast("long").alias("step"), F.lit(present).alias("present"))
        change.coalesce(1).write.parquet(f"{self.root}/change={uuid.uuid4().hex}")

    def _rows(self, terms: list) -> DataFrame:
        return self.spark.createDataFrame([tuple(t) for t in terms], WATCHED)

    def _terms(self, terms: tuple[str, ...]) -> DataFrame:
        return self.spark.createDataFrame([(t,) for t in terms], "keyword string")

    def read(self) -> DataFrame:
        return self._current()[1]

    def seed(self, created_at: datetime) -> None:
        """Add the starting terms that are missing."""
        step, rows = self._current()
        seeded = seed_terms(self.spark, rows, created_at).join(rows, "keyword", "left_anti")
        if new := seeded.select(*WATCHED.names).collect():
            self._append(step + 1, self._rows(new), True)

    def add(self, *terms: str, created_at: datetime) -> list[str]:
        """Add terms and return those that were new, normalised."""
        step, rows = self._current()
        new = add_terms(rows, self._terms(terms), created_at)[1].select(*WATCHED.names).collect()
        if new:
            self._append(step + 1, self._rows(new), True)
        return sorted(r.keyword for r in new)

    def remove(self, *terms: str, min_terms: int = 0) -> list[str]:
        """Remove terms and return those that were there, normalised.

        If removals that have not seen each other leave fewer than `min_terms` terms, those
        that find this out put theirs back and fail.
        """
        step, rows = self._current()
        gone = remove_terms(rows, self._terms(terms), min_terms)[1].select(*WATCHED.names).collect()
        if gone:
            self._append(step + 1, self._rows(gone), False)
            if min_terms:
                step, left = self._current()
                if left.limit(min_terms).count() < min_terms:
                    self._append(step + 1, self._rows(gone), True)
                    raise ValueError(f"keep at least {min_terms} search term(s)")
        return sorted(r.keyword for r in gone)
