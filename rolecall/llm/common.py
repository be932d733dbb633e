"""Helpers that the operators share."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from typing import Any

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from rolecall.sources import shared_dir


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(rows: DataFrame) -> DataFrame:
    """The rows, written once to the shared folder and read from there: later steps start
    from files, whichever executors are lost meanwhile."""
    spark, path = rows.sparkSession, shared_dir(rows.sparkSession)
    rows.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(rows.schema).parquet(path)


class Kept:
    """What the tasks of one job share in a Python worker, made by the first of them. Broadcast
    it: a worker lets go of a broadcast when it takes up a task that does not use it, so later
    steps have the memory. A cache in a global would stay as long as the worker."""

    def __init__(self, make: Callable[..., Any], *args: str):
        self.make, self.args = make, args

    def __getstate__(self) -> dict:
        return {"make": self.make, "args": self.args}

    def get(self) -> Any:
        if "made" not in self.__dict__:
            self.made = self.make(*self.args)
        return self.made


def texts_of(batch: pa.RecordBatch, name: str) -> list[bytes]:
    """A text column as UTF-8, NULL as empty."""
    return [t or b"" for t in batch.column(name).cast(pa.binary()).to_pylist()]


def free(docs: DataFrame, name: str) -> str:
    """`name`, with as many underscores before it as keep it apart from all columns of `docs`."""
    taken = {c.lower() for c in docs.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def let(value: Column, body) -> Column:
    """`body(value)` with `value` computed once, however often `body` uses it."""
    return F.transform(F.array(value), body)[0]


def groups(batches: Iterable[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Runs of rows with equal keys, which must be adjacent; a run may span batches."""
    rest: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        ends = _ends(batch, keys)
        start = 0
        if rest and not _same(rest[-1], batch, keys):
            yield pa.Table.from_batches(rest)
            rest = []
        for end in ends:
            yield pa.Table.from_batches([*rest, batch.slice(start, end - start)])
            rest, start = [], end
        rest.append(batch.slice(start))
    if rest:
        yield pa.Table.from_batches(rest)


def whole_groups(batches: Iterable[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """The same rows in fewer, larger tables; each holds all rows of its keys."""
    rest: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        if rest and not _same(rest[-1], batch, keys):
            yield pa.Table.from_batches(rest)
            rest = []
        end = (_ends(batch, keys) or [0])[-1]
        if end:
            yield pa.Table.from_batches([*rest, batch.slice(0, end)])
            rest = []
        rest.append(batch.slice(end))
    if rest:
        yield pa.Table.from_batches(rest)


def _ends(batch: pa.RecordBatch, keys: list[str]) -> list[int]:
    """Ends of all runs but the last."""
    import numpy as np

    differs = np.zeros(batch.num_rows - 1, bool)
    for key in keys:
        values = batch.column(key).to_numpy(zero_copy_only=False)
        differs |= values[1:] != values[:-1]
    return (np.flatnonzero(differs) + 1).tolist()


def _same(a: pa.RecordBatch, b: pa.RecordBatch, keys: list[str]) -> bool:
    return all(a.column(k)[a.num_rows - 1] == b.column(k)[0] for k in keys)
