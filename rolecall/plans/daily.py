"""The daily job: ingest what has landed, check the batch, report the table.

    spark-submit rolecall/plans/daily.py LANDING STORE WATCHED CHECKPOINT
"""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession

from rolecall.operators.ledger import batch_gates
from rolecall.plans.market import ingestion_summary
from rolecall.sources import PostingStore, WatchedTerms
from rolecall.streaming import ingest_landed


class BatchFailed(Exception):
    """The batch was ingested as far as it goes but did not meet its minimum."""


def run_daily(
    spark: SparkSession,
    landing: str,
    store: PostingStore,
    checkpoint: str,
    watched: DataFrame,
    min_succeeded: int | None = None,
    min_inserted: int = 0,
    **paging: int,
) -> DataFrame:
    """Ingest new page files and return the table's summary; raise if a check fails."""
    if watched.isEmpty():
        raise BatchFailed("no search terms are watched")
    before = store.version()
    ingest_landed(spark, landing, store, checkpoint, **paging)
    gate = batch_gates(store.ledger(since=before), watched, min_succeeded, min_inserted).first()
    if not gate.ok:
        raise BatchFailed(gate.reason)
    return ingestion_summary(store.read())


def main() -> None:
    parser = argparse.ArgumentParser(description=__doc__)
    for folder in ("landing", "store", "watched", "checkpoint"):
        parser.add_argument(folder)
    parser.add_argument("--buckets", type=int, default=64)
    parser.add_argument("--min-succeeded", type=int)
    parser.add_argument("--min-inserted", type=int, default=0)
    args = parser.parse_args()
    spark = SparkSession.builder.appName("rolecall daily").getOrCreate()
    store = PostingStore(spark, args.store, args.buckets)
    watched = WatchedTerms(spark, args.watched).read()
    summary = run_daily(
        spark, args.landing, store, args.checkpoint, watched, args.min_succeeded, args.min_inserted
    )
    print(summary.first().asDict())


if __name__ == "__main__":
    main()
