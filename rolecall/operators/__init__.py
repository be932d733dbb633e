"""Row-set operators: `DataFrame -> DataFrame`, lazy, nothing collected."""

from rolecall.operators.chain import previous_values, running_sum
from rolecall.operators.cleaning import clean_postings, flatten_postings, quarantine_counts, split_failures
from rolecall.operators.ledger import (
    batch_gates,
    break_runs,
    close_runs,
    failed_keywords,
    fold_runs,
    open_runs,
    run_manifest,
    run_status,
    schema_report,
)
from rolecall.operators.pages import assemble_runs, dropped_results, failed_runs, split_rejected
from rolecall.operators.upsert import classify, latest_writes, merge, upsert
from rolecall.operators.watchlist import add_terms, list_terms, remove_terms, seed_terms

__all__ = [
    "add_terms",
    "assemble_runs",
    "batch_gates",
    "break_runs",
    "classify",
    "clean_postings",
    "close_runs",
    "dropped_results",
    "failed_keywords",
    "failed_runs",
    "flatten_postings",
    "fold_runs",
    "latest_writes",
    "list_terms",
    "merge",
    "open_runs",
    "previous_values",
    "quarantine_counts",
    "remove_terms",
    "run_manifest",
    "run_status",
    "running_sum",
    "schema_report",
    "seed_terms",
    "split_failures",
    "split_rejected",
    "upsert",
]
