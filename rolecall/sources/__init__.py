"""Readers of landed pages and posting tables, and the versioned posting store."""

from rolecall.sources.files import (
    conf_set, read_pages, read_postings, shared_dir, shuffles_released, stream_pages,
)
from rolecall.sources.store import PostingStore
from rolecall.sources.watched import WatchedTerms

__all__ = [
    "PostingStore", "WatchedTerms", "conf_set", "read_pages", "read_postings", "shared_dir", "shuffles_released",
    "stream_pages",
]
