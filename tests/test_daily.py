"""The daily job and the stored watch list."""

from datetime import datetime

import pytest

from rolecall.operators import failed_keywords
from rolecall.plans.daily import BatchFailed, run_daily
from rolecall.schemas import SEED_TERMS
from rolecall.sources import PostingStore, WatchedTerms
from tests.test_store import at, failing, land, ledger, run_pages

AT, LATER = datetime(2024, 1, 1), datetime(2024, 1, 2)


def names(terms):
    return sorted(r.keyword for r in terms.read().collect())


def test_watched_terms(spark, shared):
    terms = WatchedTerms(spark, f"{shared}/watched")
    assert names(terms) == []
    terms.seed(AT)
    assert names(terms) == sorted(SEED_TERMS)
    assert terms.add(" New  Term", "DATA engineer", created_at=LATER) == ["new term"]
    assert terms.add("new term", created_at=LATER) == []
    assert terms.remove("absent") == []
    with pytest.raises(ValueError):
        terms.remove("new term", *SEED_TERMS, min_terms=1)
    assert terms.remove("New Term") == ["new term"]
    terms.seed(LATER)
    assert {r.created_at for r in terms.read().collect()} == {AT}
    assert len(terms.remove(*SEED_TERMS)) == 4
    assert names(WatchedTerms(spark, f"{shared}/watched")) == []


def test_two_writers_of_watched_terms(spark, shared, monkeypatch):
    """Changes that start from the same list, one inside the other."""
    terms, other = (WatchedTerms(spark, f"{shared}/watched") for _ in range(2))
    terms.add("a", "b", created_at=AT)

    def meanwhile(change):
        append = WatchedTerms._append

        def first_other(self, *args):
            monkeypatch.setattr(WatchedTerms, "_append", append)
            change()
            append(self, *args)

        monkeypatch.setattr(WatchedTerms, "_append", first_other)

    meanwhile(lambda: other.add("c", "d", created_at=AT))
    assert terms.add("d", "e", created_at=LATER) == ["d", "e"]
    found = {r.keyword: r.created_at for r in terms.read().collect()}
    assert found == {"a": AT, "b": AT, "c": AT, "d": AT, "e": LATER}
    meanwhile(lambda: other.remove("a"))
    assert terms.remove("b") == ["b"]
    assert names(terms) == ["c", "d", "e"]
    assert terms.add("a", created_at=LATER) == ["a"]
    assert terms.remove("c", "a") == ["a", "c"]
    meanwhile(lambda: other.remove("d", min_terms=1))
    with pytest.raises(ValueError, match="at least 1"):
        terms.remove("e", min_terms=1)
    assert names(terms) == ["e"]


def test_daily(spark, shared):
    store = PostingStore(spark, f"{shared}/store", buckets=2)
    terms = WatchedTerms(spark, f"{shared}/watched")
    landing = f"{shared}/landing"
    land(landing, "a", run_pages(1, 1, [1, 2]) + run_pages(1, 2, [3], error="HTTP 503") + run_pages(1, 3, []))

    def daily(**limits):
        return run_daily(
            spark, landing, store, f"{shared}/checkpoint", terms.read(), **limits
        ).first()

    with pytest.raises(BatchFailed, match="no search terms"):
        daily()
    assert store.version() == 0
    terms.add("kw 1", "kw 2", "kw 3", created_at=AT)
    with pytest.raises(BatchFailed, match="only 2 of 3 keywords succeeded, 3 required; failed: kw 2"):
        daily()
    # The runs that came through are kept.
    assert ledger(store)["1-1"] == (2, 2, 0, 0, 0, "success")
    assert [r.keyword for r in failed_keywords(store.ledger(), terms.read()).collect()] == ["kw 2"]
    land(landing, "b", run_pages(2, 1, [1, 2]) + run_pages(2, 2, [9]) + run_pages(2, 3, [2]))
    summary = daily(min_inserted=1)
    assert (summary.total, summary.last_fetched) == (3, at(2, 2, 1))
    land(landing, "c", run_pages(3, 1, [1]))
    with pytest.raises(BatchFailed, match="inserted 0 postings, 1 required"):
        daily(min_succeeded=1, min_inserted=1)


def test_daily_after_an_outage(spark, shared, monkeypatch):
    store, landing = PostingStore(spark, f"{shared}/store", buckets=2), f"{shared}/landing"
    terms = WatchedTerms(spark, f"{shared}/watched")
    terms.add("kw 1", "kw 2", created_at=AT)
    go = lambda: run_daily(spark, landing, store, f"{shared}/checkpoint", terms.read()).first()
    land(landing, "a", run_pages(1, 1, [1, 2]))
    with monkeypatch.context() as patch:
        failing(patch)
        with pytest.raises(RuntimeError):
            go()
    land(landing, "b", run_pages(1, 2, [3]))
    assert go().total == 3
    assert {r.run_id: r.status for r in store.ledger().collect()} == {"1-1": "success", "1-2": "success"}
