"""What the registered queries write on the way."""

from importlib import import_module
from pathlib import Path

import pytest

from checks.queries import QUERIES
from rolecall.sources import PostingStore


def made_by(spark, query, pattern):
    shared = Path(spark.conf.get("spark.checkpoint.dir"))
    before = set(shared.rglob(pattern))
    QUERIES[query](spark, "/root/testdata/sf0.001").count()
    return set(shared.rglob(pattern)) - before


@pytest.mark.parametrize("query", ["flatten_posting", "run_ledger"])
def test_landed_pages_are_written_compressed(spark, query):
    names = [p.name for p in made_by(spark, query, "part-*json*") if p.suffix != ".crc"]
    assert names and all(n.endswith(".json.gz") for n in names)


def test_a_stream_lists_a_step_in_as_many_tasks_as_cores(spark, tmp_path, monkeypatch):
    module = import_module("rolecall.streaming.ingest")
    name = "spark.sql.sources.parallelPartitionDiscovery.parallelism"
    seen, before, plain = [], spark.conf.get(name), module.stream_pages

    def stream_pages(session, *args):
        seen.append(int(session.conf.get(name)))
        return plain(session, *args)

    monkeypatch.setattr(module, "stream_pages", stream_pages)
    (tmp_path / "landing").mkdir()
    store = PostingStore(spark, str(tmp_path / "store"), buckets=2)
    assert module.ingest_landed(spark, str(tmp_path / "landing"), store, str(tmp_path / "checkpoint")) == 0
    assert seen == [spark.sparkContext.defaultParallelism]
    assert spark.conf.get(name) == before
