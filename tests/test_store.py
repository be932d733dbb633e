"""The posting store, batch ingestion and the stream."""

import json
import os
import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from rolecall.operators import latest_writes, list_terms
from rolecall.operators.upsert import DEALT
from rolecall.plans.ingest import ingest
from rolecall.schemas import JOBS, PAGE
from rolecall.sources import PostingStore, conf_set, read_pages, read_postings, shared_dir
from rolecall.streaming import ingest_landed

START = datetime(2024, 1, 1)


def run_pages(day, run, ids, title="dev", error=None, size=3):
    """A run's pages as landed JSON; ids of at most `size` per page."""
    chunks = [ids[i : i + size] for i in range(0, len(ids), size)] or [[]]
    pages = []
    for number, chunk in enumerate(chunks, 1):
        at = START + timedelta(days=day, minutes=run, seconds=number)
        pages.append({
            "run_id": f"{day}-{run}", "keyword": f"kw {run}", "page": number,
            "landed_at": at.isoformat() + "Z",
            "results": [{"id": i, "title": f"{title} {i}"} for i in chunk],
        })
    if error:
        pages.append({**pages[-1], "page": len(chunks) + 1, "results": None, "error": error})
    return pages


def land(folder, name, pages):
    os.makedirs(folder, exist_ok=True)
    hidden = f"{folder}/.{name}"
    with open(hidden, "w") as file:
        file.writelines(json.dumps(p) + "\n" for p in pages)
    os.rename(hidden, f"{folder}/{name}.json")


def content(store, **kwargs):
    return {r.external_id: (r.title, r.fetched_at) for r in store.read(**kwargs).collect()}


def ledger(store):
    return {
        r.run_id: (r.fetched_count, r.inserted_count, r.updated_count, r.skipped_count, r.failed_count, r.status)
        for r in store.ledger().collect()
    }


def at(day, run, page):
    return START + timedelta(days=day, minutes=run, seconds=page)


def test_two_batches(spark, shared):
    store = PostingStore(spark, f"{shared}/store", buckets=4)
    assert store.version() == 0 and store.read().count() == 0 and store.ledger().count() == 0
    pages = f"{shared}/pages"
    land(pages, "a", run_pages(1, 1, [1, 2, 3, 4]) + run_pages(1, 2, [4, 5, ""]) + run_pages(1, 3, []))
    land(pages, "b", run_pages(1, 4, [7, 8, 9], error="HTTP 503"))
    first = read_pages(spark, pages)
    assert ingest(store, first, "one") == 1
    want = {"1": ("Dev 1", at(1, 1, 1)), "2": ("Dev 2", at(1, 1, 1)), "3": ("Dev 3", at(1, 1, 1)),
            "4": ("Dev 4", at(1, 1, 2)), "5": ("Dev 5", at(1, 2, 1))}
    assert content(store) == want
    assert ledger(store) == {
        "1-1": (4, 4, 0, 0, 0, "success"),
        "1-2": (3, 1, 0, 1, 1, "partial"),
        "1-3": (0, 0, 0, 0, 0, "success"),
        "1-4": (0, 0, 0, 0, 0, "failed"),
    }
    # A replay of the batch is recognised; the same pages as a new batch are all skipped.
    assert ingest(store, first, "one") == 1
    again = f"{shared}/again"
    land(again, "c", run_pages(2, 1, [1, 2, 3, 4]) + run_pages(2, 2, ["x"]))
    land(again, "d", run_pages(2, 3, [2, 6], title="new"))
    assert ingest(store, read_pages(spark, again), "two") == 2
    want |= {"x": ("Dev X", at(2, 2, 1)), "2": ("New 2", at(2, 3, 1)), "6": ("New 6", at(2, 3, 1))}
    assert content(store) == want
    assert ledger(store)["2-1"] == (4, 0, 0, 4, 0, "success")
    assert ledger(store)["2-3"] == (2, 1, 1, 0, 0, "success")
    # The first version is still there to be read.
    assert len(content(store, version=1)) == 5


def failing(monkeypatch):
    """Makes the next upsert raise, after the batch has begun."""
    import rolecall.plans.ingest as plan

    def fail(*_):
        raise RuntimeError("executors lost")

    monkeypatch.setattr(plan, "latest_writes", fail)


def test_stream_recovers(spark, shared, monkeypatch):
    """A batch that raised is tried again, as it was, before what has landed since."""
    landing, store = f"{shared}/landing", PostingStore(spark, f"{shared}/store", buckets=2)
    go = lambda: ingest_landed(spark, landing, store, f"{shared}/checkpoint", files_per_batch=1)
    land(landing, "a", run_pages(1, 1, [1, 2]))
    assert go() == 1
    land(landing, "b", run_pages(2, 1, [3, 4, 5, 6])[:1])
    land(landing, "c", run_pages(2, 2, [1], title="new"))
    with monkeypatch.context() as patch:
        failing(patch)
        for _ in range(2):  # also when it raises again
            with pytest.raises(RuntimeError):
                go()
    assert ledger(store)["2-1"] == (0, 0, 0, 0, 0, "failed")
    land(landing, "d", run_pages(2, 1, [3, 4, 5, 6])[1:] + run_pages(3, 1, [9]))
    assert go() == 3
    assert ledger(store) == {
        "1-1": (2, 2, 0, 0, 0, "success"), "2-1": (4, 4, 0, 0, 0, "success"), "2-2": (1, 0, 1, 0, 0, "success"),
        "3-1": (1, 1, 0, 0, 0, "success"),
    }
    assert sorted(content(store)) == list("1234569") and go() == 3
    assert store.names("runs") == []


def test_pages_taken_in_under_another_name(spark, shared, monkeypatch):
    """What a failed attempt says of a run stands until all its pages have been taken in."""
    store = PostingStore(spark, f"{shared}/store", buckets=2)
    land(f"{shared}/all", "a", run_pages(1, 1, [1, 2, 3, 4]) + run_pages(1, 2, [5]))
    land(f"{shared}/some", "b", run_pages(1, 1, [1, 2, 3, 4])[:1] + run_pages(1, 2, [5]))
    land(f"{shared}/rest", "c", run_pages(1, 1, [1, 2, 3, 4])[1:])
    with monkeypatch.context() as patch:
        failing(patch)
        with pytest.raises(RuntimeError):
            ingest(store, read_pages(spark, f"{shared}/all"), "lost")
    ingest(store, read_pages(spark, f"{shared}/some"), "some")
    assert ledger(store)["1-2"] == (1, 1, 0, 0, 0, "success")
    assert ledger(store)["1-1"] == (3, 3, 0, 0, 0, "partial")
    since = store.version()
    ingest(store, read_pages(spark, f"{shared}/rest"), "rest")
    assert ledger(store)["1-1"] == (4, 4, 0, 0, 0, "success")
    assert {r.run_id: r.status for r in store.ledger(since=since).collect()} == {"1-1": "success"}


def test_abandoned_attempt_is_invisible(spark, shared):
    store = PostingStore(spark, shared, buckets=2)
    rows = spark.createDataFrame([("1", "a")], "external_id string, title string")
    full = rows.select(*[F.col(c) if c in rows.columns else F.lit(None).alias(c) for c in JOBS.names])
    full = full.select(*[F.col(f.name).cast(f.dataType) for f in JOBS])
    store.commit(full, "one", range(2))

    class Lost(Exception):
        pass

    def fail(_):
        raise Lost

    store._written = fail  # dies after the data has been written, before the version is
    with pytest.raises(Lost):
        store.commit(full.withColumn("external_id", F.lit("2")), "two", range(2))
    fresh = PostingStore(spark, shared, buckets=2)
    assert fresh.version() == 1 and [r.external_id for r in fresh.read().collect()] == ["1"]
    fresh.commit(full.withColumn("external_id", F.lit("3")), "two", range(2))
    assert sorted(r.external_id for r in fresh.read().collect()) == ["1", "3"]


def test_snapshots(spark, shared):
    """Many random batches equal a dictionary; each bucket is one folder."""
    rng = random.Random(5)
    store = PostingStore(spark, shared, buckets=3)
    table = {}
    for batch in range(7):
        writes = {str(rng.randint(1, 40)): f"{batch}" for _ in range(12)}
        table |= writes
        rows = spark.createDataFrame(list(writes.items()), "external_id string, title string")
        rows = rows.select(
            *[(F.col(f.name) if f.name in rows.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in JOBS]
        )
        store.commit(rows, str(batch), range(3))
        assert {r.external_id: r.title for r in store.read().collect()} == table
        assert "Join" not in store.read()._jdf.queryExecution().optimizedPlan().toString()
    # A batch leaves the other buckets alone.
    before = store.snapshots()
    store.commit(rows.filter(store.bucket() == 1), "one bucket", [1])
    assert {b: v for b, v in store.snapshots().items() if b != 1} == {b: v for b, v in before.items() if b != 1}
    assert store.snapshots()[1] == 8
    assert {r.external_id: r.title for r in store.read().collect()} == table
    assert "Join" not in store.read()._jdf.queryExecution().optimizedPlan().toString()
    one = store.read(buckets=[0]).select("external_id").withColumn("b", store.bucket())
    assert {r.b for r in one.collect()} == {0}
    assert read_postings(spark, f"{shared}/data/version=1/bucket=0").columns == JOBS.names


def test_stream_equals_batches_and_survives_a_replay(spark, shared):
    rng = random.Random(11)
    landing, checkpoint = f"{shared}/landing", f"{shared}/checkpoint"
    streamed = PostingStore(spark, f"{shared}/streamed", buckets=4)
    batched = PostingStore(spark, f"{shared}/batched", buckets=4)
    for day in (1, 2, 3):
        for run in range(4):
            ids = [rng.randint(1, 30) for _ in range(rng.randint(0, 9))]
            pages = run_pages(day, run, ids, title=rng.choice(["dev", "ops"]))
            land(landing, f"{day}-{run}", pages)
            land(f"{shared}/day{day}", f"{day}-{run}", pages)
            os.utime(f"{landing}/{day}-{run}.json", (day * 1000 + run,) * 2)
        ingest_landed(spark, landing, streamed, checkpoint, files_per_batch=2)
        ingest(batched, read_pages(spark, f"{shared}/day{day}"), f"day {day}")
    assert streamed.version() == 3
    assert content(streamed) == content(batched)
    assert ledger(streamed) == ledger(batched) and len(ledger(streamed)) == 12
    ids = [r.external_id for r in streamed.read().collect()]
    assert len(ids) == len(set(ids))
    for fetched, *outcomes, _ in ledger(streamed).values():
        assert fetched == sum(outcomes)
    # The stream forgets that it has finished its last batch, and does it again.
    before = content(streamed)
    commits = f"{checkpoint}/commits"
    last = max(int(n) for n in os.listdir(commits) if n.isdigit())
    os.rename(f"{commits}/{last}", f"{commits}/.forgotten")
    if os.path.exists(f"{commits}/.{last}.crc"):
        os.rename(f"{commits}/.{last}.crc", f"{commits}/.forgotten.crc")
    assert ingest_landed(spark, landing, streamed, checkpoint) == 3
    assert content(streamed) == before


def test_file_layout_does_not_matter(spark, shared):
    """A run of three pages, a file for each, in steps of 1, 2 and 10 files."""
    pages = run_pages(1, 1, [1, 2, 3, 2, 4, 1, 5], size=3) + run_pages(1, 2, [2, 9], title="ops")
    for i, p in enumerate(pages):
        land(f"{shared}/landing", f"f{i}", [p])
    found = []
    for step in (1, 2, 10):
        store = PostingStore(spark, f"{shared}/store{step}", buckets=2)
        ingest_landed(spark, f"{shared}/landing", store, f"{shared}/checkpoint{step}", files_per_batch=step)
        found.append((content(store), ledger(store)))
    assert found[0] == found[1] == found[2]
    assert len(found[0][0]) == 6 and found[0][1] == {"1-1": (5, 5, 0, 0, 0, "success"), "1-2": (2, 1, 1, 0, 0, "success")}


def test_nothing_landed_is_lost(spark, shared):
    """Seven pages of a run, a truncated line, and a page number that is text."""
    land(f"{shared}/pages", "a", run_pages(1, 1, list(range(14)), size=2) + run_pages(1, 2, [50]))
    with open(f"{shared}/pages/b.json", "w") as file:
        file.write(json.dumps(run_pages(1, 3, [60])[0])[:-25] + "\n")
        file.write(json.dumps({**run_pages(1, 2, [51])[0], "page": "1"}) + "\n")
    store = PostingStore(spark, f"{shared}/store", buckets=2)
    ingest(store, read_pages(spark, f"{shared}/pages"), "one")
    assert len(content(store)) == 14
    rows = ledger(store)
    assert rows["1-1"] == (14, 14, 0, 0, 0, "success") and rows["1-2"] == (0, 0, 0, 0, 0, "failed")
    assert not any(None in tuple(r)[:8] for r in store.ledger().collect())
    lines = spark.read.parquet(f"{shared}/store/rejected/version=1").collect()
    assert len(lines) == 2 and {r.reason for r in lines} == {"malformed"}


def test_runs_act_as_wholes(spark, shared):
    """The run that was completed last wins, also where the pages of runs interleave."""
    early = run_pages(1, 1, [7], title="from a") + [
        {**run_pages(1, 1, [8])[0], "page": 2, "landed_at": at(1, 5, 0).isoformat() + "Z"}
    ]
    land(f"{shared}/pages", "a", early + run_pages(1, 3, [7], title="from b"))
    store = PostingStore(spark, f"{shared}/store", buckets=2)
    ingest(store, read_pages(spark, f"{shared}/pages"), "one")
    assert content(store)["7"][0] == "From A 7"


def test_ledger_shows_a_batch_at_work(spark, shared, monkeypatch):
    land(f"{shared}/pages", "a", run_pages(1, 1, [1, 2]))
    pages = read_pages(spark, f"{shared}/pages")
    store = PostingStore(spark, f"{shared}/store", buckets=2)
    seen = []

    def killed(*_):
        seen.append(ledger(store))
        raise RuntimeError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(store, "commit", killed)
        with pytest.raises(RuntimeError):
            ingest(store, pages, "one")
    assert seen == [{"1-1": (0, 0, 0, 0, 0, "running")}]
    assert ledger(store) == {"1-1": (0, 0, 0, 0, 0, "failed")}
    # Another batch takes the version; the failed one stays failed until it is tried again.
    land(f"{shared}/more", "b", run_pages(2, 1, [3]))
    ingest(store, read_pages(spark, f"{shared}/more"), "two")
    assert ledger(store)["1-1"][-1] == "failed" and ledger(store)["2-1"][-1] == "success"
    ingest(store, pages, "one")
    assert ledger(store)["1-1"] == (2, 2, 0, 0, 0, "success") and store.names("runs") == []
    # The run lands once more, in another batch.
    ingest(store, pages, "three")
    assert ledger(store)["1-1"] == (4, 2, 0, 2, 0, "success")


def rows_of(spark, *keys):
    rows = spark.createDataFrame([(k, "t") for k in keys], "external_id string, title string")
    return rows.select(
        *[(F.col(f.name) if f.name in rows.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in JOBS]
    )


def test_bucket_count_is_kept(spark, shared):
    PostingStore(spark, shared, buckets=2).commit(rows_of(spark, "a"), "one", range(2))
    with pytest.raises(ValueError, match="2 buckets, not 5"):
        PostingStore(spark, shared, buckets=5).read()


def test_history_costs_nothing(spark, shared, monkeypatch):
    """Later versions read as few listings as the second."""
    store = PostingStore(spark, shared, buckets=1)
    read = []
    own = PostingStore._listing
    monkeypatch.setattr(PostingStore, "_listing", lambda self, v: read.append(v) or own(self, v))
    counts = []
    for batch in range(8):
        read.clear()
        assert store.version(f"{batch}") == 0
        store.commit(rows_of(spark, f"{batch}"), f"{batch}", [0])
        assert store.version(f"{batch}") == batch + 1
        counts.append(len(read))
    assert len(set(counts[1:])) == 1 and max(counts) <= 3
    assert store.version("2") == 3


def test_large_buckets_are_split(spark, shared):
    rows = rows_of(spark).union(
        spark.range(60_000).select(*[
            (F.col("id").cast("string") if f.name == "external_id" else F.sha2(F.col("id").cast("string"), 512)
             if f.name == "description" else F.lit(None)).cast(f.dataType).alias(f.name) for f in JOBS])
    )
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "1m")
    try:
        store = PostingStore(spark, shared, buckets=1)
        store.commit(rows, "one", [0])
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    files = [n for n in os.listdir(f"{shared}/data/version=1/bucket=0") if n.endswith(".parquet")]
    assert len(files) > 2 and store.read().count() == 60_000


def test_shared_dir_follows_the_cluster(spark):
    assert shared_dir(spark).startswith(spark.conf.get("spark.checkpoint.dir"))


def test_steps_of_the_stream_leave_little_behind(spark, shared):
    """No step lists all files seen so far anew, and a step has at most a file per core."""
    landing, checkpoint = f"{shared}/landing", f"{shared}/checkpoint"
    store = PostingStore(spark, f"{shared}/store", buckets=2)
    names = [f"spark.sql.{n}" for n in (
        "sources.parallelPartitionDiscovery.parallelism", "streaming.fileSource.log.compactInterval")]
    before = [spark.conf.get(n) for n in names]
    for run in range(11):
        land(landing, f"{run}", run_pages(1, run, [run]))
    ingest_landed(spark, landing, store, checkpoint, files_per_batch=1)
    assert len(store.names("arrived/landing")) == 11
    assert not [n for n in os.listdir(f"{checkpoint}/sources/0") if n.endswith(".compact")]
    for run in range(11, 51):
        land(landing, f"{run}", run_pages(1, run, [run]))
    with conf_set(spark, {"spark.sql.files.maxPartitionBytes": "64k"}):  # each file is a partition
        ingest_landed(spark, landing, store, checkpoint, files_per_batch=100)
    files = [n for n in store.names("arrived/landing/step=11") if n.endswith(".parquet")]
    assert len(files) <= spark.sparkContext.defaultParallelism
    assert sorted(content(store), key=int) == [str(i) for i in range(51)]
    assert [spark.conf.get(n) for n in names] == before


def shuffle_files(spark):
    manager = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    return {n for d in manager.localDirs() for _, _, names in os.walk(d.getPath()) for n in names if n.startswith("shuffle_")}


def test_shuffles_go_with_their_step(spark, shared):
    """A batch leaves no shuffle files behind, and nothing cached."""
    store = PostingStore(spark, f"{shared}/store", buckets=2)
    land(f"{shared}/pages", "a", run_pages(1, 1, [1, 2, 3]) + run_pages(1, 2, [3], error="HTTP 503"))
    land(f"{shared}/more", "b", run_pages(2, 1, [2, 5], title="new"))
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    own, before = spark.conf.get(name), shuffle_files(spark)
    for folder in ("pages", "more"):
        ingest(store, read_pages(spark, f"{shared}/{folder}"), folder)
    assert shuffle_files(spark) <= before
    assert spark.conf.get(name) == own and not spark.sparkContext._jsc.getPersistentRDDs()
    assert {k: v[0] for k, v in content(store).items()} == {"1": "Dev 1", "2": "New 2", "3": "Dev 3", "5": "New 5"}


def test_contents_are_shuffled_once_for_their_bucket(spark, shared):
    """Neither stored rows nor writes move again to be written; a bucket is in few files."""
    store = PostingStore(spark, shared, buckets=40)
    store.commit(rows_of(spark, *map(str, range(400))), "one", range(40))
    staged = store.stage(rows_of(spark, *map(str, range(200, 600))).withColumn("title", F.lit("new")))
    outcomes = staged.select("external_id", "bucket", "_staged", "fetched_at", F.lit("updated").alias("outcome"))
    plain = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}
    with conf_set(spark, plain | DEALT):
        writes = latest_writes(outcomes, staged, JOBS.names, [["_staged"]], place=["bucket"], parts=store.parts(40))
        others = store._others(set(range(40)), 1, outcomes)
        for rows in (writes, others):
            lines = rows._jdf.queryExecution().executedPlan().toString().splitlines()
            moved = [a for a, b in zip(lines, lines[1:]) if "Exchange" in a and "description#" in b]
            assert len(moved) == 1 and "hashpartitioning(bucket#" in moved[0]
            tasks = rows.select("bucket", F.spark_partition_id().alias("task")).distinct()
            assert tasks.groupBy("bucket").count().filter("count > 1").isEmpty()
    store.commit(writes, "two", range(40), written=outcomes)
    assert {r.external_id: r.title for r in store.read().collect()} == {
        str(i): "t" if i < 200 else "new" for i in range(600)}
    found = [n for b in range(40) for n in store.names(f"data/version=2/bucket={b}") if n.endswith(".parquet")]
    assert len(found) <= 80
