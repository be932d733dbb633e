import math

import numpy as np
import pytest

from rolecall.llm.topk import ORACLE, Block, Vectors, top_products

SCHEMA = "vec_id long, embedding array<float>, label int, bucket string, block string, id string"
QUERY = "id % 20 = 0"


def sound(v):
    return v is not None and all(x is not None and math.isfinite(x) for x in v)


def brute(rows, k=20):
    rows = [(i, [math.floor(64 * float(np.float32(x))) for x in v]) for i, v in rows if i is not None and sound(v)]
    asked = {}
    for i, v in rows:
        if i % 20 == 0:
            asked[i] = max(asked.get(i, v), v)
    out = []
    for i, q in asked.items():
        scored = [(-sum(a * b for a, b in zip(q, v)), j) for j, v in rows if j != i]
        out += [(i, r + 1, j, -s) for r, (s, j) in enumerate(sorted(scored)[:k])]
    return sorted(out)


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 1, "x", "y", "z") for i, v in rows], SCHEMA).repartition(3)


def run(spark, rows, **options):
    found = top_products(frame(spark, rows), QUERY, **options)
    return sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in found.collect())


def close_rows(n=600, seed=1):
    """Clusters of almost equal vectors of very different lengths."""
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(20, 12)) * rng.choice([0.2, 1, 30], (20, 1))
    rows = [(i, (centres[i % 20] * rng.choice([0.5, 1, 1.01]) + rng.normal(size=12) * 0.004).astype(np.float32).tolist()) for i in range(n)]
    return rows + [(n + i, rows[0][1]) for i in range(150)]  # ties of many equal vectors


def test_clusters_and_ties(spark):
    rows = close_rows()
    want = brute(rows)
    assert run(spark, rows, block=64) == want
    assert run(spark, rows, block=50, coordinate_from=0.0, slice_blocks=1) == want
    assert run(spark, rows, coordinate_from=2.0) == want


def test_edge_cases(spark):
    rows = [
        (0, [1.0, 0.5]), (1, None), (2, [1.0, None]), (3, [math.nan, 1.0]), (4, [math.inf]), (5, []), (6, [0.0, 0.0]), (7, [-1.0, -2.0, 3.0]),
        (20, []), (40, [0.0]), (60, [-5.0, 1e-9]), (None, [1.0]), (8, [1.0, 0.5]), (8, [1.0, 0.5]), (9, [1000.0, 1000.0]), (80, None),
    ]
    assert run(spark, rows) == brute(rows)
    assert run(spark, rows, k=2) == brute(rows, 2)
    assert run(spark, [(0, [1.0])]) == []
    assert run(spark, [(1, [1.0]), (2, [1.0])]) == []
    assert top_products(frame(spark, rows).limit(0), QUERY).count() == 0
    huge = [(0, [1e7, 3e7]), (1, [3e7, 1e7]), (2, [1e30]), (3, [-2e7, 2e7])]
    assert run(spark, huge) == brute([r for r in huge if r[0] != 2])


def test_query_ids_that_repeat(spark):
    rows = [(20, [1.0, 0.0]), (20, [0.0, 1.0]), (20, [1.0, 0.0]), (1, [3.0, 1.0]), (2, [3.0, 1.0])]
    assert run(spark, rows) == [(20, 1, 1, 192 * 64), (20, 2, 2, 192 * 64)]


@pytest.mark.parametrize("kind", ["unit", "lengths", "copies"])
def test_blocks_against_brute_force(kind):
    """A block with floors finds what it has, whichever way it prunes."""
    rng = np.random.default_rng(3)
    v = rng.normal(size=(400, 8))
    if kind == "unit":
        v /= np.linalg.norm(v, axis=1, keepdims=True)
    elif kind == "lengths":
        v *= rng.exponential(size=(400, 1)) * 5
    else:
        v = v[rng.integers(0, 30, 400)]
    whole = np.floor(64 * v).astype(np.int64)
    pack = lambda a, ids: Vectors(ids.astype("<i8").tobytes(), np.full(len(a), 8, "<i4").tobytes(), a.astype("<i4").tobytes())
    ids = rng.permutation(400)
    queries = np.arange(40)
    scores = whole[queries] @ whole.T
    scores[np.arange(40), queries] = np.iinfo(np.int64).min
    for share in (0.02, 0.2, 1.0):
        floors = np.sort(scores, axis=1)[:, -int(400 * share)]
        if share == 1.0:
            floors = np.full(40, np.iinfo(np.int64).min)
        for start in (0.0, 0.7, 2.0):
            met = {}
            got = Block(pack(whole, ids), start).best(pack(whole[queries], ids[queries]), floors, 5, met)
            want = []
            for i in range(40):
                own = sorted((-s, j) for s, j in zip(scores[i].tolist(), ids.tolist()) if s >= floors[i] and j != ids[i])
                want += [(ids[i], j, -s) for s, j in own[:5]]
            assert sorted(zip(*[x.tolist() for x in got])) == sorted(want)
            assert start < 2 or "coordinates" not in met or not met["coordinates"]


def test_near_copies_are_pruned_by_coordinates():
    """Where thresholds are high, coordinates leave few candidates to verify."""
    rng = np.random.default_rng(5)
    centres = rng.normal(size=(100, 16)) * 20
    whole = np.round(np.repeat(centres, 20, axis=0) * 64 + rng.normal(size=(2000, 16)) * 3).astype(np.int64)
    block = Block(Vectors(np.arange(2000).astype("<i8").tobytes(), np.full(2000, 16, "<i4").tobytes(), whole.astype("<i4").tobytes()), 0.85)
    left = [len(block.by_coordinates(block.all.real[i], 0.995)) for i in range(0, 2000, 50)]
    assert 20 <= min(left) and np.mean(left) < 200


def test_against_sql(spark):
    import duckdb

    path = "/root/testdata/sf0.001/embeddings.parquet"
    db = duckdb.connect()
    db.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{path}'")
    want = sorted(db.execute(f"SELECT query_id, rank, vec_id, score FROM ({ORACLE})").fetchall())
    got = top_products(spark.read.parquet(path), QUERY)
    assert sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in got.collect()) == want
