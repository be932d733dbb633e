"""Exact top-k search by inner product, over vectors grouped by length.

Candidates are grouped into buckets of nearly equal length, each dealt into blocks of a bounded
number of vectors. Queries first meet a few blocks (the square root of their number, longest
vectors first), which gives each query a score that its k-th best result reaches at least. Then
they meet the other blocks, but only those of buckets long enough to reach it. That score over
the lengths of query and block is the query's local cosine threshold in the block. From it, the
block's vectors are pruned: by coordinates where the threshold is high, as each coordinate of a
candidate must then lie near the query's, and by length alone where it is low. What is left is
verified by exact integer products.

Queries travel in blocks too, and meet a candidate block one after the other, so a task holds
one candidate block and one batch of queries.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from rolecall.llm.common import groups, written

#: Lengths of a bucket differ by this factor at most; lengths are below 2 ** 31.
STEP = 1.05
MOST = 2.0**62
VECTORS = "id long, vector binary, size int, bucket int"
PAIRED = "bucket int, block int, slice int, turn int, ids binary, sizes binary, vectors binary, floors binary"
RESULT = "query_id long, vec_id long, score long"


def quantised(vector: Column, scale: float) -> Column:
    """floor(scale * x) of each component as doubles; NULL for vectors without part in the search."""
    sound = F.forall(vector.cast("array<double>"), lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) * scale < 2.0**31))
    numbers = F.transform(vector.cast("array<double>"), lambda x: F.floor(x * scale).cast("double"))
    numbers = F.when(F.coalesce(sound, F.lit(False)), numbers)
    return F.when(F.aggregate(numbers, F.lit(0.0), lambda total, x: total + x * x) < MOST, numbers)


def _bucket(squared: np.ndarray) -> np.ndarray:
    """Buckets by length, from the shortest on; -1 for zero vectors."""
    return np.where(squared > 0, np.floor(np.log(np.maximum(squared, 1)) / (2 * math.log(STEP))), -1).astype(np.int32)


def encoded(rows: DataFrame) -> DataFrame:
    """id, vector (packed integers), size (their number), bucket, of the rows that take part."""

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("vector")
            values = lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
            sizes = np.diff(lists.offsets.to_numpy()).astype(np.int32)
            ends = np.cumsum(sizes, dtype=np.int64)
            squares = np.array([float(np.dot(v, v)) for v in np.split(values, ends[:-1])]) if len(sizes) else np.zeros(0)
            whole = values.astype("<i4")
            at = [0, *ends.tolist()]
            packed = pa.array([whole[i:j].tobytes() for i, j in zip(at, at[1:])], pa.binary())
            columns = [batch.column("id"), packed, pa.array(sizes), pa.array(_bucket(squares))]
            yield pa.RecordBatch.from_arrays(columns, ["id", "vector", "size", "bucket"])

    return rows.select("id", "vector").mapInArrow(work, VECTORS)


class Vectors:
    """Some vectors in a matrix; shorter ones end in zeros. Integers below 2 ** 31."""

    def __init__(self, ids: bytes, sizes: bytes, vectors: bytes):
        self.ids = np.frombuffer(ids, "<i8")
        sizes = np.frombuffer(sizes, "<i4").astype(np.int64)
        flat = np.frombuffer(vectors, "<i4")
        self.whole = np.zeros((len(sizes), int(sizes.max(initial=0))), np.int64)
        ends = np.cumsum(sizes)
        within = np.arange(len(flat)) - np.repeat(ends - sizes, sizes)
        self.whole[np.repeat(np.arange(len(sizes)), sizes), within] = flat
        self.lengths = np.sqrt((self.whole.astype(np.float64) ** 2).sum(axis=1))
        self.real = self.whole.astype(np.float64)

    def wide(self, width: int) -> Vectors:
        if width > self.whole.shape[1]:
            more = ((0, 0), (0, width - self.whole.shape[1]))
            self.whole, self.real = np.pad(self.whole, more), np.pad(self.real, more)
        return self


def products(a: Vectors, rows, b: Vectors, columns) -> np.ndarray:
    """Exact inner products, as integers."""
    longest = a.lengths.max(initial=0) * b.lengths.max(initial=0)
    if longest < 2.0**52:  # every partial sum is an exact double
        return (a.real[rows] @ b.real[columns].T).astype(np.int64)
    return a.whole[rows] @ b.whole[columns].T


class Block:
    """Candidates of one length bucket, longest first."""

    def __init__(self, vectors: Vectors, coordinate_from: float):
        order = np.lexsort((vectors.ids, -vectors.lengths))
        vectors.ids, vectors.lengths = vectors.ids[order], vectors.lengths[order]
        vectors.whole, vectors.real = vectors.whole[order], vectors.real[order]
        self.all, self.coordinate_from = vectors, coordinate_from
        self.sorted: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def coordinate(self, f: int) -> tuple[np.ndarray, np.ndarray]:
        """(values, places) of one coordinate of the candidates at length 1, sorted."""
        if f not in self.sorted:
            values = self.all.real[:, f] / np.maximum(self.all.lengths, 1e-300)
            order = np.argsort(values)
            self.sorted[f] = values[order], order
        return self.sorted[f]

    def by_coordinates(self, query: np.ndarray, cosine: float, focus: int = 4) -> np.ndarray:
        """Candidates that may have that cosine: those near the query in its largest coordinates.

        With unit vectors p and q, the rest of both is at most sqrt(1-p_f^2) and sqrt(1-q_f^2) long, so
        p_f must lie within sqrt(1-cosine^2) * sqrt(1-q_f^2) of q_f * cosine.
        """
        slack = 1e-9  # rounding only ever adds candidates
        unit = query / np.sqrt(query @ query)
        left = None
        for f in np.argsort(-np.abs(unit))[:focus].tolist():
            values, places = self.coordinate(f)
            q = unit[f]
            half = math.sqrt(max(0.0, 1 - cosine * cosine)) * math.sqrt(max(0.0, 1 - q * q)) + slack
            # Beyond q itself, a candidate of any larger coordinate may still reach the cosine.
            low, high = q * cosine - half, q * cosine + half
            high = math.inf if q >= cosine else high
            low = -math.inf if -q >= cosine else low
            near = places[np.searchsorted(values, low, "left") : np.searchsorted(values, high, "right")]
            left = near if left is None else np.intersect1d(left, near, assume_unique=True)
        return left if left is not None else np.arange(len(self.all.ids))

    def best(self, queries: Vectors, floors: np.ndarray, k: int, met: dict[str, int] | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(query id, candidate id, score) of the k best candidates of each query, of those whose
        score is its floor or more."""
        width = max(self.all.whole.shape[1], queries.whole.shape[1])
        own, queries = self.all.wide(width), queries.wide(width)
        longest = own.lengths[0] if len(own.lengths) else 0.0
        # Local cosine thresholds. Nothing is pruned by a floor that is not positive.
        reach = queries.lengths * longest
        cosine = np.where((floors > 0) & (reach > 0), floors / np.maximum(reach, 1e-300), -1.0)
        cosine = np.where((floors > 0) & (reach == 0), 2.0, cosine)
        cosine *= 1 - 1e-9
        found = []
        alive = np.flatnonzero(cosine <= 1)
        close = cosine[alive] >= self.coordinate_from
        for i in alive[close].tolist():
            some = np.sort(self.by_coordinates(queries.real[i], cosine[i]))
            found.append(self._top(queries, np.array([i]), own, some, floors, k))
        # By length: candidates are sorted, so a query meets a prefix. Queries of like prefixes go together.
        rest = alive[~close]
        if len(rest):
            least = np.where(floors[rest] > 0, floors[rest] / np.maximum(queries.lengths[rest], 1e-300), -1.0) * (1 - 1e-9)
            upto = np.searchsorted(-own.lengths, -least, "right")
            order = np.argsort(upto, kind="stable")
            for part in np.array_split(order, max(1, len(order) // 128)):
                if len(part):
                    found.append(self._top(queries, rest[part], own, np.arange(upto[part].max()), floors, k))
        if met is not None:
            met["coordinates"] = met.get("coordinates", 0) + int(close.sum())
            met["length"] = met.get("length", 0) + len(rest)
        if not found:
            return (np.zeros(0, np.int64),) * 3
        return tuple(np.concatenate(x) for x in zip(*found))

    def _top(self, queries: Vectors, rows: np.ndarray, own: Vectors, columns: np.ndarray, floors: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        scores = products(queries, rows, own, columns)
        out = own.ids[columns][None, :] == queries.ids[rows][:, None]
        least = np.iinfo(np.int64).min
        scores[out] = least
        bound = np.maximum(floors[rows], least + 1)
        if len(columns) > k:
            bound = np.maximum(bound, np.partition(scores, len(columns) - k, axis=1)[:, len(columns) - k])
        i, j = np.nonzero(scores >= bound[:, None])
        order = np.lexsort((own.ids[columns[j]], -scores[i, j], i))
        i, j = i[order], j[order]
        place = np.arange(len(i)) - np.searchsorted(i, i)
        i, j = i[place < k], j[place < k]
        return queries.ids[rows[i]], own.ids[columns[j]], scores[i, j]


def _blocks(rows: DataFrame, names: list[str]) -> DataFrame:
    """Rows with equal `names` in one row: ids, sizes and vectors one after the other."""
    kinds = "ids binary, sizes binary, vectors binary, floors binary"

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in groups(batches, names):
            parts = [
                table.column("id").to_numpy().astype("<i8").tobytes(), table.column("size").to_numpy().astype("<i4").tobytes(),
                b"".join(table.column("vector").to_pylist()), table.column("floor").to_numpy().astype("<i8").tobytes(),
            ]
            keys = [table.column(n)[0].as_py() for n in names]
            yield pa.RecordBatch.from_pylist([dict(zip([*names, "ids", "sizes", "vectors", "floors"], [*keys, *parts]))], schema=schema)

    schema = pa.schema([*[(n, pa.int32()) for n in names], *[(n, pa.binary()) for n in ("ids", "sizes", "vectors", "floors")]])
    kept = rows.select(*[F.col(n).cast("int").alias(n) for n in names], "id", "size", "vector", F.coalesce("floor", F.lit(-(2**63))).alias("floor"))
    laid = kept.repartition(*names).sortWithinPartitions(*names)
    return laid.mapInArrow(work, ", ".join(f"{n} int" for n in names) + ", " + kinds)


def _met(blocks: DataFrame, queries: DataFrame, k: int, coordinate_from: float) -> DataFrame:
    """The results of each block's meetings: `blocks` and `queries` by (bucket, block, slice)."""

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, block = None, None
        for batch in batches:
            for r in batch.to_pylist():
                key = (r["bucket"], r["block"], r["slice"])
                own = Vectors(r["ids"], r["sizes"], r["vectors"])
                if r["turn"] == 0:  # the block comes before its queries
                    held, block = key, Block(own, coordinate_from)
                elif held == key:
                    columns = block.best(own, np.frombuffer(r["floors"], "<i8"), k)
                    yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["query_id", "vec_id", "score"])

    names = [f.split()[0] for f in PAIRED.split(", ")]
    both = blocks.withColumn("turn", F.lit(0)).select(*names).unionByName(queries.withColumn("turn", F.lit(1)).select(*names))
    keys = ["bucket", "block", "slice"]
    laid = both.repartition(*keys).sortWithinPartitions(*keys, "turn")
    return laid.mapInArrow(work, RESULT)


def _top(results: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return results.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def top_products(
    rows: DataFrame,
    is_query: str,
    k: int = 20,
    scale: float = 64.0,
    block: int = 2_048,
    coordinate_from: float = 0.85,
    slice_blocks: int = 64,
) -> DataFrame:
    """query_id, rank, vec_id, score: the `k` largest inner products of each query row.

    `rows` has vec_id and embedding; every component x counts as floor(scale * x), and a score is
    the integer inner product. Queries are the rows for which `is_query` (SQL over `id`, the vec_id) holds;
    candidates are all rows of another vec_id. Ties go to the smaller vec_id; of fewer than `k`
    candidates all are returned. Vectors that are NULL or hold NULL or non-finite components,
    or are 2 ** 31 long or more, take no part, nor do rows without vec_id. Shorter vectors end in
    zeros, an empty one is zero. Rows that repeat are candidates each, but of query rows with one
    vec_id only one is asked, that of the greatest vector. No rows give none. Other columns are
    not read.
    """
    spark = rows.sparkSession
    given = rows.select(F.col("vec_id").cast("long").alias("id"), quantised(F.col("embedding"), scale).alias("vector"))
    given = given.filter("id IS NOT NULL AND vector IS NOT NULL")
    stored = written(encoded(given))
    asked = written(encoded(given.filter(is_query).groupBy("id").agg(F.max("vector").alias("vector"))))

    # One row for each length bucket: at most some hundred, as lengths are below 2 ** 31.
    counts = sorted(((r.bucket, math.ceil(r.n / block)) for r in stored.groupBy("bucket").agg(F.count("*").alias("n")).collect()), reverse=True)
    n_blocks = sum(n for _, n in counts)
    n_asked = asked.count()
    if not n_blocks or not n_asked:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    dealt = F.broadcast(spark.createDataFrame(counts, "bucket int, blocks int"))
    number = F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.col("blocks"))  # evenly, also rows that repeat
    candidates = stored.join(dealt, "bucket").withColumn("block", number).withColumn("floor", F.lit(None).cast("long"))
    blocks = written(_blocks(candidates, ["bucket", "block"]))

    # The first meetings: some blocks of the longest buckets.
    left, early = math.ceil(math.sqrt(n_blocks)), []
    for bucket, n in counts:
        early.append((bucket, min(n, left)))
        left -= early[-1][1]
    firsts = spark.createDataFrame(early, "bucket int, firsts int")
    blocks = blocks.join(F.broadcast(firsts), "bucket")
    n_slices = math.ceil(math.ceil(n_asked / 512) / slice_blocks)

    def meet(queries: DataFrame, first: bool) -> DataFrame:
        """Queries (with floor and lowest, the lowest bucket that can reach it) and the blocks they visit."""
        part = F.floor(F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)) / 512)
        order = ["lowest", "id"]
        laid = queries.repartitionByRange(max(1, math.ceil(n_asked / (512 * 16))), *order).sortWithinPartitions(*order)
        laid = written(laid.withColumn("range", F.spark_partition_id()).withColumn("part", part))
        sent = _blocks(laid, ["range", "part"])
        lowest = laid.groupBy("range", "part").agg(F.min("lowest").alias("lowest"))
        sent = sent.join(lowest, ["range", "part"]).withColumn("slice", F.pmod(F.hash("range", "part"), F.lit(n_slices)).cast("int"))
        numbers = F.sequence(F.lit(0), F.col("firsts") - 1) if first else F.sequence(F.col("firsts"), F.col("blocks") - 1)
        visits = spark.createDataFrame([(b, n, f) for (b, n), (_, f) in zip(counts, early)], "bucket int, blocks int, firsts int")
        visits = visits.filter("firsts > 0" if first else "firsts < blocks").select("bucket", F.explode(numbers).alias("block"))
        # One row for each block of queries and block of candidates that it has to meet.
        pairs = sent.join(F.broadcast(visits), F.col("bucket") >= F.col("lowest"))
        copies = blocks.filter("block < firsts" if first else "block >= firsts")
        copies = copies.withColumn("slice", F.explode(F.sequence(F.lit(0), F.lit(n_slices - 1))))
        return _met(copies, pairs, k, coordinate_from)

    none = asked.withColumn("floor", F.lit(None).cast("long")).withColumn("lowest", F.lit(-(2**31)))
    first = written(_top(meet(none, True), k))
    floors = first.filter(F.col("rank") == k).select(F.col("query_id").alias("id"), F.col("score").alias("floor"))
    later = asked.join(floors, "id", "left").withColumn("lowest", _lowest(F.col("floor"), F.col("bucket")))
    second = meet(later, False)
    merged = _top(first.drop("rank").unionByName(second), k)
    return merged.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def _lowest(floor: Column, bucket: Column) -> Column:
    """The lowest bucket whose vectors may reach the floor, for a query of that bucket: the
    query is shorter than STEP ** (bucket + 1), and a vector of bucket b than STEP ** (b + 1)."""
    needed = F.floor(F.log(floor.cast("double")) / math.log(STEP) - bucket - 2 - 1e-6).cast("int")
    return F.when(floor > 0, F.when(bucket < 0, F.lit(2**31 - 1)).otherwise(needed)).otherwise(F.lit(-(2**31)))


# Rows whose vec_ids are distinct and whose vectors are sound and of one length.
ORACLE = """
WITH whole AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(64 * CAST(x AS DOUBLE))) AS v FROM embeddings),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.v, c.v) AS BIGINT) AS score
  FROM whole q JOIN whole c ON q.vec_id <> c.vec_id WHERE q.vec_id % 20 = 0),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scored)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM placed WHERE rank <= 20
"""
