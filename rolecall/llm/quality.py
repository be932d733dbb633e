"""Quality classifier: random-indexing vectors, pooled per document, into a small network.

Words and word shapes are hashed to `ROWS` rows. A row's index vector is sparse, ternary and
fixed by a seed; its word vector is the sum of the index vectors of what stands around it, over
the words of all documents, plus its own index vector. A document is the mean vector of its
words, of their shapes, and of the words that continue a triple seen before in the text. A
two-layer network on these vectors, trained with numpy on a bounded sample of labelled rows,
gives logits; a temperature fitted on rows kept out of training makes them probabilities.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F

from rolecall.llm.common import texts_of

ROWS = 1 << 13
WIDTH = 48
NONZERO = 4
REACH = (-2, -1, 1, 2)
SLICE = 256  # rows of the vector table that travel together
KNOWN_WORDS = 300_000  # bounds a task's table of words it has seen

_RUNS = [
    (re.compile(rb"[a-z\x80-\xff]+"), b"a"),
    (re.compile(rb"[A-Z]+"), b"A"),
    (re.compile(rb"[0-9]+"), b"9"),
]
_REPEATED = re.compile(rb"(.)\1+")


def shape(word: bytes) -> bytes:
    for run, mark in _RUNS:
        word = run.sub(mark, word)
    return b"\0" + _REPEATED.sub(rb"\1", word)[:8]


class Encoder:
    """Rows of a text's words and of their shapes."""

    def __init__(self):
        self.known: dict[bytes, int] = {}

    def __call__(self, text: bytes) -> tuple[np.ndarray, np.ndarray]:
        words = text.split()
        known = self.known
        for w in set(words).difference(known):
            known[w] = zlib.crc32(w) % ROWS * ROWS + zlib.crc32(shape(w)) % ROWS
        both = np.fromiter(map(known.__getitem__, words), np.int64, len(words))
        if len(known) > KNOWN_WORDS:
            known.clear()
        return both // ROWS, both % ROWS


def index_vectors() -> tuple[np.ndarray, np.ndarray]:
    """Places and signs of the nonzero entries of every row's index vector."""
    rng = np.random.default_rng(7)
    places = np.argsort(rng.random((ROWS, WIDTH)), axis=1)[:, :NONZERO]
    return places, rng.choice([-1.0, 1.0], (ROWS, NONZERO))


def _add_contexts(total: np.ndarray, rows: np.ndarray, shapes: np.ndarray, places: np.ndarray, signs: np.ndarray) -> None:
    """Add the index vectors of every word's surroundings to its row and to its shape's row."""
    for away in REACH:
        here, there = (slice(away, None), slice(None, -away)) if away > 0 else (slice(None, away), slice(-away, None))
        near, word, form = rows[there], rows[here], shapes[here]
        both = (near < ROWS) & (word < ROWS)
        near, word, form = near[both], word[both], form[both]
        for k in range(NONZERO):
            place, sign = places[near, k], signs[near, k]
            total += np.bincount(word * WIDTH + place, sign, ROWS * WIDTH)
            total += np.bincount(form * WIDTH + place, sign, ROWS * WIDTH)


def _sum_slices(parts: DataFrame, keys: list[str]) -> DataFrame:
    """Sum the float64 vectors of rows that share the keys; memory holds one slice."""
    ordered = parts.repartition(*keys).sortWithinPartitions(*keys)

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, total = None, None

        def row() -> pa.RecordBatch:
            columns = [pa.array([v], pa.int32()) for v in key]
            return pa.RecordBatch.from_arrays([*columns, pa.array([total.tobytes()], pa.binary())], [*keys, "vectors"])

        for batch in batches:
            for *now, vectors in zip(*[batch.column(c).to_pylist() for c in [*keys, "vectors"]]):
                if now != key:
                    if key is not None:
                        yield row()
                    key, total = now, np.zeros(len(vectors) // 8)
                total += np.frombuffer(vectors)
        if key is not None:
            yield row()

    names = ", ".join(f"{k} int" for k in keys)
    return ordered.select(*keys, "vectors").mapInArrow(work, f"{names}, vectors binary")


def word_vectors(docs: DataFrame) -> np.ndarray:
    """Vectors of all rows from all documents. The result has `ROWS` times `WIDTH` numbers."""

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, (places, signs) = Encoder(), index_vectors()
        total = np.zeros(ROWS * WIDTH)
        gap = max(REACH)
        for batch in batches:
            texts = texts_of(batch, "text")
            for i in range(0, len(texts), 1000):
                # Texts are laid end to end; a row that points nowhere keeps them apart.
                rows, shapes = zip(*[encode(t) for t in texts[i : i + 1000]])
                apart = np.full(gap, ROWS)
                both = [np.concatenate([x for r in of for x in (r, apart)]) for of in (rows, shapes)]
                _add_contexts(total, *both, places, signs)
        own = TaskContext.get().partitionId() % 64
        slices = total.reshape(-1, SLICE * WIDTH)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(np.arange(len(slices), dtype=np.int32)),
                pa.array(np.full(len(slices), own, np.int32)),
                pa.array([s.tobytes() for s in slices], pa.binary()),
            ],
            ["slice", "part", "vectors"],
        )

    parts = _texts(docs).select("text").mapInArrow(work, "slice int, part int, vectors binary")
    sums = _sum_slices(_sum_slices(parts, ["slice", "part"]), ["slice"]).collect()
    total = np.zeros((ROWS, WIDTH))
    for row in sums:
        total[row["slice"] * SLICE : (row["slice"] + 1) * SLICE] = np.frombuffer(row["vectors"]).reshape(-1, WIDTH)
    length = np.linalg.norm(total, axis=1, keepdims=True)
    total = total / np.maximum(length, 1e-9)
    places, signs = index_vectors()
    np.put_along_axis(total, places, np.take_along_axis(total, places, 1) + signs / NONZERO**0.5, 1)
    return total.astype(np.float32)


def pooled(text: bytes, encode: Encoder, vectors: np.ndarray) -> np.ndarray:
    """Mean vectors of words, shapes and continued triples, and the share of the last."""
    rows, shapes = encode(text)
    n = len(rows)
    out = np.zeros(3 * WIDTH + 1, np.float32)
    if not n:
        return out
    for i, of in enumerate((rows, shapes)):
        used, count = np.unique(of, return_counts=True)
        out[i * WIDTH : (i + 1) * WIDTH] = count @ vectors[used] / n
    if n > 3:
        triples = (rows[:-2] * ROWS + rows[1:-1]) * ROWS + rows[2:]
        _, first = np.unique(triples, return_index=True)
        again = np.ones(n - 2, bool)
        again[first] = False
        if again.any():
            used, count = np.unique(rows[2:][again], return_counts=True)
            out[2 * WIDTH : 3 * WIDTH] = count @ vectors[used] / n
            out[-1] = again.sum() / n
    return out


@dataclass
class Network:
    """Two layers over standardised vectors, and the temperature of their logits."""

    centre: np.ndarray
    scale: np.ndarray
    w1: np.ndarray
    b1: np.ndarray
    w2: np.ndarray
    b2: float
    temperature: float = 1.0

    def logits(self, x: np.ndarray) -> np.ndarray:
        hidden = np.maximum((x - self.centre) / self.scale @ self.w1 + self.b1, 0)
        return hidden @ self.w2 + self.b2

    def probability(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logits(x) / self.temperature, -40, 40)))


def _loss(logits: np.ndarray, y: np.ndarray) -> float:
    return float(np.mean(np.logaddexp(0, logits) - y * logits)) if len(y) else 0.0


def fit(x: np.ndarray, y: np.ndarray, hidden: int = 32, epochs: int = 30, seed: int = 5) -> Network:
    """Adam on cross-entropy; a fifth of the rows chooses the epoch and the temperature."""
    rng = np.random.default_rng(seed)
    width = x.shape[1] if x.size else 3 * WIDTH + 1
    centre, scale = (x.mean(0), x.std(0) + 1e-3) if len(x) else (np.zeros(width), np.ones(width))
    prior = (y.sum() + 0.5) / (len(y) + 1)
    net = Network(
        centre, scale, rng.normal(0, width**-0.5, (width, hidden)), np.zeros(hidden), np.zeros(hidden), float(np.log(prior / (1 - prior)))
    )
    if len(np.unique(y)) < 2 or len(y) < 10:
        return net  # nothing to tell apart: the share of good rows for all
    net.w2 = rng.normal(0, hidden**-0.5, hidden)
    order = rng.permutation(len(y))
    test, train = order[: len(y) // 5], order[len(y) // 5 :]
    z = (x - centre) / scale
    names = ["w1", "b1", "w2", "b2"]
    first = {n: 0.0 for n in names}
    second = {n: 0.0 for n in names}
    best, step = (np.inf, None), 0
    for _ in range(epochs):
        order = rng.permutation(train)
        for i in range(0, len(order), 128):
            rows = order[i : i + 128]
            a = z[rows] @ net.w1 + net.b1
            h = np.maximum(a, 0)
            error = (1 / (1 + np.exp(-np.clip(h @ net.w2 + net.b2, -40, 40))) - y[rows]) / len(rows)
            back = np.outer(error, net.w2) * (a > 0)
            grads = {"w1": z[rows].T @ back + 1e-4 * net.w1, "b1": back.sum(0), "w2": h.T @ error + 1e-4 * net.w2, "b2": error.sum()}
            step += 1
            for n in names:
                first[n] = 0.9 * first[n] + 0.1 * grads[n]
                second[n] = 0.999 * second[n] + 0.001 * grads[n] ** 2
                change = first[n] / (1 - 0.9**step) / (np.sqrt(second[n] / (1 - 0.999**step)) + 1e-8)
                setattr(net, n, getattr(net, n) - 3e-3 * change)
        loss = _loss(net.logits(x[test]), y[test])
        if loss < best[0]:
            best = (loss, {n: np.copy(getattr(net, n)) for n in names})
    for n in names:
        setattr(net, n, best[1][n])
    net.b2 = float(net.b2)
    logits = net.logits(x[test])
    net.temperature = min(np.geomspace(0.3, 10, 60), key=lambda t: _loss(logits / t, y[test]))
    return net


@dataclass
class Model:
    vectors: np.ndarray
    network: Network


def _texts(docs: DataFrame) -> DataFrame:
    return docs.withColumn("text", F.col("text").cast("string"))


def held_out(doc_id: Column, folds: int = 4, fold: int = 2) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % folds == fold, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, max_labels: int = 20_000) -> Model:
    """Fit on labels outside the held-out fold, at most `max_labels` of them (the smallest
    hashes of doc_id). A doc_id with several labels counts as good if half of them are. NULL
    and empty texts have a zero vector; NULL labels and ids without a document teach nothing;
    repeated documents count each; without two kinds of labels the model is constant."""
    spark = docs.sparkSession
    vectors = word_vectors(docs)
    shared = spark.sparkContext.broadcast(vectors)

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = Encoder()
        for batch in batches:
            found = [pooled(t, encode, shared.value).tobytes() for t in texts_of(batch, "text")]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("good"), pa.array(found, pa.binary())], ["doc_id", "good", "x"]
            )

    some = (
        labels.filter(F.col("doc_id").isNotNull() & F.col("quality").isNotNull() & ~held_out(F.col("doc_id")))
        .groupBy(F.col("doc_id").cast("long").alias("doc_id"))
        .agg((F.avg("quality") >= 0.5).cast("int").alias("good"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(max_labels)
    )
    # The limit bounds the broadcast.
    rows = _texts(docs).select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(F.broadcast(some), "doc_id")
    features = rows.mapInArrow(work, "doc_id long, good int, x binary")
    # One vector for each label, also where rows repeat.
    chosen = features.groupBy("doc_id").agg(F.min("good").alias("good"), F.min("x").alias("x")).toArrow()
    chosen = chosen.sort_by("doc_id")
    x = np.array([np.frombuffer(b, np.float32) for b in chosen.column("x").to_pylist()], np.float64)
    return Model(vectors, fit(x, chosen.column("good").to_numpy().astype(np.float64)))


def score(docs: DataFrame, model: Model, name: str = "score") -> DataFrame:
    """`docs` with the probability of good quality as column `name`. Only `text` is looked at.

    An empty or NULL text has a score too. Repeated rows get one each.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = Encoder()
        for batch in batches:
            if not batch.num_rows:
                continue
            x = np.array([pooled(t, encode, shared.value.vectors) for t in texts_of(batch, "text")])
            own = pa.array(shared.value.network.probability(x.astype(np.float64)), pa.float64())
            yield pa.RecordBatch.from_arrays([*batch.columns, own], [*batch.schema.names, name])

    rows = _texts(docs)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema)
    return rows.mapInArrow(work, f"{schema}, `{name}` double")


def classify(docs: DataFrame, labels: DataFrame, threshold: float = 0.7, max_labels: int = 20_000) -> DataFrame:
    """doc_id, held_out, score and predicted of every row of `docs` (doc_id, text).

    Trained on `labels` (doc_id, quality) outside the held-out fold. Without two kinds of
    labels the score is their share, one half without any. A NULL doc_id is not held out. No
    rows give none. Other columns are not read.
    """
    model = train(docs, labels, max_labels)
    rows = score(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), model)
    return rows.select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted")
    )
