"""Importance resampling of documents towards a target set.

An untrained tokenizers Split by a regular expression cuts ASCII-lowered texts into words with
offsets. Windows over neighbouring offset pairs are the features (runs of one or two words);
each falls into a bucket by its CRC-32. Histograms of the documents' and the target's buckets
give a gain for each bucket, and a document's weight is the mean gain of its features. A seeded
Gumbel draw on top makes the highest scores a sample by importance.

Words hold no space, so texts are cut at spaces first and each distinct stretch is split once.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import lru_cache
from zlib import crc32

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

from rolecall.llm.chunks import Chunks, Grown, gather, sliced, split
from rolecall.llm.common import written

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_SPACE_CRC = crc32(b" ")
FEATURES = "doc_id long, n_words long, n_features long, buckets binary"


def _shift_tables(most: int = 64) -> np.ndarray:
    """tables[n, k, b]: what byte k = b of a CRC becomes as n more bytes follow.

    A CRC is linear: that of x + y is the shifted CRC of x, xor that of y.
    """
    tables = np.zeros((most + 1, 4, 256), np.uint32)
    one = np.array([[b << 8 * k for b in range(256)] for k in range(4)], np.uint32)
    byte = np.array([crc32(bytes([b])) ^ crc32(b"\0") for b in range(256)], np.uint32)  # CRC table, up to a constant
    tables[0] = one
    for n in range(most):
        x = tables[n]
        tables[n + 1] = (x >> np.uint32(8)) ^ byte[x & np.uint32(255)]
    return tables


_SHIFT = _shift_tables()


def joined_crc(first: np.ndarray, second: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """CRC-32 of two joined strings, from theirs and the second's length in bytes."""
    out, rest = first, lengths
    while True:
        step = np.minimum(rest, len(_SHIFT) - 1)
        out = (
            _SHIFT[step, 0, out & np.uint32(255)] ^ _SHIFT[step, 1, out >> np.uint32(8) & np.uint32(255)]
            ^ _SHIFT[step, 2, out >> np.uint32(16) & np.uint32(255)] ^ _SHIFT[step, 3, out >> np.uint32(24)]
        )
        rest = rest - step
        if not rest.any():
            return out ^ second


class Words(Chunks):
    """CRC-32 and byte length of the words of chunks, chunk after chunk."""

    def __init__(self, pattern: str = WORD, limit: int = 48_000_000):
        from tokenizers import Regex
        from tokenizers.pre_tokenizers import Split

        self.split = Split(Regex(pattern), "removed", invert=True)
        super().__init__(limit)

    def clear(self) -> None:
        super().clear()
        self.crcs, self.lengths = Grown(np.uint32), Grown(np.int64)
        self.starts, self.counts = Grown(np.int64), Grown(np.int64)

    def words(self, text: str) -> list[tuple[int, int]]:
        """Offsets of the words of a text."""
        return [span for _, span in self.split.pre_tokenize_str(text)]

    def learn(self, chunks: list[str]) -> None:
        text = " ".join(chunks)
        spans = np.array(self.words(text), np.int64).reshape(-1, 2)
        ends = np.cumsum([len(c) + 1 for c in chunks])
        words = [text[i:j].encode() for i, j in spans.tolist()]
        last = np.searchsorted(spans[:, 0], ends)
        self.starts.add(np.concatenate([[0], last[:-1]]) + self.crcs.size)
        self.counts.add(np.diff(last, prepend=0))
        self.crcs.add(np.array(list(map(crc32, words)), np.uint32))
        self.lengths.add(np.array(list(map(len, words)), np.int64))

    def features(self, texts: pa.Array, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(n_words, bounds, bucket of each feature) of texts; the order within one is free."""
        bounds, index, chunks = split(pc.ascii_lower(texts))
        place = self.places(chunks.to_pylist())[index]
        counts = self.counts.values[place]
        at = gather(self.starts.values[place], counts)
        words = np.concatenate([[0], np.cumsum(counts)])[bounds]
        crcs, lengths = self.crcs.values[at], self.lengths.values[at]
        doc = np.repeat(np.arange(len(bounds) - 1), np.diff(words))
        # Windows of two neighbours: the second with the space before it.
        two = np.flatnonzero(doc[1:] == doc[:-1])
        spaced = joined_crc(np.full(len(two), _SPACE_CRC, np.uint32), crcs[two + 1], lengths[two + 1])
        pairs = joined_crc(crcs[two], spaced, lengths[two + 1] + 1)
        order = np.argsort(np.concatenate([doc, doc[two]]), kind="stable")
        n_words = np.diff(words)
        found = (np.concatenate([crcs, pairs]) % np.uint32(buckets))[order]
        return n_words, np.concatenate([[0], np.cumsum(n_words + np.maximum(n_words - 1, 0))]), found


@lru_cache(maxsize=1)
def word_cache() -> Words:
    """The cache of a Python worker, which serves one task after the other."""
    return Words()


def features(docs: DataFrame, name: str = "doc_id", buckets: int = 10_000) -> DataFrame:
    """doc_id, n_words, n_features and the features' buckets, sorted and packed, of each row."""

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = word_cache()
        for batch in batches:
            for part in sliced(batch, "text"):
                n_words, bounds, found = words.features(part.column("text"), buckets)
                at, kind = bounds.tolist(), "<u2" if buckets <= 1 << 16 else "<u4"
                packed = [np.sort(found[i:j]).astype(kind).tobytes() for i, j in zip(at, at[1:])]
                columns = [part.column("doc_id"), pa.array(n_words), pa.array(np.diff(bounds)), pa.array(packed, pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, [f.split()[0] for f in FEATURES.split(", ")])

    rows = docs.select(F.col(name).cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(work, FEATURES)


def _unpacked(batch: pa.RecordBatch, buckets: int) -> np.ndarray:
    kind = "<u2" if buckets <= 1 << 16 else "<u4"
    return np.frombuffer(b"".join(batch.column("buckets").to_pylist()), kind)


def histogram(found: DataFrame, buckets: int) -> np.ndarray:
    """How many features fall into each bucket, over all rows. Tasks add up their own first."""

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            total += np.bincount(_unpacked(batch, buckets), minlength=buckets)
        own = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(own), pa.array(total[own])], ["bucket", "n"])

    rows = found.select("buckets").mapInArrow(work, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    out = np.zeros(buckets, np.int64)
    for r in rows.collect():  # one row for each bucket
        out[r.bucket] = r.n
    return out


def gains(docs: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 * log of the target's smoothed share over the documents') of each bucket."""
    n = len(docs)
    own, wanted = docs.sum() + n, target.sum() + n
    ratio = (target + 1.0) * float(own) / ((docs + 1.0) * float(wanted))
    return np.floor(1000 * np.log(ratio)).astype(np.int64)


def weigh(found: DataFrame, gain: np.ndarray) -> DataFrame:
    """doc_id, n_words, n_features, weight: the floored mean of the gains of the features."""
    shared = found.sparkSession.sparkContext.broadcast(gain)

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.column("n_features").to_numpy()
            run = np.concatenate([[0], np.cumsum(shared.value[_unpacked(batch, len(shared.value))])])
            ends = np.cumsum(n)
            weight = np.floor_divide(run[ends] - run[ends - n], np.maximum(n, 1))
            columns = [*[batch.column(c) for c in ("doc_id", "n_words", "n_features")], pa.array(weight)]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_words", "n_features", "weight"])

    return found.mapInArrow(work, "doc_id long, n_words long, n_features long, weight long")


def gumbel(doc_id: Column, seed: int) -> Column:
    """floor(1000 * a Gumbel value) that follows from the seed and the id."""
    drawn = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), doc_id.cast("string")), 256), 1, 8), 16, 10).cast("double")
    return F.floor(F.lit(-1000.0) * F.log(-F.log((drawn + 0.5) / 4294967296.0))).cast("long")


def ranked(rows: DataFrame, share: int) -> DataFrame:
    """`rank` (1, 2, 3 ...) by score, then doc_id, of the best `share` percent of rows, else NULL.

    Rows are laid out by ranges of the whole order, so a rank is a row's place in its range
    plus the sizes of the ranges before; no task holds more than a range, whatever the ties.
    """
    tie = F.monotonically_increasing_id()  # only tells equal rows apart
    order = [F.col("score").desc(), F.col("doc_id"), F.col("_tie")]
    laid = rows.withColumn("_tie", tie).repartitionByRange(*order).sortWithinPartitions(*order).drop("_tie")
    place = F.monotonically_increasing_id()
    laid = written(laid.withColumn("range", F.shiftright(place, 33)).withColumn("place", place.bitwiseAND(F.lit((1 << 33) - 1))))
    sizes = sorted((r["range"], r["n"]) for r in laid.groupBy("range").agg(F.count("*").alias("n")).collect())
    total, before = 0, []
    for own, n in sizes:  # one row for each range
        before.append((own, total))
        total += n
    starts = rows.sparkSession.createDataFrame(before, "range long, before long")
    rank = F.col("before") + F.col("place") + 1
    out = laid.join(F.broadcast(starts), "range").withColumn("rank", F.when(rank <= share * total // 100, rank))
    return out.drop("range", "place", "before")


def resample(
    docs: DataFrame, target: DataFrame, share: int = 25, least_words: int = 20, buckets: int = 10_000, seed: int = 7
) -> DataFrame:
    """doc_id, n_words, n_features, weight, score, rank for each row of `docs` (doc_id, text).

    `target` (text) is what the sample should look like. Rows of at least `least_words` words
    compete; the best `share` percent of them, rounded down, have a rank, ties going to the
    smaller doc_id, and all others have none. weight is 0 without features. NULL texts have no
    words; a NULL doc_id has no score and never competes; repeated rows compete each. An empty
    target weighs every bucket by the documents alone; no documents give no rows. Other columns are not read.
    """
    found = written(features(docs, buckets=buckets))
    wanted = features(target.select(F.lit(0).alias("doc_id"), "text"), buckets=buckets)
    gain = gains(histogram(found, buckets), histogram(wanted, buckets))
    scored = written(weigh(found, gain).withColumn("score", F.col("weight") + gumbel(F.col("doc_id"), seed)))
    competes = (F.col("n_words") >= least_words) & F.col("score").isNotNull()
    others = scored.filter(~competes).withColumn("rank", F.lit(None).cast("long"))
    return ranked(scored.filter(competes), share).unionByName(others)
