"""Repeated passages, with a sparse suffix array.

Of every document's suffixes (at words) only those at minimiser positions are kept: the
smallest of the hashes of `head` words in each stretch of `reach` positions. Any passage of
`head + reach - 1` words that occurs twice holds the same minimiser both times. Suffixes
that share their head are sorted by the words after it; what neighbours have in common cuts
them into runs that share a number of words to the right, and suffixes of one run that also
share the rest of the words to the left are the same passage. So both sides of a match come
from the same other place, and a passage of the full length is found or nothing is.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from rolecall.llm.common import texts_of, whole_groups, written

WORD = 4  # bytes of a word's hash in a suffix
_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))


def word_hashes(text: bytes) -> np.ndarray:
    from xxhash import xxh64_intdigest

    words = text.split()
    return np.fromiter(map(xxh64_intdigest, words), np.uint64, len(words))


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    up = np.cumprod(np.concatenate([[np.uint64(1)], np.full(n, _BASE)]), dtype=np.uint64)
    down = np.cumprod(np.concatenate([[np.uint64(1)], np.full(n, _INVERSE)]), dtype=np.uint64)
    return up, down


class Heads:
    """Hashes of all stretches of `head` words, and which of them are minimisers."""

    def __init__(self, head: int, reach: int):
        self.head, self.reach = head, reach
        self.up, self.down = _powers(1 << 12)

    def hashes(self, words: np.ndarray) -> np.ndarray:
        n = len(words)
        if n >= len(self.up):
            self.up, self.down = _powers(2 * n)
        sums = np.concatenate([[np.uint64(0)], np.cumsum(words * self.up[:n], dtype=np.uint64)])
        return _mixed((sums[self.head :] - sums[: -self.head]) * self.down[: n - self.head + 1])

    def anchors(self, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Positions of the minimisers and their hashes; ties are all kept."""
        if len(words) < self.head + self.reach - 1:
            return np.empty(0, np.int64), np.empty(0, np.uint64)
        own = self.hashes(words)
        least = np.lib.stride_tricks.sliding_window_view(own, self.reach).min(axis=1)
        padded = np.concatenate([np.zeros(self.reach - 1, np.uint64), least, np.zeros(self.reach - 1, np.uint64)])
        most = np.lib.stride_tricks.sliding_window_view(padded, self.reach).max(axis=1)
        at = np.flatnonzero(own == most)
        return at, own[at]


def repeated_sides(heads: np.ndarray, left: np.ndarray, right: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For suffixes sorted by head and `right`: the fewest and the most words to the left with
    which a passage occurs again, so many words to the left and the rest of a side's to the
    right; (1, 0) if there are none. `sizes` has the words there are on each side.
    """
    side = right.shape[1]
    fewest, most = np.full(len(heads), side + 1), np.full(len(heads), -1)
    same = heads[1:] == heads[:-1]
    shared = np.where(same, np.cumprod(right[1:] == right[:-1], axis=1).sum(axis=1), -1)
    before = np.zeros(len(heads), np.uint64)  # hash of the words to the left so far
    for n in range(side + 1):
        run = np.concatenate([[0], np.cumsum(shared < side - n)])
        full = np.flatnonzero((sizes[:, 0] >= n) & (sizes[:, 1] >= side - n))
        key = _mixed(before[full] + run[full].astype(np.uint64) * _BASE)
        order = np.argsort(key)
        equal = np.flatnonzero(key[order][1:] == key[order][:-1])
        again = full[order[np.unique(np.concatenate([equal, equal + 1]))]]
        fewest[again] = np.minimum(fewest[again], n)
        most[again] = n
        if n < side:
            before = _mixed((before + left[:, n].astype(np.uint64)) * _BASE)
    return np.where(most < 0, 1, fewest), np.maximum(most, 0)


def _rows(docs: DataFrame) -> DataFrame:
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text")).withColumn(
        "text_key", F.xxhash64("text")
    )


def repeated_spans(docs: DataFrame, least_words: int = 50, reach: int = 16, largest_run: int = 20_000) -> DataFrame:
    """doc_id, start, n_words, text of every repeated passage of each row of `docs`.

    A passage is a longest stretch of words of which every word lies in a stretch of
    `least_words` words that occurs elsewhere, in another row or in the same one. start counts
    words; `text` is the passage with single spaces. Equal texts repeat each other: each is a
    passage as a whole if it has `least_words` words. NULL texts have none; a NULL
    doc_id stays NULL; no rows give none. Other columns are not read. Equal texts are compared
    once, and told apart from others by a 64-bit hash; the words of a head are compared by 64
    bits in all, those beside it by 32 bits each. Suffixes of a head with more than
    `largest_run` occurrences are compared by counting equal passages, so that no task holds them.
    """
    head, side = least_words - reach + 1, reach - 1
    rows = _rows(docs)

    def find(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        heads = Heads(head, reach)
        for batch in batches:
            keys, ids, places = [], [], []
            for text_key, text in zip(batch.column("text_key").to_numpy(), texts_of(batch, "text")):
                at, own = heads.anchors(word_hashes(text))
                keys.append(own)
                places.append(at)
                ids.append(np.full(len(at), text_key))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.concatenate([np.empty(0, np.uint64), *keys]).view(np.int64)),
                    pa.array(np.concatenate([np.empty(0, np.int64), *ids])),
                    pa.array(np.concatenate([np.empty(0, np.int64), *places]).astype(np.int32)),
                ],
                ["head", "text_key", "at"],
            )

    found = written(rows.select("text_key", "text").mapInArrow(find, "head long, text_key long, at int"))
    # Written, so that adaptive execution can split the other side of the join where a head is hot.
    often = written(found.groupBy("head").agg(F.count("*").alias("n")).filter("n > 1"))
    anchor = F.struct("at", "head", (F.col("n") > largest_run).alias("hot"))
    shared = found.join(often, "head").groupBy("text_key").agg(F.collect_set(anchor).alias("anchors"))
    # Copies meet before the shuffle, so that a text of very many copies is no single task's.
    texts = rows.groupBy("text_key").agg(F.first("text").alias("text"), F.count("*").alias("copies"))
    holding = written(texts.join(shared, "text_key"))

    def suffixes(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple] = []
            for text_key, text, anchors in zip(
                batch.column("text_key").to_pylist(), texts_of(batch, "text"), batch.column("anchors").to_pylist()
            ):
                words = word_hashes(text)
                short = (words >> np.uint64(32)).astype(">u4")
                for a in anchors:
                    at = a["at"]
                    right = short[at + head : at + head + side].tobytes()
                    left = short[max(0, at - side) : at][::-1].tobytes()
                    out.append((a["head"], right, left, text_key, at, a["hot"]))
            columns = zip(*out) if out else [[]] * 6
            types = [pa.int64(), pa.binary(), pa.binary(), pa.int64(), pa.int32(), pa.bool_()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, types)], ["head", "right", "left", "text_key", "at", "hot"]
            )

    schema = "head long, right binary, left binary, text_key long, at int, hot boolean"
    suffix = written(holding.select("text_key", "text", "anchors").mapInArrow(suffixes, schema))

    def table_of(column: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
        """Rows of word hashes, and how many each has; the others are 0."""
        values = column.to_pylist()
        out = np.frombuffer(b"".join(v.ljust(side * WORD, b"\0") for v in values), ">u4").reshape(-1, side)
        return out.astype(np.uint32), np.array([len(v) // WORD for v in values], np.int64)

    def compare(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in whole_groups(batches, ["head"]):
            (right, after), (left, before) = table_of(rows.column("right")), table_of(rows.column("left"))
            fewest, most = repeated_sides(rows.column("head").to_numpy(), left, right, np.stack([before, after], axis=1))
            own, at = np.flatnonzero(most >= fewest), rows.column("at").to_numpy()
            yield pa.RecordBatch.from_arrays(
                [
                    rows.column("text_key").take(pa.array(own)).combine_chunks(),
                    pa.array((at - most)[own].astype(np.int32)),
                    pa.array((at - fewest + least_words)[own].astype(np.int32)),
                ],
                ["text_key", "start", "stop"],
            )

    cold = suffix.filter("NOT hot").select("head", "right", "left", "text_key", "at")
    spans = cold.repartition("head").sortWithinPartitions("head", "right").mapInArrow(compare, "text_key long, start int, stop int")
    # Hot heads: equal sides meet before the shuffle, and every passage around them is counted.
    # Both sides of a join are written, so that adaptive execution can split it where a passage is hot.
    hot = suffix.filter("hot")
    sides = written(hot.groupBy("head", "left", "right").agg(F.count("*").alias("n")))
    each = sides.withColumn("words", F.explode(F.sequence(F.lit(0), F.lit(side)))).filter(
        f"octet_length(left) >= {WORD} * words AND octet_length(right) >= {WORD} * ({side} - words)"
    )
    passage = F.expr(f"xxhash64(substring(left, 1, {WORD} * words), substring(right, 1, {WORD} * ({side} - words)))")
    each = written(each.withColumn("passage", passage))
    twice = written(each.groupBy("head", "words", "passage").agg(F.sum("n").alias("m")).filter("m > 1").drop("m"))
    again = each.join(twice, ["head", "words", "passage"]).groupBy("head", "left", "right")
    again = written(again.agg(F.min("words").alias("fewest"), F.max("words").alias("most")))
    spans = spans.unionByName(
        hot.join(again, ["head", "left", "right"]).select(
            "text_key", (F.col("at") - F.col("most")).alias("start"), (F.col("at") - F.col("fewest") + least_words).alias("stop")
        )
    )
    # A text has at most as many spans as anchors.
    of_text = spans.groupBy("text_key").agg(F.array_sort(F.collect_set(F.struct("start", "stop"))).alias("spans"))

    def merge(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple] = []
            for text_key, text, copies, parts in zip(
                batch.column("text_key").to_pylist(), texts_of(batch, "text"), batch.column("copies").to_pylist(),
                batch.column("spans").to_pylist(),
            ):
                words = text.split()
                merged: list[list[int]] = [[0, len(words)]] if copies > 1 else []
                for p in parts or []:
                    if merged and p["start"] <= merged[-1][1]:
                        merged[-1][1] = max(merged[-1][1], p["stop"])
                    else:
                        merged.append([p["start"], p["stop"]])
                for start, stop in merged:
                    if stop - start >= least_words:
                        out.append((text_key, start, stop - start, b" ".join(words[start:stop]).decode()))
            columns = zip(*out) if out else [[]] * 4
            types = [pa.int64(), pa.int32(), pa.int32(), pa.string()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], ["text_key", "start", "n_words", "text"])

    # A text that repeats in its own copies alone has no spans, and is a passage all the same.
    whole = holding.select("text_key", "text", "copies").join(of_text, "text_key", "left").filter("copies > 1 OR spans IS NOT NULL")
    passages = whole.mapInArrow(merge, "text_key long, start int, n_words int, text string")
    return rows.select("doc_id", "text_key").join(passages, "text_key").select("doc_id", "start", "n_words", "text")
