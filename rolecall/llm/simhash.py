"""SimHash near-duplicates, found with BK-trees.

Fingerprints are computed where the texts lie. Distinct fingerprints are dealt into shards
by pigeonhole: with `distance + 2` blocks of bits, fingerprints that differ in at most
`distance` bits agree on at least two whole blocks, so each goes to one shard for every pair
of blocks, and only the shards that can hold a neighbour are searched. A shard becomes a
BK-tree whose children are keyed by their Hamming distance to the parent; a search follows
only the edges within the radius. A shard of more than `tree_size` fingerprints is split:
every two of its parts become a tree of their own, so no task holds more than two parts.

Shards give spanning links, not all pairs, and components grow from these in Spark.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from rolecall.llm.common import free, groups, texts_of, written
from rolecall.llm.components import components

BITS = 64
SEED = 42
BLOCK = 1 << 18  # shingles whose bits are counted at once


def fingerprint(text: bytes, shingle: int, digest: Callable[..., int]) -> int:
    """Signed 64-bit fingerprint; zero without words."""
    words = text.lower().split()  # of bytes: A-Z only, at ASCII white space only
    if not words:
        return 0
    n = max(1, len(words) - shingle + 1)
    ones = np.zeros(BITS, np.int64)
    for at in range(0, n, BLOCK):
        count = min(BLOCK, n - at)
        parts = zip(*[words[at + i : at + i + count] for i in range(min(shingle, len(words)))])
        hashes = np.fromiter((digest(b" ".join(p), SEED) for p in parts), "<u8", count)
        bits = np.unpackbits(hashes.view(np.uint8), bitorder="little").reshape(-1, BITS)
        ones += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > n, bitorder="little").view("<i8")[0])


def fingerprints(docs: DataFrame, shingle: int = 3) -> DataFrame:
    """doc_id, text_key (a hash of the text) and fingerprint (long) of every row."""

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from xxhash import xxh64_intdigest

        for batch in batches:
            prints = [fingerprint(t, shingle, xxh64_intdigest) for t in texts_of(batch, "text")]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("text_key"), pa.array(prints, pa.int64())],
                ["doc_id", "text_key", "fingerprint"],
            )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), _key(docs).alias("text_key"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(work, "doc_id long, text_key long, fingerprint long")


def _key(docs: DataFrame) -> Column:
    return F.xxhash64(F.coalesce(docs["text"].cast("string"), F.lit("")))


class BKTree:
    """Hamming-distance tree over distinct values; children keyed by distance to the parent."""

    def __init__(self, values: Iterable[int]):
        self.values: list[int] = []
        self.children: list[dict[int, int]] = []
        for value in values:
            self.insert(value)

    def insert(self, value: int) -> None:
        new = len(self.values)
        self.values.append(value)
        self.children.append({})
        if not new:
            return
        node = 0
        while True:
            edge = (value ^ self.values[node]).bit_count()
            below = self.children[node].setdefault(edge, new)
            if below == new:
                return
            node = below

    def search(self, queries: np.ndarray, radius: int) -> Iterator[tuple[int, np.ndarray]]:
        """(node, indices of the queries within `radius` of it). All queries go down the
        tree together; each follows only the edges within `radius` of its own distance."""
        stack = [(0, np.arange(len(queries)))] if self.values else []
        while stack:
            node, active = stack.pop()
            away = np.bitwise_count(queries[active] ^ np.uint64(self.values[node])).astype(np.int16)
            yield node, active[away <= radius]
            for edge, child in self.children[node].items():
                below = active[np.abs(away - edge) <= radius]
                if below.size:
                    stack.append((child, below))


def spanning_links(values: list[int], radius: int) -> list[tuple[int, int]]:
    """Links that join all values reachable from each other by steps of at most `radius`."""
    if len(values) == 2:
        return [(values[0], values[1])] if (values[0] ^ values[1]).bit_count() <= radius else []
    queries = np.array(values, np.uint64)
    label = np.arange(len(values))
    links = []
    for node, hits in BKTree(values).search(queries, radius):
        for other, first in zip(*np.unique(label[hits], return_index=True)):
            if other != label[node]:
                links.append((values[node], values[int(hits[first])]))
                label[label == other] = label[node]
    return links


def linked(prints: DataFrame, distance: int = 3, tree_size: int = 2048) -> DataFrame:
    """Spanning links (`a`, `b`) between distinct fingerprints (column `fingerprint`)."""
    blocks = distance + 2
    edges = [round(i * BITS / blocks) for i in range(blocks + 1)]
    masks = [sum(1 << b for b in range(lo, hi)) for lo, hi in zip(edges, edges[1:])]
    shards = []
    for n, (i, j) in enumerate(combinations(range(blocks), 2)):
        mask = masks[i] | masks[j]
        mask -= (mask >> 63) << 64  # as a signed long
        shards.append(F.struct(F.lit(n).alias("pair"), F.col("fingerprint").bitwiseAND(F.lit(mask)).alias("bits")))
    keyed = prints.select("fingerprint", F.explode(F.array(*shards)).alias("shard")).select("fingerprint", "shard.*")
    sizes = keyed.groupBy("pair", "bits").agg(F.count("*").alias("size")).filter("size > 1")
    parts = F.ceil(F.col("size") / tree_size).cast("int")
    own = F.pmod(F.xxhash64("fingerprint"), F.col("parts")).cast("int")
    dealt = (
        keyed.join(sizes, ["pair", "bits"])
        .withColumn("parts", parts)
        .withColumn("own", own)
        .withColumn("other", F.explode(F.expr("filter(sequence(0, parts - 1), o -> parts = 1 OR o != own)")))
        .select(
            "pair", "bits", "fingerprint",
            F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"),
        )
    )
    keys = ["pair", "bits", "low", "high"]

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: set[tuple[int, int]] = set()

        def rows() -> pa.RecordBatch:
            signed = np.array(list(found), np.uint64).reshape(-1, 2).view(np.int64)
            found.clear()
            return pa.RecordBatch.from_arrays([pa.array(signed[:, 0]), pa.array(signed[:, 1])], ["a", "b"])

        for group in groups(batches, keys):
            values = group.column("fingerprint").to_numpy().astype(np.int64).view(np.uint64).tolist()
            found.update(spanning_links(values, distance))
            if len(found) > 100_000:
                yield rows()
        yield rows()

    ordered = dealt.repartition(*keys).sortWithinPartitions(*keys, "fingerprint")
    return ordered.mapInArrow(work, "a long, b long")


def _grouped(docs: DataFrame, shingle: int, distance: int) -> tuple[DataFrame, DataFrame]:
    """Fingerprints of all rows, and (`fingerprint`, `first_id`, `root`) of each fingerprint."""
    prints = written(fingerprints(docs, shingle))
    distinct = written(prints.groupBy("fingerprint").agg(F.min("doc_id").alias("first_id")))
    roots = components(linked(distinct, distance))
    named = distinct.join(roots, distinct["fingerprint"] == roots["node"], "left").select(
        "fingerprint", "first_id", F.coalesce("root", "fingerprint").alias("root")
    )
    return prints, written(named)


def near_duplicates(docs: DataFrame, shingle: int = 3, distance: int = 3) -> DataFrame:
    """doc_id, fingerprint (long), component_id (smallest doc_id reachable) of every row.

    NULL text counts as empty; rows without words have fingerprint zero and link like any
    other. Repeated rows stay. NULL doc_ids take part, and never name a component that has
    another id; a component of NULL ids alone is NULL. No rows give none. Other columns are
    not read.
    """
    prints, named = _grouped(docs, shingle, distance)
    first = named.groupBy("root").agg(F.min("first_id").alias("component_id"))
    ids = named.join(first, "root").select("fingerprint", "component_id")
    return prints.join(ids, "fingerprint").select("doc_id", "fingerprint", "component_id")


def keep_first(docs: DataFrame, shingle: int = 3, distance: int = 3) -> DataFrame:
    """One row of each component of `near_duplicates`, with all columns of `docs`.

    It is the one of the smallest doc_id; of rows that share it, that of the smallest text
    hash; of rows with that text, any one. NULL ids count as the largest.
    """
    prints, named = _grouped(docs, shingle, distance)
    doc, key, text = (free(docs, n) for n in ("_doc", "_key", "_text"))
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_key")
    first = prints.groupBy("fingerprint").agg(F.min(order).alias("row")).join(named, "fingerprint")
    first = first.groupBy("root").agg(F.min("row").alias("row")).select(
        F.col("row.doc_id").alias(doc), F.col("row.text_key").alias(text)
    )
    same = F.col("doc_id").cast("long").eqNullSafe(F.col(doc)) & (F.col(key) == F.col(text))
    kept = docs.withColumn(key, _key(docs)).join(first, same, "left_semi")
    return kept.dropDuplicates(["doc_id", key]).drop(key)
