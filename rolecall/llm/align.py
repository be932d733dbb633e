"""Alignment of two tokenizers' tokens over the same bytes.

Tokenizer A (tokenizers, byte-level) gives character offsets, tokenizer B (sentencepiece) the
spans of its immutable proto. Both are coarse: tokens that split a character share its span.
So spans only say where characters end, and the decoded bytes of the tokens refine what lies
between two such cuts. Bytes where tokens of both end cut them into groups; an A and a B token
are linked if their byte ranges overlap. Neither tokenizer joins what stands before a space
with the space, so each distinct chunk of text is aligned once.

How many documents hold a linked pair of ids is counted over all documents, and each
document's links are then held against these counts.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from itertools import chain
from operator import attrgetter

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from rolecall.llm.chunks import ODD, Chunks, Grown, gather, sliced, split, sums, vocabulary
from rolecall.llm.common import Kept, written

SPACE = "▁"
_BYTE = re.compile("<0x([0-9A-F]{2})>").fullmatch
_BEFORE_SPACES = re.compile(r"(?<=\S)(?= +[^ ])")
_SPAN = attrgetter("id", "begin", "end")
COUNTS = ("n_a", "n_b", "n_groups", "n_links")
ALIGNED = (
    "row long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups string, "
    "pairs binary, times binary"
)


def cut(text: str) -> list[str]:
    """Cut where spaces begin, but not at the end; all but the first come without their first space."""
    first, *others = _BEFORE_SPACES.split(text)
    return [first, *[c[1:] for c in others]]


def byte_ends(starts: np.ndarray, ends: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Byte ends of tokens from coarse spans (in bytes), which may overlap, and decoded lengths.

    Of the tokens that share a character, A's all span it, B's are empty but for the last. So a
    span ends a character, and is right there, if it isn't empty and the next one starts
    behind it. Up to there, tokens lie one after the other from where the first span starts.
    """
    sure = np.append(ends[:-1] <= starts[1:], True) & (starts < ends) if len(ends) else np.zeros(0, bool)
    run = np.cumsum(lengths)
    stretch = np.cumsum(sure) - sure
    first = np.flatnonzero(np.concatenate([[True], sure[:-1]])) if len(ends) else np.zeros(0, np.int64)
    fine = (starts[first] - (run - lengths)[first])[stretch] + run
    return np.where(sure, ends, fine)


def _among(values: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Which values are among the rising `ends`."""
    if not len(ends):
        return np.zeros(len(values), bool)
    return ends[np.minimum(np.searchsorted(ends, values), len(ends) - 1)] == values


class Aligner(Chunks):
    """Alignments of chunks, each with a space in front of it.

    `sizes` holds n_a, n_b, n_groups, n_links and whether the tokens' bytes are other than the
    chunk's; `groups` the text of the groups, each with a `;` behind it; `pairs` the linked
    pairs of ids, as A * (number of B ids) + B, once for each link.
    """

    def __init__(self, file_a: str, file_b: str, limit: int = 34_000_000):
        from sentencepiece import SentencePieceProcessor
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(file_a)
        self.a.encode_special_tokens = True  # their names in a text are plain text
        self.a.model._resize_cache(0)  # of no use for chunks that come once
        self.b = SentencePieceProcessor(model_file=file_b)
        self.bytes_a, self.bytes_b = vocabulary(self.a), []
        self.n_b = self.b.get_piece_size()
        for i in range(self.n_b):
            piece = self.b.id_to_piece(i)
            byte = _BYTE(piece)
            self.bytes_b.append(bytes([int(byte[1], 16)]) if byte else piece.replace(SPACE, " ").encode())
            if SPACE in piece.lstrip(SPACE):
                raise ValueError(f"tokenizer B joins words with the space behind them: {piece!r}")
        self.lengths_a, self.lengths_b = (np.array([len(x) for x in t], np.int64) for t in (self.bytes_a, self.bytes_b))
        super().__init__(limit)

    def clear(self) -> None:
        super().clear()
        self.sizes = [Grown(np.int64) for _ in range(5)]
        self.groups: list[str] = []
        self.pairs, self.starts = Grown(np.int64), Grown(np.int64)
        self.used = np.zeros(0, np.int64)  # how often each chunk was asked for, halved at each `shrink`

    def places(self, chunks: list[str]) -> np.ndarray:
        place = super().places(chunks)
        self.used = np.append(self.used, np.zeros(len(self.known) - len(self.used), np.int64))
        self.used[place] += 1
        return place

    def shrink(self) -> None:
        """Keep the chunks most asked for, the newer of equal ones, up to half of the limit."""
        names, groups, used, starts, pairs = list(self.known), self.groups, self.used, self.starts.values, self.pairs.values
        sizes = [s.values for s in self.sizes]
        cost = 50 + 8 * sizes[3] + np.fromiter(map(len, names), np.int64, len(names)) + np.fromiter(map(len, groups), np.int64, len(groups))
        order = np.lexsort((np.arange(len(names)), used))[::-1]
        kept = np.sort(order[np.cumsum(cost[order]) <= self.limit // 2])
        self.clear()
        self.known = {names[p]: i for i, p in enumerate(kept.tolist())}
        counts = sizes[3][kept]
        self._add(np.stack([s[kept] for s in sizes], axis=1), [groups[p] for p in kept.tolist()], pairs[gather(starts[kept], counts)], np.cumsum(counts) - counts)
        self.used, self.held = used[kept] // 2, int(cost[kept].sum())

    def tokens_a(self, text: str, first_byte: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids, byte ends). first_byte: of each character of the text, and its end."""
        found = self.a.encode(text, add_special_tokens=False)
        ids = np.array(found.ids, np.int64)
        spans = first_byte[np.fromiter(chain.from_iterable(found.offsets), np.int64, 2 * len(ids)).reshape(-1, 2)]
        return ids, byte_ends(spans[:, 0], spans[:, 1], self.lengths_a[ids])

    def tokens_b(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        """(ids, byte ends). B puts the space in front of the text itself."""
        pieces = self.b.encode(text[1:], return_type="proto").pieces
        spans = np.fromiter(chain.from_iterable(map(_SPAN, pieces)), np.int64, 3 * len(pieces)).reshape(-1, 3)
        ids, spans = spans[:, 0], spans[:, 1:] + 1
        if len(ids):
            spans[0, 0] = 0
        return ids, byte_ends(spans[:, 0], spans[:, 1], self.lengths_b[ids])

    def learn(self, chunks: list[str]) -> None:
        # White space at a chunk's end would run together with the next space.
        alone = [i for i, c in enumerate(chunks) if c[-1:].isspace()]
        start = 0
        for i in [*alone, len(chunks)]:
            if start < i:
                self._learn(chunks[start:i])
            if i < len(chunks):
                self._learn([chunks[i]])
            start = i + 1

    def _learn(self, chunks: list[str]) -> None:
        text = " " + " ".join(chunks)
        raw = text.encode()
        first_byte = np.arange(len(text) + 1)
        if len(raw) > len(text):
            points = np.frombuffer(text.encode("utf-32-le"), np.uint32)
            first_byte = np.concatenate([[0], np.cumsum(1 + (points >= 0x80) + (points >= 0x800) + (points >= 0x10000))])
        (ids_a, ends_a), (ids_b, ends_b) = self.tokens_a(text, first_byte), self.tokens_b(text)
        stops = first_byte[np.cumsum([len(c) + 1 for c in chunks])]
        equal = all(
            b"".join(map(table.__getitem__, ids.tolist())) == raw
            and np.array_equal(np.cumsum(lengths[ids]), ends) and _among(stops, ends).all()
            for table, lengths, ids, ends in ((self.bytes_a, self.lengths_a, ids_a, ends_a), (self.bytes_b, self.lengths_b, ids_b, ends_b))
        )
        if not equal:  # some chunk has other bytes than its tokens
            if len(chunks) > 1:
                half = len(chunks) // 2
                self._learn(chunks[:half])
                self._learn(chunks[half:])
            else:
                self._add(np.array([[0, 0, 0, 0, 1]]), [""], np.zeros(0, np.int64), np.zeros(1, np.int64))
            return
        both = _among(ends_a, ends_b)
        common = ends_a[both]
        # Each stretch between ends lies in one token of either.
        links = np.sort(np.concatenate([ends_a[~both], ends_b]), kind="stable")
        pairs = ids_a[np.searchsorted(ends_a, links)] * self.n_b + ids_b[np.searchsorted(ends_b, links)]
        last = [np.searchsorted(x, stops, "right") for x in (ends_a, ends_b, common, links)]
        sizes = np.stack([np.diff(x, prepend=0) for x in last] + [np.zeros(len(stops), np.int64)], axis=1)
        group_a, group_b = np.searchsorted(common, ends_a), np.searchsorted(common, ends_b)
        # A's tokens of a group, then B's: behind each stands a comma, a bar or a semicolon.
        order = np.lexsort((np.repeat([0, 1], [len(ids_a), len(ids_b)]), np.concatenate([group_a, group_b])))
        marks = np.concatenate([np.where(np.diff(group_a, append=-1) != 0, "|", ","), np.where(np.diff(group_b, append=-1) != 0, ";", ",")])
        said = [f"{i}{m}" for i, m in zip(np.concatenate([ids_a, ids_b])[order].tolist(), marks[order].tolist())]
        at = np.concatenate([[0], last[0] + last[1]]).tolist()
        self._add(sizes, ["".join(said[i:j]) for i, j in zip(at, at[1:])], pairs, np.concatenate([[0], last[3][:-1]]))

    def _add(self, sizes: np.ndarray, groups: list[str], pairs: np.ndarray, starts: np.ndarray) -> None:
        for own, values in zip(self.sizes, sizes.T):
            own.add(values)
        self.groups += groups
        self.starts.add(starts + self.pairs.size)
        self.pairs.add(pairs)
        self.held += sum(map(len, groups)) + 8 * len(pairs)

    def align(self, texts: pa.Array) -> tuple[np.ndarray, list[str], np.ndarray, np.ndarray, np.ndarray]:
        """(sizes, groups, bounds, pairs, times): the counts and groups of each text, and its
        distinct pairs between bounds, sorted, with how many links have each."""
        bounds, index, chunks = split(texts, cut, f"^ |{ODD}")
        place = self.places(chunks.to_pylist())[index]
        sizes = np.stack([sums(s.values[place], bounds) for s in self.sizes], axis=1)
        sizes[sizes[:, 4] > 0] = 0
        empty = sizes[:, 0] == 0
        names, ends = [self.groups[p] for p in place.tolist()], bounds.tolist()
        groups = ["" if none else "".join(names[i:j])[:-1] for i, j, none in zip(ends, ends[1:], empty.tolist())]
        doc = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
        whole = ~empty[doc]
        place, doc = place[whole], doc[whole]
        counts = self.sizes[3].values[place]
        flat = self.pairs.values[gather(self.starts.values[place], counts)]
        known, code = np.unique(flat, return_inverse=True)
        keys, times = np.unique(np.repeat(doc, counts) * max(1, len(known)) + code, return_counts=True)
        doc, code = np.divmod(keys, max(1, len(known)))
        return sizes[:, :4], groups, np.searchsorted(doc, np.arange(len(bounds))), known[code], times


def _steps(pairs: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Sorted pairs as steps from one to the next, from 0 for each document: small numbers."""
    out = np.diff(pairs, prepend=0)
    first = bounds[:-1][np.diff(bounds) > 0]
    out[first] = pairs[first]
    return out


def _pairs(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bounds, pairs, times) of rows of `align`."""
    steps = [np.frombuffer(x, "<i8") for x in batch.column("pairs").to_pylist()]
    bounds = np.concatenate([[0], np.cumsum([len(x) for x in steps], dtype=np.int64)])
    run = np.cumsum(np.concatenate([np.zeros(0, np.int64), *steps]))
    before = np.concatenate([[0], run])[bounds[:-1]]
    times = np.concatenate([np.zeros(0, np.int64), *[np.frombuffer(x, "<u4") for x in batch.column("times").to_pylist()]])
    return bounds, run - np.repeat(before, np.diff(bounds)), times


def align(docs: DataFrame, file_a: str, file_b: str) -> DataFrame:
    """One row for each row of `docs` (doc_id, text): doc_id, n_a, n_b, n_groups, n_links, groups,
    and its distinct linked pairs, packed, with `row`, a number of its own.

    `groups` has, for each group, the A ids, a bar and the B ids, as `a1,a2|b1;a3|b2,b3`. Both
    tokenizers see a space before the text. A NULL or empty text, or one whose tokens' bytes
    are not space + text, has no tokens. NULL doc_ids stay; repeated rows count each.
    """

    kept = docs.sparkSession.sparkContext.broadcast(Kept(Aligner, file_a, file_b))  # one for a worker's tasks

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = kept.value.get()
        row = TaskContext.get().partitionId() << 33
        for batch in batches:
            for part in sliced(batch, "text", 1 << 20):
                sizes, groups, bounds, pairs, times = own.align(part.column("text"))
                at = bounds.tolist()
                steps, times = _steps(pairs, bounds).astype("<i8"), times.astype("<u4")
                columns = [
                    pa.array(np.arange(row, row + part.num_rows)), part.column("doc_id"), *[pa.array(c) for c in sizes.T],
                    pa.array(groups, pa.string()), *[pa.array([x[i:j].tobytes() for i, j in zip(at, at[1:])], pa.binary()) for x in (steps, times)],
                ]
                row += part.num_rows
                yield pa.RecordBatch.from_arrays(columns, [f.split()[0] for f in ALIGNED.split(", ")])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(work, ALIGNED)


def pair_counts(aligned: DataFrame, at_once: int = 1_000_000) -> DataFrame:
    """pair, docs (how many rows hold it), best (no pair of its A id has more), of all rows."""

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = (np.zeros(0, np.int64), np.zeros(0, np.int64))
        for batch in batches:
            own = np.unique(_pairs(batch)[1], return_counts=True)
            both = np.concatenate([held[0], own[0]])
            pairs, where = np.unique(both, return_inverse=True)
            held = pairs, np.bincount(where, np.concatenate([held[1], own[1]]), len(pairs)).astype(np.int64)
            if len(pairs) > at_once:
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in held], ["pair", "docs"])
                held = (np.zeros(0, np.int64), np.zeros(0, np.int64))
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in held], ["pair", "docs"])

    counted = aligned.select("pairs", "times").mapInArrow(work, "pair long, docs long")
    return counted.groupBy("pair").agg(F.sum("docs").alias("docs"))


def link_counts(docs: DataFrame, file_a: str, file_b: str, max_pairs: int = 4_000_000) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups for each row of `docs`.

    A pair of ids counts once for each row of `docs` that holds it linked. n_best counts the
    links whose pair has the highest count of its A id, ties included; count_sum adds up the
    counts of all links. A text without tokens has zeros and an empty `groups`. No rows give
    none. Other columns are not read. Up to `max_pairs` counts are broadcast; beyond that,
    documents' pairs are joined with them, salted, to the same result.
    """
    n_b = Aligner(file_a, file_b).n_b
    aligned = written(align(docs, file_a, file_b))
    counts = written(pair_counts(aligned))
    top = counts.groupBy(F.floor(F.col("pair") / n_b).alias("a")).agg(F.max("docs").alias("top"))
    ranked = counts.withColumn("a", F.floor(F.col("pair") / n_b)).join(top, "a")
    ranked = written(ranked.select("pair", "docs", (F.col("docs") == F.col("top")).alias("best")))
    names = ["doc_id", *COUNTS]
    if ranked.count() <= max_pairs:
        found = _by_broadcast(aligned, ranked)
    else:
        found = _by_join(aligned, ranked)
    return found.select(*names, "n_best", "count_sum", "groups")


def _by_broadcast(aligned: DataFrame, ranked: DataFrame) -> DataFrame:
    table = ranked.toArrow().sort_by("pair")
    shared = aligned.sparkSession.sparkContext.broadcast([table.column(c).to_numpy() for c in ("pair", "docs", "best")])

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs, docs, best = shared.value
        for batch in batches:
            bounds, own, times = _pairs(batch)
            at = np.searchsorted(pairs, own)
            more = [sums(times * x[at], bounds) if len(own) else np.zeros(batch.num_rows, np.int64) for x in (best, docs)]
            names = ["doc_id", *COUNTS, "groups"]
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in names], *[pa.array(x) for x in more]], [*names, "n_best", "count_sum"])

    schema = "doc_id long, " + ", ".join(f"{c} long" for c in COUNTS) + ", groups string, n_best long, count_sum long"
    return aligned.mapInArrow(work, schema)


def _by_join(aligned: DataFrame, ranked: DataFrame, salts: int = 16) -> DataFrame:
    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bounds, own, times = _pairs(batch)
            rows = np.repeat(batch.column("row").to_numpy(), np.diff(bounds))
            yield pa.RecordBatch.from_arrays([pa.array(rows), pa.array(own), pa.array(times.astype(np.int64))], ["row", "pair", "times"])

    links = aligned.select("row", "pairs", "times").mapInArrow(work, "row long, pair long, times long")
    links = links.withColumn("salt", F.pmod(F.xxhash64("row"), F.lit(salts)))
    salted = ranked.withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(salts - 1).cast("long"))))
    joined = links.join(salted, ["pair", "salt"]).groupBy("row").agg(
        F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("n_best"), F.sum(F.col("times") * F.col("docs")).alias("count_sum")
    )
    zero = lambda c: F.coalesce(c, F.lit(0).cast("long")).alias(c)
    return aligned.join(joined, "row", "left").select("doc_id", *COUNTS, "groups", zero("n_best"), zero("count_sum"))


def digest(found: DataFrame) -> DataFrame:
    """The groups by their SHA-256; none stay empty."""
    return found.withColumn("groups_sha256", F.when(F.col("groups") == "", "").otherwise(F.sha2("groups", 256))).drop("groups")
