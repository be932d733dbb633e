"""Benchmark decontamination by edit distance.

For every item of n words, each window of n words of every document (or the whole document,
if it is a little shorter) is compared by word edit distance. An edit breaks at most two pairs
of neighbouring words, so windows that hold too few of the pairs of every item of n words cannot
match and are left out at once; of an item's rarest pairs, some must be left even so, and only
items with such a pair in the document are looked at. The other windows are embedded by CGK
random walks, which map edit distance to Hamming distance: at step j the walk writes the word
it stands on and moves on if a random bit of (j, word) says so. Each repetition has a walk of
its own and samples a few of its steps; equal samples make a candidate, and candidates are
verified by their exact edit distance. Repetitions follow from the item size, by a seeded
simulation. Shorter documents drift too far for walks; they become candidates by any block of
words that the edits must leave whole. Equal windows are embedded and verified once, however
many documents hold them.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from rolecall.llm.common import free, texts_of, written

# ASCII punctuation and controls separate words; other code points belong to them.
_SPACES = bytes(c if c >= 128 or chr(c).isalnum() else 32 for c in range(256))
OTHER = 0  # stands for all words that no item holds
_TURN = np.uint64(0x9E3779B97F4A7C15)  # so that this word, too, takes random steps


def words_of(text: bytes) -> list[bytes]:
    return text.decode().lower().encode().translate(_SPACES).split()


def word_id(word: bytes) -> int:
    from xxhash import xxh64_intdigest

    return xxh64_intdigest(word) | 1


def repeats_for(recall: float, samples: int, agreement: float) -> int:
    """Repetitions that reach `recall` if a walk's sampled step agrees with that chance."""
    return math.ceil(math.log(1 - recall) / math.log(1 - agreement**samples))


def edited_windows(item: np.ndarray, edits: int, kind: str, rng: np.random.Generator) -> np.ndarray:
    """`item` after exactly `edits` random edits of a kind, as a window of its length."""
    new = lambda n: rng.integers(1, 2**63, n, dtype=np.uint64)
    shifts = {"replaced": 0, "mixed": edits // 4}.get(kind, edits // 2)
    out = item.copy()
    own = rng.choice(len(item), edits - shifts, replace=False)  # a shift is a deletion and an insertion
    replaced, deleted = own[: edits - 2 * shifts], own[edits - 2 * shifts :]
    out[replaced] = new(len(replaced))
    out = np.delete(out, deleted)
    if kind == "tail":  # the text after it moves up
        return np.concatenate([out, new(shifts)])
    return np.insert(out, rng.integers(0, len(out) + 1, shifts), new(shifts))


KINDS = ("replaced", "shifted", "mixed", "tail")


def repeats_at(size: int, edits: int, recall: float, samples: int, trials: int = 150, walks: int = 32) -> int:
    """Repetitions that reach `recall` for windows at `edits` edits of an item of `size` words.

    The share of equal walk steps falls with the size at the same share of edits, so it is
    simulated, seeded, for each size: random items, edits at random places, the worst of the kinds.
    """
    if not edits:
        return 1
    rng = np.random.default_rng([size, edits, samples])
    steps, most = 2 * size, 1
    for kind in KINDS:
        a = np.zeros((trials, size + 1), np.uint64)
        a[:, :size] = rng.integers(1, 2**63, (trials, size), dtype=np.uint64)
        b = np.zeros_like(a)
        for i in range(trials):
            b[i, :size] = edited_windows(a[i, :size], edits, kind, rng)
        rows = np.arange(trials)[:, None]
        x, y, equal = (np.zeros((trials, walks), np.int64) for _ in range(3))
        for _ in range(steps):
            odd = rng.integers(0, 2**63, walks, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
            p, q = a[rows, x], b[rows, y]
            equal += p == q
            x = np.minimum(x + ((p + _TURN) * odd >> np.uint64(63)).astype(np.int64), size)
            y = np.minimum(y + ((q + _TURN) * odd >> np.uint64(63)).astype(np.int64), size)
        chance = np.maximum(((equal / steps) ** samples).mean(axis=1), float(steps) ** -samples)
        while (1 - (1 - chance) ** most).mean() < recall:
            most = max(most + 1, most * 21 // 20)
    return most


def plan(size: int, share: float, recall: float, samples: int, repeats: int = 100) -> tuple[int, int]:
    """Repetitions and samples for `size` words: fewer samples where `repeats` would not do."""
    for s in range(samples, 0, -1):
        needed = repeats_at(size, int(share * size), recall, s)
        if needed <= repeats:
            break
    return needed, s


def block_keys(words: bytes, size: int, share: float, item: bool) -> set[int]:
    """Hashes of stretches of words. Of the disjoint ones of an item, an edit breaks one at
    most, so a window within `share` * size edits holds one of them."""
    from xxhash import xxh64_intdigest

    edits = int(share * size)
    length = max(1, size // (edits + 1))
    starts = range(0, (edits + 1) * length, length) if item else range(len(words) // 8 - length + 1)
    return {xxh64_intdigest(words[8 * i : 8 * (i + length)], size) for i in starts}


class Walks:
    """The walks and sampled steps for windows of `size` words. Equal for items and documents."""

    def __init__(self, size: int, repeats: int, samples: int):
        self.size = size
        rng = np.random.default_rng([size, samples])
        # A walk takes two steps for a word on average, so later steps mostly stand still.
        self.steps = 2 * size
        self.odd = rng.integers(0, 2**63, (repeats, self.steps), dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        self.sampled = np.sort(rng.integers(0, self.steps, (repeats, samples)), axis=1)
        self.mix = rng.integers(0, 2**63, (repeats, samples + 1), dtype=np.uint64) * np.uint64(2) + np.uint64(1)

    def keys(self, windows: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """A key for each window (rows of `size` word ids) and repetition."""
        rows = np.arange(len(windows))
        padded = np.concatenate([windows, np.zeros((len(windows), 1), np.uint64)], axis=1)
        out = np.empty((len(windows), len(self.odd)), np.uint64)
        for r, odd in enumerate(self.odd):
            at = np.zeros(len(windows), np.int64)
            key = np.full(len(windows), self.mix[r, -1], np.uint64)
            last = self.sampled[r, -1]
            for j in range(last + 1):
                word = padded[rows, at]
                for i in np.flatnonzero(self.sampled[r] == j):
                    key = (key ^ word) * self.mix[r, i]
                    key ^= key >> np.uint64(29)
                step = (word + _TURN) * odd[j] >> np.uint64(63)
                at = np.minimum(at + step.astype(np.int64), lengths)
            out[:, r] = key + np.uint64(r)
        return out


def edit_distance(a: list[int], b: list[int], most: int) -> int:
    """Word edit distance, or `most` + 1 for more. Only cells within `most` of the diagonal count."""
    if abs(len(a) - len(b)) > most:
        return most + 1
    if len(a) - len(set(a).intersection(b) - {OTHER}) > most + len(a) - len(set(a)):
        return most + 1  # a word of `a` that `b` lacks takes an edit of its own
    over = most + 1
    row = [j if j <= most else over for j in range(len(b) + 1)]
    for i, x in enumerate(a, 1):
        low, first, last = over, max(1, i - most), min(len(b), i + most)
        before = row[first - 1]
        row[first - 1] = i if first == 1 and i <= most else over
        left = row[first - 1]
        for j in range(first, last + 1):
            above = row[j]
            y = b[j - 1]
            if x == y and x != OTHER:
                left = min(before, above + 1, left + 1)
            else:
                left = (before if before <= above and before <= left else above if above <= left else left) + 1
            if left < low:
                low = left
            row[j], before = left, above
        if last < len(b):
            row[last + 1] = over
        if low > most and row[first - 1] > most:
            return over
    return min(row[-1], over)


def _sized(words: list[int]) -> np.ndarray:
    return np.array(words, np.uint64)


class Pairs:
    """Neighbouring words of some items, given as word lists."""

    def __init__(self, items: list[list[bytes]], share: float):
        self.share = share
        self.singles = {words[0] for words in items if len(words) == 1}
        known = sorted({w for words in items for w in words})
        self.place = {w: i for i, w in enumerate(known)}
        self.ids = np.array([word_id(w) for w in known] + [OTHER], np.uint64)
        self.items = []  # (size, sorted pairs)
        pairs = [self.codes(np.array([self.place[w] for w in words])) for words in items if len(words) > 1]
        all_, held = np.unique(np.concatenate([np.zeros(0, np.int64), *[np.unique(p) for p in pairs]]), return_counts=True)
        rare = []
        for number, own in enumerate(pairs):
            size = len(own) + 1
            codes, times = np.unique(own, return_counts=True)
            order = np.argsort(held[np.searchsorted(all_, codes)], kind="stable")
            # Edits break 2 * limit places of pairs at most, so one more place of the rarest is left.
            enough = np.searchsorted(np.cumsum(times[order]), 2 * int(share * size) + 1) + 1
            rare += [(code, number) for code in codes[order[:enough]].tolist()]
            self.items.append((size, codes))
        both = np.array(sorted(rare), np.int64).reshape(-1, 2)
        self.rare, self.starts = np.unique(both[:, 0], return_index=True)
        self.starts = np.append(self.starts, len(both))
        self.holders = both[:, 1]

    def codes(self, place: np.ndarray) -> np.ndarray:
        return place[:-1].astype(np.int64) * len(self.place) + place[1:]

    def windows(self, words: list[bytes]) -> Iterator[tuple[int, int, bytes]]:
        """(start, item size, word ids) of the windows that may match."""
        n = len(words)
        place = np.fromiter((self.place.get(w, -1) for w in words), np.int64, n)
        if self.singles:
            for i, w in enumerate(words):
                if w in self.singles:
                    yield i, 1, self.ids[place[i : i + 1]].tobytes()
        if n < 2 or not len(self.rare):
            return
        at = np.flatnonzero((place[:-1] >= 0) & (place[1:] >= 0))
        code = self.codes(place)[at]
        found = np.minimum(np.searchsorted(self.rare, code), len(self.rare) - 1)
        found = np.unique(found[self.rare[found] == code])
        if not len(found):
            return
        some = np.unique(np.concatenate([self.holders[self.starts[i] : self.starts[i + 1]] for i in found.tolist()]))
        starts: dict[int, set[int]] = {}
        for size, codes in map(self.items.__getitem__, some.tolist()):
            need = size - 1 - 2 * int(self.share * size)  # pairs that a matching window holds at least
            near = np.minimum(np.searchsorted(codes, code), len(codes) - 1)
            own = at[codes[near] == code]
            if len(own) < need or n < size - int(self.share * size):
                continue
            if n < size:
                starts.setdefault(size, set()).add(0)
            elif (own[need - 1 :] - own[: len(own) - need + 1] <= size - 2).any():
                hits = np.zeros(n, np.int64)
                hits[own + 1] = 1
                hits = np.cumsum(hits)  # pairs up to each word
                inside = hits[size - 1 :] - hits[: n - size + 1] >= need
                starts.setdefault(size, set()).update(np.flatnonzero(inside).tolist())
        ids = self.ids[place]
        for size, own in starts.items():
            for start in sorted(own):
                yield start, size, ids[start : start + size].tobytes()


def find_items(
    docs: DataFrame,
    items: DataFrame,
    share: float = 0.2,
    recall: float = 0.99,
    samples: int = 3,
    max_pairs: int = 1_000_000,
) -> DataFrame:
    """doc_id, item_id, start, n_words, edits, windows for every item a document holds.

    A document (`doc_id`, `text`) holds an item (`item_id`, `text`) of n words if a window of
    n of its words is within `share` * n word edits, rounded down. start, n_words and edits
    are those of the best window, the first of the best; `windows` counts the positions of
    all that match. `recall` is the chance that a window at the limit becomes a candidate,
    with edits at random places; repetitions, and `samples` or fewer, follow for each item size.

    Case and ASCII punctuation do not count. NULL texts are empty; items without words are
    held by nobody; NULL ids stay; repeated rows of documents add to `windows`, repeated items
    do not. No rows on either side give none. Other columns are not read. Items are broadcast
    in blocks of about `max_pairs` words, each of which reads the documents once.
    """
    spark = docs.sparkSession

    def item_words(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words = [words_of(t) for t in texts_of(batch, "text")]
            ids = [_sized([word_id(w) for w in ws]).tobytes() for ws in words]
            yield pa.RecordBatch.from_arrays(
                [batch.column("item_id"), pa.array(ids, pa.binary()), pa.array([len(w) for w in words], pa.int32()), pa.array(words, pa.list_(pa.binary()))],
                ["item_id", "item", "size", "words"],
            )

    own = items.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text")).distinct()
    prepared = written(own.mapInArrow(item_words, "item_id long, item binary, size int, words array<binary>"))
    prepared = prepared.filter("size > 0")
    sizes = sorted(r.size for r in prepared.select("size").distinct().toLocalIterator())
    plans = {n: plan(n, share, recall, samples) for n in sizes}
    n_words = prepared.agg(F.sum("size")).first()[0] or 0
    n_blocks = max(1, math.ceil(n_words / max_pairs))
    prepared = prepared.withColumn("block", F.pmod(F.xxhash64("item"), F.lit(n_blocks)).cast("int"))

    def search(known) -> Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
        def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                rows: list[tuple] = []
                for doc_id, text in zip(batch.column("doc_id").to_pylist(), texts_of(batch, "text")):
                    for window in known.value.windows(words_of(text)):
                        rows.append((doc_id, *window))
                        if len(rows) >= 10_000:
                            yield table_of(rows)
                            rows = []
                yield table_of(rows)

        return work

    def table_of(rows: list[tuple]) -> pa.RecordBatch:
        columns = zip(*rows) if rows else [[]] * 4
        types = [pa.int64(), pa.int32(), pa.int32(), pa.binary()]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], ["doc_id", "start", "size", "window"])

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    found_places = []
    for block in range(n_blocks):
        own_items = prepared.filter(F.col("block") == block).select("words", "item").dropDuplicates(["item"])
        known = spark.sparkContext.broadcast(Pairs([[bytes(w) for w in r["words"]] for r in own_items.collect()], share))
        found = texts.mapInArrow(search(known), "doc_id long, start int, size int, window binary")
        found_places.append(found.withColumn("block", F.lit(block)))
    places = written(reduce(DataFrame.unionByName, found_places).withColumn("window_id", F.xxhash64("window", "size", "block")))

    def blocks(batches: Iterable[pa.RecordBatch], item: bool) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = zip(batch.column("id").to_pylist(), batch.column("words").to_pylist(), batch.column("size").to_pylist())
            out = [(i, key) for i, words, size in rows for key in block_keys(words, size, share, item)]
            ids, keys = zip(*out) if out else ([], [])
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(np.array(keys, np.uint64).view(np.int64))], ["id", "key"])

    def embed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """(id, key) rows of the columns id, words, size, which is the number of words."""
        walks: dict[int, Walks] = {}
        for batch in batches:
            size = batch.column("size").to_numpy()
            names = batch.column("id").to_numpy()
            words = batch.column("words").to_pylist()
            for n in np.unique(size).tolist():
                rows = np.flatnonzero(size == n)
                repeats, samples = plans[n]
                if n not in walks:
                    if len(walks) > 200:
                        walks.clear()
                    walks[n] = Walks(n, repeats, samples)
                for i in range(0, len(rows), 2_000):
                    some = rows[i : i + 2_000]
                    windows = np.stack([np.frombuffer(words[r], np.uint64) for r in some])
                    keys = walks[n].keys(windows, np.full(len(some), n))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.repeat(names[some], repeats)), pa.array(keys.reshape(-1).view(np.int64))], ["id", "key"]
                    )

    def keyed(rows: DataFrame, name: str, item: bool) -> DataFrame:
        """Walks of full windows and items; blocks of shorter windows and items."""
        short = "size > 0" if item else "octet_length(words) < 8 * size"
        walked = rows.filter("octet_length(words) = 8 * size").mapInArrow(embed, "id long, key long").withColumn("walk", F.lit(True))
        cut = rows.filter(short).mapInArrow(lambda b: blocks(b, item), "id long, key long").withColumn("walk", F.lit(False))
        return walked.unionByName(cut).select(F.col("id").alias(name), "key", "walk").distinct()

    # Equal words of one size are one window, equal items one item text.
    windows = places.groupBy("window_id", "size", "block").agg(F.min("window").alias("window"))
    texts_ = prepared.withColumn("text_id", F.xxhash64("item")).groupBy("text_id", "size", "block").agg(F.min("item").alias("item"))
    left = keyed(windows.select(F.col("window_id").alias("id"), F.col("window").alias("words"), "size"), "window_id", False)
    right = keyed(texts_.select(F.col("text_id").alias("id"), F.col("item").alias("words"), "size"), "text_id", True)
    near = left.join(right, ["key", "walk"]).select("window_id", "text_id").distinct()
    # Size and block say for which items a window was cut.
    own_texts = texts_.withColumnsRenamed({"size": "_size", "block": "_block"})
    near = near.join(windows, "window_id").join(own_texts, "text_id").filter("size = _size AND block = _block")

    def verify(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            edits = []
            for window, item in zip(batch.column("window").to_pylist(), batch.column("item").to_pylist()):
                a, b = np.frombuffer(window, np.uint64).tolist(), np.frombuffer(item, np.uint64).tolist()
                limit = int(share * len(b))
                found = edit_distance(a, b, limit)
                edits.append(found if found <= limit else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column("window_id"), batch.column("text_id"), pa.array(edits, pa.int32())], ["window_id", "text_id", "edits"]
            )

    close = near.select("window_id", "text_id", "window", "item").mapInArrow(verify, "window_id long, text_id long, edits int")
    close = close.filter("edits IS NOT NULL")
    named = prepared.select(F.xxhash64("item").alias("text_id"), "item_id").distinct()
    hits = places.select("doc_id", "start", "window_id", "size", F.octet_length("window").alias("_bytes")).join(close, "window_id").join(named, "text_id")
    best = F.min(F.struct("edits", "start", (F.col("_bytes") / 8).cast("int").alias("n_words"))).alias("best")
    found = hits.groupBy("doc_id", "item_id").agg(best, F.count("*").alias("windows"))
    return found.select("doc_id", "item_id", "best.start", "best.n_words", "best.edits", "windows")


def clean(docs: DataFrame, items: DataFrame, **options) -> DataFrame:
    """`docs` without the rows of documents that hold an item. Rows with a NULL doc_id go if
    any such row holds one, and so do rows that share a doc_id with one that does. NULL and
    empty texts hold none; repeated rows all stay or all go; without items all stay; no rows
    give none. Other columns, whatever their names, are kept."""
    doc = free(docs, "_doc")
    found = find_items(docs, items, **options).select(F.col("doc_id").alias(doc)).distinct()
    return docs.join(found, F.col("doc_id").eqNullSafe(F.col(doc)), "left_anti")
