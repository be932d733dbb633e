"""Harmonic packing of tokenised documents into sequences of one capacity.

Lengths fall into classes: class k holds lengths in (capacity/(k+1), capacity/k], and a
sequence of class k takes exactly k pieces. A document is first cut into whole sequences;
the rest is cut, greedily, into the largest exact class sizes `capacity // k`, so that full
sequences have next to no padding. Each task fills its own sequences, without a shuffle. The
pieces of sequences that are still open when a task ends are laid end to end, cut at the
capacity, and the last remainder is cut into powers of two, which need no padding.
"""

from __future__ import annotations

from array import array
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from rolecall.llm.chunks import SPACE, byte_level, sliced, split, vocabulary
from rolecall.llm.common import Kept

ID_BYTES = 4
NONE = pa.scalar(b"", pa.large_binary())
MARKS = ".,!?;:#$%&*|"
LETTERS = "".join(c for c in map(chr, range(0x41, 0x100)) if c.isalpha() and c not in "ªµº")
# A space or line break beside white space or at an end, each line break having a space before it.
ODD_LINES = rf" ([{SPACE.replace("\\x{9}-", "\\x{9}\\x{b}-")}]|$)|\n([{SPACE}]|$)|[{SPACE}] \n|^ \n"
PIECES = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("start", pa.int64()),
        ("length", pa.int64()),
        ("ids", pa.binary()),
        ("doc_tokens", pa.int64()),
        ("sequence_id", pa.int64()),
        ("offset", pa.int64()),
    ]
)
SCHEMA = (
    "doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, "
    "offset long"
)


def cut(text: str) -> list[str]:
    """Cut where a space stands before a character that is no white space."""
    first, *others = text.split(" ")
    words = [first]
    for w in others:
        if not w or w[0].isspace():
            words[-1] += " " + w
        else:
            words.append(w)
    return words


def cut_lines(text: str) -> list[str]:
    """The same for a text in which each line break has got one more space before it."""
    return cut(text.replace(" \n", "\n"))


def joined(counts: list[int] | np.ndarray, ids: np.ndarray) -> pa.Array:
    """Stretches of ids, so many each, as bytes."""
    ends = np.concatenate([[0], np.cumsum(counts, dtype=np.int64)]) * ID_BYTES
    return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(counts), [None, pa.py_buffer(ends), pa.py_buffer(ids)])


class Words:
    """Token ids of texts, made once for each distinct word of a slice.

    A byte-level BPE tokenizer whose pattern takes one space with the word behind it never
    joins tokens across such a cut, nor across a single line break between words. Nor does it
    join plain letters with the marks behind them, so these go straight to the tokenizer's
    model, which is much faster than its pattern. The cut at spaces is asserted for all words
    that need the pattern, the others for the first words. The `limit` pieces of letters and
    marks that were used last stay known, in Arrow's memory, from slice to slice.
    """

    #: Words that go through the pattern, or are asserted, at once.
    TOGETHER = 4_000

    def __init__(self, tokenizer_file: str, limit: int = 200_000):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(tokenizer_file)
        self.tokenizer.encode_special_tokens = True  # their names in a text are plain text
        self.lengths = np.array([len(t) for t in vocabulary(self.tokenizer)], np.int64)
        self.spelled = {b: c for c, b in byte_level().items() if b}  # NUL parts pieces
        self.tokenizer.model._resize_cache(0)  # of no use for words that come once
        self.tokenize = self.tokenizer.model.tokenize
        self.asserted = False
        self.limit = limit
        self.known, self.ids = pa.array([], pa.string()), joined([], np.zeros(0, "<u4"))

    def pieces(self, pieces: pa.Array) -> pa.Array:
        """Ids of what is one piece each, or nothing, to the tokenizer's pattern, as bytes."""
        coded = pieces.dictionary_encode()
        distinct = coded.dictionary
        places = pc.index_in(distinct, self.known)
        new = distinct.filter(places.is_null())
        ids = pa.concat_arrays([self.ids, self.spell(new)])
        ids = ids.take(pc.if_else(places.is_null(), len(self.known) + np.cumsum(places.is_null()) - 1, places))
        others = np.ones(len(self.known), bool)
        others[places.drop_null()] = False
        others = pa.array(np.flatnonzero(others)[: max(0, self.limit - len(distinct))])
        self.ids = pa.concat_arrays([ids, self.ids.take(others)])
        self.known = pa.concat_arrays([distinct, self.known.take(others)])
        return ids.take(coded.indices)

    def spell(self, pieces: pa.Array) -> pa.Array:
        """The same by the tokenizer's model."""
        ids, counts, tokenize = array("I"), [], self.tokenize
        for i in range(0, len(pieces), self.TOGETHER):
            text = "\0".join(pieces.slice(i, self.TOGETHER).to_pylist())
            found = [tokenize(s) for s in text.encode().decode("latin-1").translate(self.spelled).split("\0")]
            counts += map(len, found)
            ids.extend([t.id for tokens in found for t in tokens])
        return joined(counts, np.array(ids, "<u4"))

    def whole(self, texts: list[str]) -> pa.Array:
        """Ids of texts as bytes, by the whole tokenizer."""
        found = [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        return joined([len(ids) for ids in found], np.array([i for ids in found for i in ids], "<u4"))

    def by_pattern(self, words: list[str]) -> pa.Array:
        """Ids of words that follow a space, by the whole tokenizer."""
        found = []
        for i in range(0, len(words), self.TOGETHER):
            some = words[i : i + self.TOGETHER]
            ids = np.array(self.tokenizer.encode_batch_fast([" " + " ".join(some)], add_special_tokens=False)[0].ids, "<u4")
            ends = np.cumsum(self.lengths[ids])
            stops = np.cumsum([len(w.encode()) + 1 for w in some])
            last = np.searchsorted(ends, stops)
            if not np.array_equal(ends[last], stops):
                raise ValueError("this tokenizer joins tokens across a space before a word")
            found.append(joined(np.diff(last, prepend=-1), ids))
        return pa.concat_arrays([joined([], np.zeros(0, "<u4")), *found])

    def words(self, words: pa.Array, lead: np.ndarray) -> pa.Array:
        """Ids of words as bytes; `lead` is what stands before each: a space, a line break or nothing."""
        letters, marks = pc.utf8_rtrim(words, MARKS), pc.utf8_ltrim(words, LETTERS)
        sizes = [pc.binary_length(x).to_numpy(zero_copy_only=False) for x in (letters, marks, words)]
        plain = (sizes[0] > 0) & (sizes[0] + sizes[1] == sizes[2])
        spaced, others = np.flatnonzero(~plain & (lead == " ")), np.flatnonzero(~plain & (lead != " "))
        lines = pa.array((lead == "\n").astype(np.int8))
        letters, marks, first = (x.filter(pa.array(plain)) for x in (letters, marks, lines))
        heads = pc.binary_join_element_wise(pa.array(np.where(lead[plain] == " ", " ", ""), pa.string()), letters, "")
        ids = self.pieces(pa.concat_arrays([pa.array(["", "\n"]), heads, marks]))
        breaks, heads, marks = ids.slice(0, 2), ids.slice(2, len(heads)), ids.slice(2 + len(heads))
        ids = pc.binary_join_element_wise(breaks.take(first), heads, marks, NONE)
        if not self.asserted and len(ids):
            self.check(words.filter(pa.array(plain)), lead[plain], ids, breaks[1].as_py())
        alone = self.whole(words.take(pa.array(others)).to_pylist())
        alone = pc.binary_join_element_wise(breaks.take(lines.take(pa.array(others))), alone, NONE)
        order = np.argsort(np.concatenate([np.flatnonzero(plain), spaced, others]))
        by_space = self.by_pattern(words.take(pa.array(spaced)).to_pylist())
        return pa.concat_arrays([ids, by_space, alone]).take(pa.array(order))

    def check(self, words: pa.Array, lead: np.ndarray, ids: pa.Array, line: bytes) -> None:
        """Asserts the ids of letters and marks; a word that has nothing before it is put behind a line break."""
        some = list(zip(lead.tolist(), words.slice(0, self.TOGETHER).to_pylist(), ids.slice(0, self.TOGETHER).to_pylist()))
        want = self.whole(["".join((at or "\n") + word for at, word, _ in some)])[0].as_py()
        if want != b"".join(found if at else line + found for at, _, found in some):
            raise ValueError("this tokenizer has another pattern for letters and marks")
        self.asserted = True

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(bounds, ids): the ids of text i are ids[bounds[i]:bounds[i + 1]]."""
        texts = pc.replace_substring(texts.cast(pa.string()), "\n", " \n")
        bounds, index, chunks = split(texts, cut_lines, ODD_LINES)
        at = bounds[:-1][np.diff(bounds) > 0]  # the first word of a text has nothing before it
        firsts = chunks.take(pa.array(index[at]))
        index = index.astype(np.int64)
        index[at] = len(chunks) + np.arange(len(at))
        used = np.bincount(index, minlength=len(chunks) + len(at)) > 0
        index = (np.cumsum(used) - 1)[index]
        chunks = chunks.filter(pa.array(used[: len(chunks)]))
        lines = pc.starts_with(chunks, "\n").to_numpy(zero_copy_only=False)
        lead = np.concatenate([np.where(lines, "\n", " "), np.full(len(at), "")])
        ids = self.words(pa.concat_arrays([pc.ascii_ltrim(chunks, "\n"), firsts]), lead).take(pa.array(index))
        if not len(ids):
            return bounds, np.zeros(0, "<u4")
        ends = np.frombuffer(ids.buffers()[1], np.int64)[: len(ids) + 1] // ID_BYTES
        return ends[bounds], np.frombuffer(ids.buffers()[2], "<u4")[: ends[-1]]


def harmonic_cut(length: int, capacity: int, least: int) -> list[int]:
    """Cut a length into whole sequences, then exact class sizes, then what is at most `least`."""
    sizes = [capacity] * (length // capacity)
    rest = length % capacity
    while rest > least:
        size = capacity // (capacity // (rest + 1) + 1)
        sizes.append(size)
        rest -= size
    if rest:
        sizes.append(rest)
    return sizes


class Worker:
    """Sequences of one task. `rows` collects (doc, start, ids, doc_tokens, sequence, offset)."""

    def __init__(self, capacity: int, least: int, first_id: int):
        self.capacity, self.least, self.next_id = capacity, least, first_id
        self.open: dict[int, list[tuple]] = {}
        self.rows: list[tuple] = []

    def add(self, doc_id: int | None, ids: bytes) -> None:
        total, at = len(ids) // ID_BYTES, 0
        for size in harmonic_cut(total, self.capacity, self.least):
            piece = (doc_id, at, ids[at * ID_BYTES : (at + size) * ID_BYTES], total)
            k = self.capacity // size
            bin_ = self.open.setdefault(k, [])
            bin_.append(piece)
            if len(bin_) == k:
                self.close(self.open.pop(k))
            at += size

    def close(self, pieces: list[tuple]) -> None:
        offset = 0
        for doc_id, start, ids, total in pieces:
            self.rows.append((doc_id, start, len(ids) // ID_BYTES, ids, total, self.next_id, offset))
            offset += len(ids) // ID_BYTES
        self.next_id += 1

    def finish(self) -> None:
        """Close what is open: whole sequences, then powers of two."""
        left = [p for k in sorted(self.open) for p in self.open[k]]
        self.open = {}
        total = sum(len(p[2]) // ID_BYTES for p in left)
        sizes = [self.capacity] * (total // self.capacity)
        rest = total % self.capacity
        sizes += [1 << b for b in reversed(range(rest.bit_length())) if rest >> b & 1]
        left.reverse()
        for size in sizes:
            taken, room = [], size
            while room:
                doc_id, start, ids, doc_tokens = left.pop()
                n = min(room, len(ids) // ID_BYTES)
                taken.append((doc_id, start, ids[: n * ID_BYTES], doc_tokens))
                if ids[n * ID_BYTES :]:
                    left.append((doc_id, start + n, ids[n * ID_BYTES :], doc_tokens))
                room -= n
            self.close(taken)


def pack(
    docs: DataFrame,
    tokenizer_file: str,
    capacity: int = 1024,
    end_id: int = 0,
    least: int = 32,
) -> DataFrame:
    """Pieces of all documents (`doc_id`, `text`) with their place in sequences.

    Returns doc_id, start (ids of the document before the piece), length, ids (binary,
    little-endian unsigned 32-bit), doc_tokens, sequence_id, offset. Each document ends
    with `end_id`. Rows that repeat are packed each; NULL text is empty and leaves `end_id`
    alone; a NULL doc_id stays NULL; no rows give none. Other columns are not read. The
    tokenizer file must be at the same path on every machine.
    """

    kept = docs.sparkSession.sparkContext.broadcast(Kept(Words, tokenizer_file))  # one cache for a worker's tasks

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = kept.value.get()
        worker = Worker(capacity, least, TaskContext.get().partitionId() << 33)
        end = end_id.to_bytes(ID_BYTES, "little")

        def rows() -> pa.RecordBatch:
            columns = zip(*worker.rows) if worker.rows else [[] for _ in PIECES]
            worker.rows = []
            return pa.RecordBatch.from_arrays(
                [pa.array(c, f.type) for c, f in zip(columns, PIECES)], schema=PIECES
            )

        for batch in batches:
            for part in sliced(batch, "text"):
                bounds, ids = cache.encode(part.column("text"))
                data, bounds = ids.tobytes(), (bounds * ID_BYTES).tolist()
                for doc_id, a, b in zip(part.column("doc_id").to_pylist(), bounds, bounds[1:]):
                    worker.add(doc_id, data[a:b] + end)
                yield rows()
        worker.finish()
        yield rows()

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(work, SCHEMA)
