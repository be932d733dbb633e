"""Texts as runs of chunks, so that each distinct chunk is worked on once.

A chunk is a stretch between spaces, or longer where a tokenizer might join what stands on
both sides of a space. Arrow splits and dictionary-encodes a whole batch; only the distinct
chunks ever become Python objects.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# White space of Python's str, which holds that of the tokenizers' patterns.
SPACE = r"\x{9}-\x{d}\x{1c}-\x{20}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
ODD = f" ([{SPACE}]|$)"


def sliced(batch: pa.RecordBatch, name: str, most_bytes: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Stretches of a batch whose texts together have at most that many bytes, or of one row."""
    sizes = pc.fill_null(pc.binary_length(batch.column(name)), 0).to_numpy(zero_copy_only=False)
    ends, start = np.cumsum(sizes.astype(np.int64)), 0
    while start < batch.num_rows:
        done = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, done + most_bytes, "right")))
        yield batch.slice(start, stop - start)
        start = stop


def split(
    texts: pa.Array, cut: Callable[[str], list[str]] | None = None, odd_if: str = ODD
) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """(bounds, index, chunks): text i is chunks[index[bounds[i]:bounds[i + 1]]].

    Texts are cut at each space, which no chunk holds. If `cut` is given, it cuts the texts that
    match `odd_if`, by default those in which a space stands before white space or at the end;
    all chunks but the first then come without the space that they start with. NULL is empty, and an empty text has no chunk.
    """
    texts = pc.fill_null(texts.cast(pa.string()), "")
    lists = pc.split_pattern(texts, " ")
    if cut is not None:
        odd = pc.match_substring_regex(texts, odd_if)
        if pc.any(odd).as_py():
            rows = np.flatnonzero(odd.to_numpy(zero_copy_only=False))
            order = np.arange(len(texts))
            order[rows] = len(texts) + np.arange(len(rows))
            own = pa.array([cut(t) for t in texts.take(pa.array(rows)).to_pylist()], lists.type)
            lists = pa.concat_arrays([lists, own]).take(pa.array(order))
    none = pc.equal(texts, "")
    lists = pc.if_else(none, pa.scalar([], lists.type), lists) if pc.any(none).as_py() else lists
    counts = pc.list_value_length(lists).to_numpy(zero_copy_only=False)
    coded = lists.flatten().dictionary_encode()
    return np.concatenate([[0], np.cumsum(counts, dtype=np.int64)]), coded.indices.to_numpy(zero_copy_only=False), coded.dictionary


def gather(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Places of the stretches that begin at `starts`, one after the other."""
    ends = np.cumsum(counts)
    return np.repeat(starts - ends + counts, counts) + np.arange(ends[-1] if len(ends) else 0)


def sums(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Sums of the stretches of `values` between bounds."""
    return np.diff(np.concatenate([np.zeros((1, *values.shape[1:]), np.int64), np.cumsum(values, axis=0, dtype=np.int64)])[bounds], axis=0)


class Grown:
    """A one-dimensional array that grows at its end."""

    def __init__(self, kind: type):
        self.kind, self.room, self.size = kind, np.zeros(1 << 12, kind), 0

    def add(self, values: np.ndarray) -> None:
        if self.size + len(values) > len(self.room):
            self.room = np.concatenate([self.room[: self.size], np.zeros(self.size + len(values), self.kind)])
        self.room[self.size : self.size + len(values)] = values
        self.size += len(values)

    @property
    def values(self) -> np.ndarray:
        return self.room[: self.size]


class Chunks:
    """What a Python worker knows of chunks. It starts anew beyond `limit` characters."""

    #: Chunks that are worked on at once.
    TOGETHER = 4_000

    def __init__(self, limit: int):
        self.limit = limit
        self.clear()

    def clear(self) -> None:
        self.known: dict[str, int] = {}
        self.held = 0

    def learn(self, chunks: list[str]) -> None:
        """Append what is to be known of new chunks; their places follow each other."""
        raise NotImplementedError

    def shrink(self) -> None:
        """Make room when `limit` is exceeded."""
        self.clear()

    def places(self, chunks: list[str]) -> np.ndarray:
        """The place of each of these distinct chunks."""
        if self.held > self.limit:
            self.shrink()
        known = self.known
        new = [c for c in chunks if c not in known]
        for i in range(0, len(new), self.TOGETHER):
            some = new[i : i + self.TOGETHER]
            self.learn(some)
            known.update(zip(some, range(len(known), len(known) + len(some))))
        self.held += sum(map(len, new)) + 50 * len(new)
        return np.fromiter(map(known.__getitem__, chunks), np.int64, len(chunks))


def byte_level() -> dict[str, int]:
    """The byte that each character of a byte-level vocabulary stands for: visible Latin-1
    characters for themselves, those from U+0100 on for the others."""
    visible = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = iter(range(0x100, 0x200))
    return {chr(b if b in visible else next(others)): b for b in range(256)}


def vocabulary(tokenizer) -> list[bytes]:
    """The bytes of each id of a byte-level tokenizer; none for ids that are not byte-level."""
    to_byte, out = byte_level(), [b""] * tokenizer.get_vocab_size()
    for token, i in tokenizer.get_vocab().items():
        if all(c in to_byte for c in token):
            out[i] = bytes(to_byte[c] for c in token)
    return out
