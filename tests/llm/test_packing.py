import random
import tracemalloc

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from rolecall.llm.chunks import sliced
from rolecall.llm.packing import Words, harmonic_cut, pack

FILE = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def tokenizer():
    t = Tokenizer.from_file(FILE)
    t.encode_special_tokens = True
    return t


def check(rows, texts, tokenizer):
    pieces = pack(rows, FILE).collect()
    want = sorted((str(i), tokenizer.encode(t or "", add_special_tokens=False).ids + [0]) for i, t in texts)
    docs, at = {}, {}
    for p in sorted(pieces, key=lambda p: p.start):
        ids = np.frombuffer(p.ids, "<u4").tolist()
        assert len(ids) == p.length > 0
        docs.setdefault(p.doc_id, []).append((p, ids))
        at.setdefault(p.sequence_id, []).append((p.offset, p.length))
    got = []
    for i, parts in docs.items():
        copies = sum(p.start == 0 for p, _ in parts)
        total = parts[0][0].doc_tokens
        assert sum(p.length for p, _ in parts) == copies * total
        if copies == 1:
            assert [p.start for p, _ in parts] == np.cumsum([0, *[p.length for p, _ in parts]])[:-1].tolist()
            got.append((str(i), [x for _, ids in parts for x in ids]))
    assert got and all(g in want for g in got)
    padding = 0
    for spans in at.values():
        spans.sort()
        assert [o for o, _ in spans] == np.cumsum([0, *[n for _, n in spans]])[:-1].tolist()
        used = sum(n for _, n in spans)
        assert used <= 1024
        padding += 0 if used & (used - 1) == 0 else 1024 - used
    return padding / sum(p.length for p in pieces)


def test_sample(sample, tokenizer):
    assert check(*sample, tokenizer) < 0.01


def test_edge_cases(documents, tokenizer):
    texts = [
        (1, None), (2, ""), (3, "  two  spaces \n\n here\t 　x  "), (4, "a" * 5000), (5, "<|endoftext|> don't  "),
        (6, " lead"), (7, "\n\n \nx \n y"), (8, "é 😀 ü\x85 \x1c z"), (9, "w " * 40_000), (None, "nothing"), (2, ""),
    ]
    check(documents(texts), texts, tokenizer)
    assert pack(documents(["a"]).limit(0), FILE).count() == 0


def test_words_keep_ids(tokenizer):
    cache = Words(FILE, limit=3)
    texts = ["a  b", "a \n b", "x\n y", " ", "", "  ", "\t a", "it's 3 $4 !? ok", "a  b", None, "a  b", "q" * 300, "foo  ", "a   ", "x y"]
    want = [tokenizer.encode(t or "", add_special_tokens=False).ids for t in texts]
    for t, ids in zip(texts, want):
        assert cache.encode(pa.array([t], pa.string()))[1].tolist() == ids
    bounds, ids = cache.encode(pa.array(texts))
    assert [ids[a:b].tolist() for a, b in zip(bounds, bounds[1:])] == want
    assert [len(x) for x in cache.encode(pa.array([], pa.string()))] == [1, 0]


def test_slices_hold_all_rows():
    batch = pa.RecordBatch.from_pydict({"text": ["a" * 10, None, "b" * 100, "", "c"]})
    for most in (1, 11, 50, 1000):
        parts = [p.column("text").to_pylist() for p in sliced(batch, "text", most)]
        assert sum(parts, []) == batch.column("text").to_pylist()
        assert all(len(p) == 1 or sum(len(t or "") for t in p) <= most for p in parts)


@pytest.mark.parametrize("length", [1, 31, 33, 511, 512, 1023, 1024, 1025, 5000])
def test_cut(length):
    sizes = harmonic_cut(length, 1024, 32)
    assert sum(sizes) == length
    assert all(s == 1024 // (1024 // s) or s <= 32 for s in sizes)


def test_cache_goes_with_the_step(documents, alive):
    """The workers that packed hold no words any more when they work on something else."""
    assert pack(documents(["some words"] * 9), FILE).count() > 0
    assert alive("rolecall.llm.packing.Words") == 0


def test_known_words_take_little_memory():
    """Words that come once do not pile up in a worker (F1)."""
    rng = random.Random(1)
    cache = Words(FILE)
    cache.encode(pa.array(["some words"]))
    tracemalloc.start()
    before = pa.total_allocated_bytes() + tracemalloc.get_traced_memory()[0]
    for _ in range(5):
        cache.encode(pa.array([" ".join("".join(rng.choices("abcdefghijklmnopqrst", k=9)) for _ in range(60_000))]))
    after = pa.total_allocated_bytes() + tracemalloc.get_traced_memory()[0]
    tracemalloc.stop()
    assert after - before < 24 << 20


def test_last_used_words_stay_known():
    cache = Words(FILE, limit=6)
    for text in ["x aa bb cc", "x aa dd ee", "x ff gg"]:
        cache.encode(pa.array([text]))
    known = cache.known.to_pylist()
    assert len(known) == len(cache.ids) == len(set(known)) == 6 and {" ff", " gg"} < set(known) and " cc" not in known
    assert len(cache.encode(pa.array([" ".join("abcdefghijkl")]))[1]) == 12


def test_words_beside_line_breaks_need_no_pattern(tokenizer, monkeypatch):
    """Letters and marks beside a single line break go to the model, with the same ids (F2)."""
    cache, words = Words(FILE), []
    monkeypatch.setattr(cache, "by_pattern", lambda w, f=cache.by_pattern: words.extend(w) or f(w))
    texts = ["One two.\nThree, four!!\nÉlan two.", "a\nb\nc", "it's a.\n'S b2\nc3 d4\n", "\na \nb\n\nc\td\r\ne \n f", "Two.\n...\nB"]
    bounds, ids = cache.encode(pa.array(texts[:2]))
    assert not words
    for some in (texts[:2], texts, texts[::-1]):
        bounds, ids = cache.encode(pa.array(some))
        assert [ids[a:b].tolist() for a, b in zip(bounds, bounds[1:])] == [tokenizer.encode(t, add_special_tokens=False).ids for t in some]
    assert "d4\n" in words


def test_random_texts_keep_ids(tokenizer):
    rng, cache = random.Random(2), Words(FILE, limit=20)
    parts = [*"ab", "The", "é", "don't", "'s", "<|endoftext|>", *"   \n\n\n\t\r\x0b\x1c\x85　.1_", "!?", "&&&", "日本", "\0"]
    for k in (parts, ["a", "Bc", "ß.", " ", " ", "\n", ",", "x9"]) * 20:
        texts = ["".join(rng.choices(k, k=rng.randrange(25))) for _ in range(50)]
        bounds, ids = cache.encode(pa.array(texts))
        assert [ids[a:b].tolist() for a, b in zip(bounds, bounds[1:])] == [tokenizer.encode(t, add_special_tokens=False).ids for t in texts]
