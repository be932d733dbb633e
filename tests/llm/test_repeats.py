import random

import pytest

from rolecall.llm.repeats import Heads, repeated_spans, word_hashes


def windows(words, n):
    return [tuple(words[i : i + n]) for i in range(len(words) - n + 1)]


def covered(docs, n):
    """For each row, the places of words inside a stretch of n words that occurs twice."""
    count = {}
    split = [(t or "").encode().split() for _, t in docs]
    for words in split:
        for w in windows(words, n):
            count[w] = count.get(w, 0) + 1
    return [{i + j for i, w in enumerate(windows(words, n)) if count[w] > 1 for j in range(n)} for words in split]


@pytest.fixture(scope="module")
def docs():
    rng = random.Random(6)
    word = lambda: "".join(rng.choices("abcdefgh", k=4))
    text = lambda n: [word() for _ in range(n)]
    shared = [text(n) for n in (50, 51, 64, 120, 49, 40, 30)]
    out = []
    for _ in range(120):
        words = text(rng.randint(0, 150))
        for passage in rng.sample(shared, rng.randint(0, 2)):
            at = rng.randint(0, len(words))
            words[at:at] = passage
        out.append(words)
    base = text(200)
    out += [base, base, base[:90] + ["x"] + base[90:], base[20:75], ["é", "😀"] * 60, text(60) * 2, shared[0], ["same"] * 300]
    rows = [(i, "  ".join(w)) for i, w in enumerate(out)]
    return [*rows, (None, " ".join(shared[2])), (900, None), (901, ""), (5, rows[5][1]), (902, " ".join(text(30_000) + shared[1]))]


@pytest.mark.parametrize("largest_run", [20_000, 3])
def test_against_brute_force(documents, docs, largest_run):
    got = {}
    for r in repeated_spans(documents(docs), largest_run=largest_run).collect():
        got.setdefault(r.doc_id, set()).add((r.start, r.n_words, r.text))
    for (doc_id, text), want in zip(docs, covered(docs, 50)):
        words = (text or "").split()
        places = set()
        for start, n, passage in got.get(doc_id, ()):
            assert n >= 50 and passage == " ".join(words[start : start + n])
            places |= set(range(start, start + n))
        assert places == want, doc_id


def anchored(rng, n, last):
    """A passage that has an anchor on its first or last place, whatever stands on its other side."""
    while True:
        words = ["".join(rng.choices("abcdefgh", k=6)) for _ in range(n)]
        own = Heads(35, 16).hashes(word_hashes(" ".join(words).encode()))
        if own.argmin() == (len(own) - 1 if last else 0) and own.min() < 2**56:
            return words


@pytest.mark.parametrize("largest_run", [20_000, 3])
@pytest.mark.parametrize("last", [False, True])
@pytest.mark.parametrize("n", [49, 50, 51])
def test_shared_first_and_last_words(documents, n, last, largest_run):
    rng = random.Random(9)
    shared = anchored(rng, n, last)
    texts, want = [], set()
    for i in range(8):
        own = ["".join(rng.choices("stuvwxyz", k=6)) for _ in range(60 + i)]
        texts.append(" ".join(own + shared if last else shared + own))
        want |= {(i, len(own) if last else 0, n, " ".join(shared))} if n >= 50 else set()
    assert {tuple(r) for r in repeated_spans(documents(texts), largest_run=largest_run).collect()} == want


@pytest.mark.parametrize("largest_run", [20_000, 3])
def test_short_repeats_side_by_side_are_none(documents, largest_run):
    """Neither two short repeats in a row, nor one that is longer to the left in one place and
    to the right in another, make a passage."""
    rng = random.Random(4)
    text = lambda n: ["".join(rng.choices("abcdefgh", k=6)) for _ in range(n)]
    rows = []
    for _ in range(20):
        one, two = text(45), text(45)
        rows += [text(30) + one + two + text(30), text(30) + one + text(30), text(30) + two + text(30)]
        left, core, right = text(9), text(38), text(9)
        rows += [text(30) + left + core + right + text(30), text(30) + left + core + text(30), text(30) + core + right + text(30)]
    assert repeated_spans(documents([" ".join(r) for r in rows]), largest_run=largest_run).count() == 0


@pytest.mark.parametrize("largest_run", [20_000, 3])
def test_copies_that_share_nothing_with_other_texts(documents, largest_run):
    rng = random.Random(8)
    one, few, alone = (" ".join("".join(rng.choices("abcdefgh", k=6)) for _ in range(n)) for n in (50, 49, 90))
    got = repeated_spans(documents([one, few, one, alone, few, one]), largest_run=largest_run).collect()
    assert sorted(map(tuple, got)) == [(i, 0, 50, one) for i in (0, 2, 5)]


def test_nothing(documents, spark):
    assert repeated_spans(documents([None, "", "a b c", "word " * 49])).count() == 0
    assert repeated_spans(documents(["a"]).limit(0)).count() == 0
