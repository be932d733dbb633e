import itertools
import math
import random
import re

import numpy as np
import pytest

from rolecall.llm.rules import FLOORS, chi_square, mcd_estimates, quality_rules

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    text = text or ""
    words = WORD.findall(text)
    lines = [line for line in text.split("\n") if WORD.search(line)]
    seen, dup = set(), 0
    for line in lines:
        dup += line in seen
        seen.add(line)
    grams = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    count = {}
    for g in grams:
        count[g] = count.get(g, 0) + 1
    inside = {i + j for i, g in enumerate(grams) if count[g] > 1 for j in range(3)}
    n = len(words)
    failed = n < 50 or 100 * len(inside) > 50 * n
    return n, sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(inside), failed


def stats(r):
    return r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed


def test_base_statistics(documents, sample):
    rows, texts = sample
    want = {i: brute(t) for i, t in texts}
    assert {r.doc_id: stats(r) for r in quality_rules(rows).collect()} == want
    odd = [
        None, "", "   ", "a b c", "a b c a b c", "x x x x", "a b c d a b c", " lead\n\nlead\n lead\nlead \n\v",
        "é 😀 $ # a|b c\n\n", "w " * 20_000, "a b " * 100, " ".join(map(str, range(30_000))),
    ]
    got = {r.doc_id: r for r in quality_rules(documents([*odd])).collect()}
    assert {i: stats(r) for i, r in got.items()} == {i: brute(t) for i, t in enumerate(odd)}
    assert not any(r.kept for r in got.values() if r.base_failed)


def prose(rng, n):
    return " ".join("".join(rng.choices("abcdefghij", k=rng.randint(2, 8))) for _ in range(n))


def test_outliers(spark):
    rng = random.Random(2)
    good = [prose(rng, int(math.exp(rng.gauss(5.5, 0.5))) + 60) for _ in range(300)]
    bad = [" ".join(w + "###" for w in prose(rng, 200).split()) for _ in range(30)]
    bad += [prose(rng, 200).upper().replace(" ", "!! ") for _ in range(20)]
    texts = good + bad
    rows = [(i, t, "en" if i % 2 else None, "a") for i, t in enumerate(texts)]
    rows += [(1000 + i, "solo " + prose(rng, 80) + "#" * 300, "xx", "b") for i in range(3)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    kept = {r.doc_id: r.kept for r in quality_rules(docs).collect()}
    assert len(kept) == len(rows)
    assert all(kept[i] for i in range(300)) and not any(kept[i] for i in range(300, 350))
    # A group too small for an estimate of its own is judged by all rows.
    assert not any(kept[1000 + i] for i in range(3))


def test_each_statistic_rejects_alone(spark):
    rng = random.Random(5)
    lines = lambda n: "\n".join(prose(rng, 8) for _ in range(n))
    words = lambda: prose(rng, 200).split()
    again = prose(rng, 90)
    bad = {
        "length": lines(20_000),
        "word": "\n".join(" ".join(w * 8 for w in line.split()) for line in lines(25).split("\n")),
        "symbols": "### ".join(words()),
        "lines": "\n".join(f"mmmm\nnnnnn\n{w}" for w in words()),
        "repeats": lines(23) + "\n" + again.replace(" ", "  ") + "\n" + again,
        "upper": lines(25).upper(),
        "marks": "!! ".join(words()),
    }
    rows = [(i, lines(rng.randint(15, 40)), "en", "a") for i in range(200)]
    rows += [(1000 + i, text, "en", "a") for i, text in enumerate(bad.values())]
    out = quality_rules(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string"))
    got = {r.doc_id: r for r in out.collect()}
    assert all(got[i].kept for i in range(200))
    kept = {name: (got[1000 + i].kept, got[1000 + i].base_failed) for i, name in enumerate(bad)}
    assert kept == dict.fromkeys(bad, (False, False))


def ranked(values, share):
    """The value at that share of the order, as in the operator's percentiles."""
    return np.sort(values)[max(math.ceil(share * len(values)) - 1, 0)]


def far(x, m, c):
    return np.einsum("ij,jk,ik->i", x - m, np.linalg.inv(c), x - m)


def plain_mcd(x, floors, share=0.75):
    """Centre and covariance before scaling, and the logarithm of its determinant."""
    k, floor = x.shape[1], np.diag(np.square(floors))
    m = np.array([ranked(x[:, i], 0.5) for i in range(k)])
    s = 1.4826 * np.array([ranked(abs(x[:, i] - m[i]), 0.5) for i in range(k)])
    z = (x - m) / np.sqrt(s**2 + np.square(floors))
    with np.errstate(all="ignore"):
        u = z / np.maximum(np.linalg.norm(z, axis=1), 1e-9)[:, None]
        b = u.T @ u
        likeness = [np.eye(k), np.corrcoef(np.tanh(z).T), b / np.sqrt(np.outer(np.diag(b), np.diag(b)))]

    def step(m, c):
        d = far(x, m, c)
        near = x[d <= ranked(d, share)]
        return near.mean(0), np.cov(near.T, bias=True) + floor

    ends = []
    for r in likeness:
        r = np.nan_to_num(r)
        np.fill_diagonal(r, 1)
        ends.append(step(*step(m, r * np.outer(s, s) + floor)))
    size = lambda e: np.linalg.slogdet(e[1])[1]
    best = min(ends, key=size)
    while size(after := step(*best)) < size(best) - 1e-6:
        best = after
    return *best, size(best)


def plain_distance(x, floors):
    m, c, _ = plain_mcd(x, floors)
    d = far(x, m, c)
    return d / max(ranked(d, 0.5) / chi_square(0.5, x.shape[1]), 1)


def vector(r, text):
    words, chars = max(r.n_words, 1), max(r.word_chars, 1)
    upper = sum(c.isupper() for c in text)
    return [
        math.log1p(r.n_words), math.log1p(r.word_chars / words), math.sqrt(r.n_symbols / chars),
        math.sqrt(r.n_dup_lines / (text.count("\n") + 1)), math.sqrt(r.n_repeat_words / words),
        math.sqrt(upper / chars), math.sqrt(sum(c in "!?" for c in text) / chars),
    ]


def test_verdicts_by_a_plain_run(spark):
    """Large groups, small ones pooled by language, a language pooled with all rows."""
    rng = random.Random(8)
    sizes = {("en", "a"): 60, ("en", None): 30, ("en", "b"): 6, ("en", ""): 5, (None, "a"): 25, ("fr", "a"): 4, ("fr", "c"): 3}
    rows = []
    for (lang, source), n in sizes.items():
        for i in range(n):
            text = "\n".join(prose(rng, rng.randint(5, 12)).capitalize() for _ in range(rng.randint(8, 30)))
            text += "?" * rng.randint(0, 9) + "$ " * rng.randint(0, 9) + ("#%" * 400 if i == 2 else "")
            rows.append((len(rows), text, lang, source))
    rows.append((len(rows), "short", "xx", "z"))
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").repartition(3)
    got = {r.doc_id: r for r in quality_rules(docs).collect()}
    x = {i: vector(got[i], t) for i, t, *_ in rows if not got[i].base_failed}
    n = {g: sum(i in x for i, _, *h in rows if tuple(h) == g) for g in sizes}
    floors, cutoff = list(FLOORS.values()), chi_square(1 - 1e-7, 7)
    for group in sizes:
        lang_rows = sum(v for g, v in n.items() if g[0] == group[0])
        whole = lambda h: h == group if n[group] >= 20 else h[0] == group[0] if lang_rows >= 20 else True
        pool = [i for i, _, *h in rows if i in x and whole(tuple(h))]
        want = dict(zip(pool, plain_distance(np.array([x[i] for i in pool]), floors)))
        for i, _, *h in rows:
            if tuple(h) == group and i in x:
                assert got[i].distance == pytest.approx(want[i], rel=1e-4, abs=1e-6)
                assert got[i].kept == (want[i] <= cutoff)
    assert got[len(rows) - 1].distance is None and not got[len(rows) - 1].kept
    assert sum(not r.kept for r in got.values() if not r.base_failed) >= len(sizes)


def test_smallest_determinant_of_all_subsets(spark):
    """Few rows with a tilted core and far rows on its side: the best of all subsets is found."""
    rng = np.random.default_rng(4)
    core = rng.normal(size=(9, 1)) @ [[1.0, 0.9]] + rng.normal(scale=0.1, size=(9, 2))
    x = np.vstack([core, [[3.0, -3.0], [3.2, -2.9], [2.8, -3.1]]])
    rows = spark.createDataFrame([("p", *map(float, v)) for v in x], "pool string, a double, b double")
    found = mcd_estimates(rows, ["a", "b"], [0.01, 0.01]).first()
    floor = np.eye(2) * 1e-4
    least = min(
        np.linalg.slogdet(np.cov(x[list(s)].T, bias=True) + floor)[1] for s in itertools.combinations(range(12), 9)
    )
    assert found.n == 12 and found.logdet == pytest.approx(least, abs=1e-6)
    assert found.logdet == pytest.approx(plain_mcd(x, [0.01, 0.01])[2], abs=1e-6)


def test_native_and_empty(documents):
    out = quality_rules(documents(["a"]).limit(0))
    assert out.count() == 0
    assert "Python" not in out._jdf.queryExecution().toString()
