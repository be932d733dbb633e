import hashlib
import re

from rolecall.llm.secrets import RULES, digest, find_secrets, redact, trigram_query

ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A
)


def brute(text):
    spans = [(m.start(), 0, m.end(), "assign") for m in ASSIGN.finditer(text) if len(m[2]) >= 8]
    spans += [(m.start(), 1, m.end(), "access") for m in re.finditer(r"AKIA[A-Z0-9]+", text) if len(m[0]) >= 16]
    spans += [(m.start(), 2, m.end(), "hex") for m in re.finditer(r"[0-9a-f]+", text) if len(m[0]) >= 32]
    return sorted(spans)


def digest_of(spans):
    return hashlib.sha256(",".join(f"{k}:{a}:{b}" for a, _, b, k in spans).encode()).hexdigest()


TEXTS = [
    None,
    "",
    "nothing here",
    "é😀 password = 'abcdefgh12' and Token:short1 then API_KEY=zzzzzzzzzz",
    "token=secret : abcdefgh12 token=secret=abcdefgh12",
    "AKIAAB AKIA" + "A1" * 8 + " xAKIAAKIA" + "B" * 12,
    "f" * 31 + " " + "0a" * 16 + "g" + "1" * 40,
    'secret="' + "0af1" * 10 + '"',
    "PASSWD  :  a.b.c.d.e",
    "-----BEGIN RSA PRIVATE KEY----- ghp_" + "Zz" * 18 + " eyJabcdefgh.eyJabcdefgh.abcdefgh",
    "word " * 30_000 + "token: 0123456789",
]


def test_against_brute_force(documents):
    rows = documents([*enumerate(TEXTS), (None, TEXTS[3]), (3, TEXTS[3]), (3, TEXTS[4])])
    got = digest(find_secrets(rows)).collect()
    assert len(got) == len(TEXTS) + 3
    want = sorted(
        [(str(i), digest_of(brute(t or ""))) for i, t in enumerate(TEXTS)]
        + [("None", digest_of(brute(TEXTS[3]))), ("3", digest_of(brute(TEXTS[3]))), ("3", digest_of(brute(TEXTS[4])))]
    )
    assert sorted((str(r.doc_id), r.base_sha256) for r in got) == want
    by_id = {r.doc_id: r for r in got}
    assert (by_id[7].n_assign, by_id[7].n_access, by_id[7].n_hex) == (1, 0, 1)
    assert [s.split(":")[0] for s in by_id[9].spans.split(",")] == ["private_key", "github", "jwt"]


def test_sample(sample):
    rows, texts = sample
    got = {r.doc_id: r.base_sha256 for r in digest(find_secrets(rows)).collect()}
    assert got == {i: digest_of(brute(t or "")) for i, t in texts}


def test_queries():
    queries = {r.kind: trigram_query(r.pattern) for r in RULES}
    assert queries["hex"] == []
    assert queries["access"] == [[frozenset({"aki", "kia"})]]
    words = {"password", "passwd", "secret", "token", "apikey", "api_key"}
    assert {frozenset(w[i : i + 3] for i in range(len(w) - 2)) for w in words} == set(queries["assign"][0])
    assert trigram_query(r"a|bcd") == [] and trigram_query(r"(abc)+x") == [[frozenset({"abc"})]]


def test_every_match_meets_its_query():
    for text in TEXTS:
        low = (text or "").lower()
        for rule in RULES:
            if re.search(rule.pattern, text or ""):
                assert all(any(all(t in low for t in s) for s in c) for c in trigram_query(rule.pattern))


def test_redact(documents):
    out = {r.doc_id: r for r in redact(documents(TEXTS)).collect()}
    assert out[0].text is None and out[2].text == "nothing here"
    assert out[3].text == "é😀 <assign>' and Token:short1 then <assign>"
    assert out[3].n_chars == len(out[3].text)
    assert out[7].text == '<assign>"'  # the hex run lies inside
    assert out[2].found == "x"


def test_native(sample):
    plan = find_secrets(sample[0])._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_no_rows(documents):
    assert find_secrets(documents(["a"]).limit(0)).count() == 0
