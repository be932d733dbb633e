"""The pipeline on the smallest data, stage by stage against brute force."""

import numpy as np
import pytest
import public_tokenizers
from tokenizers import Tokenizer

import corpus_pipeline
from checks.compare import database, differences
from rolecall.llm.decontam import words_of
from rolecall.llm.queries import ORACLE, QUERIES
from tests.llm.test_decontam import brute as brute_items
from tests.llm.test_secrets import brute as brute_secrets
from tests.llm.test_simhash import brute_components, brute_print

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    """Rows of documents and of every stage."""
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    out = [docs]
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF_DIR)
        docs = spark.createDataFrame(docs.collect(), docs.schema)
        out.append(docs)
    return out


def texts(rows):
    return {r.doc_id: r.text for r in rows.collect()}


def test_shape(stages):
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality", "near_duplicates", "decontamination", "secrets", "packing"]
    assert corpus_pipeline.ORACLE_SQL is None
    for rows in stages[1:-1]:
        assert rows.columns == stages[0].columns
        assert all(r.n_chars == len(r.text) for r in rows.collect())


def test_quality(spark, stages):
    quality = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF_DIR}/labels.parquet").collect()}
    before, after = texts(stages[0]), texts(stages[1])
    assert after.items() <= before.items()
    kept = [i in after for i, q in quality.items() if q]
    gone = [i not in after for i, q in quality.items() if not q]
    assert np.mean(kept) > 0.9 and np.mean(gone) > 0.8


def test_near_duplicates(stages):
    before, after = texts(stages[1]), texts(stages[2])
    prints = {i: brute_print(t) for i, t in before.items()}
    root = brute_components(set(prints.values()), 3)
    first = {}
    for i, p in prints.items():
        first[root[p]] = min(i, first.get(root[p], i))
    assert after == {i: before[i] for i in first.values()}


def test_decontamination(spark, stages):
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").collect()]
    before, after = texts(stages[2]), texts(stages[3])
    # The brute force is slow, so it looks at texts that share four words in a row with an item.
    grams = lambda t: {tuple(w[i : i + 4]) for w in [words_of(t.encode())] for i in range(len(w) - 3)}
    shared = set().union(*[grams(t) for _, t in items])
    near = [(i, t) for i, t in before.items() if grams(t) & shared]
    held = {i for i, _ in brute_items(near, items)}
    assert held and after == {i: t for i, t in before.items() if i not in held}


def test_secrets(stages):
    before, after = texts(stages[3]), texts(stages[4])
    assert before.keys() == after.keys()
    for i, text in before.items():
        want, at = "", 0
        for start, _, end, kind in brute_secrets(text):
            if start >= at:
                want += text[at:start] + f"<{kind}>"
            at = max(at, end)
        assert after[i] == want + text[at:]


def test_packing(stages):
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    tokenizer.encode_special_tokens = True
    got = {}
    for p in stages[5].orderBy("doc_id", "start").collect():
        assert p.start == len(got.setdefault(p.doc_id, []))
        got[p.doc_id] += np.frombuffer(p.ids, "<u4").tolist()
    assert got == {i: tokenizer.encode(t, add_special_tokens=False).ids + [0] for i, t in texts(stages[4]).items()}


def test_run(spark, stages):
    rows = corpus_pipeline.run(spark, SF_DIR)
    assert {r.doc_id for r in rows.select("doc_id").collect()} == set(texts(stages[4]))


def test_edge_cases(spark, documents):
    """NULLs, empty texts and repeated rows go through all stages."""
    base = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    odd = documents([(None, None), (None, ""), (900, None), (900, "w " * 3000), (901, "x"), (901, "x")])
    docs = base.unionByName(odd.select(*base.columns))
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF_DIR)
        docs = spark.createDataFrame(docs.collect(), docs.schema)
    assert docs.count()
    empty = base.limit(0)
    for _, stage in corpus_pipeline.STAGES:
        empty = stage(spark, empty, SF_DIR)
        empty = spark.createDataFrame(empty.collect(), empty.schema)
    assert empty.count() == 0


@pytest.mark.parametrize("key", ORACLE)
def test_oracle(spark, key):
    count, different = differences(QUERIES[key](spark, SF_DIR), database(SF_DIR), ORACLE[key])
    assert count and not different
