"""Ranked lexical search against scoring every pair."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from gridmart.llm import lexsearch

TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def terms(text):
    return TERM.findall((text or "").translate(LOWER))


def brute(docs, items, k=10):
    bags = [(d, Counter(terms(t)), len(terms(t))) for d, t in docs]
    bags = [b for b in bags if b[2]]
    n_docs, n_terms = len(bags), sum(b[2] for b in bags)
    df = Counter(t for _, bag, _ in bags for t in bag)
    out = []
    for item_id, text in set(items):
        asked, scored = Counter(terms(text)), []
        for d, bag, n in bags:
            m = 100 - 75 + (75 * n * n_docs) // n_terms
            score = 0
            for t, times in asked.items():
                if tf := bag[t]:
                    w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                    score += times * w * ((1_000_000_000 * tf) // (1000 * tf + 8 * m))
            if score > 0:
                scored.append((-score, d is None, d or 0, d))
        out += [(item_id, r, s[3], -s[0]) for r, s in enumerate(sorted(scored)[:k], 1)]
    return out


def in_order(rows):
    return sorted(map(tuple, rows), key=lambda r: (r[0] is None, r[0] or 0, r[1], r[3], r[2] is None, r[2] or 0))


@pytest.fixture()
def make_items(spark):
    return lambda rows: spark.createDataFrame(rows, "item_id long, text string")


def corpus(n, seed, words=60):
    rng = random.Random(seed)
    vocabulary = [f"w{k}" for k in range(words)] + ["Straße", "日本", "É", "x9"]
    return [(k, " ".join(rng.choices(vocabulary, weights=[1 / (j + 1) for j in range(len(vocabulary))], k=rng.choice((1, 5, 20, 300))))) for k in range(n)]


@pytest.mark.parametrize("seed_share", [1, 3, 10_000])
def test_equals_scoring_all_pairs(make_docs, make_items, monkeypatch, seed_share):
    monkeypatch.setattr(lexsearch, "BUCKET", 16)
    docs = corpus(400, 1)
    items = [(k, t) for k, t in corpus(25, 2)] + [(7, "w1 w2"), (7, "W2,w1;w59"), (8, "日本 É é nowhere")]
    got = lexsearch.search(make_docs(docs), make_items(items), seed_share=seed_share).collect()
    assert in_order(got) == in_order(brute(docs, items))


def test_odd_rows(make_docs, make_items, odd_rows, clashing):
    docs = odd_rows + [(None, "same text here"), (50, "a-b_c@d{e~f\x7fg"), (51, "A B C D")]
    items = [(1, "SAME text"), (2, None), (3, ""), (4, "--- !"), (5, "long a"), (6, "ünïcödé Ünïcödé b"), (1, "SAME text"), (None, "row repeated repeated")]
    got = lexsearch.search(clashing(make_docs(docs)), clashing(make_items(items)))
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    assert in_order(got.collect()) == in_order(brute(docs, items))


def test_ties_and_copies(make_docs, make_items):
    docs = [(k, "alpha beta gamma") for k in range(500, 0, -1)] + [(k, f"delta alpha x{k}") for k in range(600, 700)] + [(3, "alpha beta gamma")]
    items = [(1, "alpha beta"), (2, "delta delta gamma"), (3, "alpha")]
    got = lexsearch.search(make_docs(docs), make_items(items))
    assert in_order(got.collect()) == in_order(brute(docs, items))


def test_empty_tables(make_docs, make_items):
    for docs, items in (([], [(1, "a")]), ([(1, "a")], []), ([(1, None), (2, "")], [(1, "a")])):
        assert lexsearch.search(make_docs(docs), make_items(items)).collect() == []


def test_blocks_of_items(make_docs, make_items, monkeypatch):
    docs, items = corpus(60, 3), corpus(30, 4)
    blocks = list(lexsearch.items_in_blocks(make_items(items), block_items=7))
    assert len(blocks) == 5 and sorted(i for b in blocks for i in b.ids) == list(range(30))
    monkeypatch.setattr(lexsearch.items_in_blocks, "__defaults__", (7, 1000))
    assert in_order(lexsearch.search(make_docs(docs), make_items(items)).collect()) == in_order(brute(docs, items))


def test_long_texts_are_read_in_pieces(monkeypatch):
    text = ("Ünder_score  word9 " * 5000).encode()
    whole = [t for part in lexsearch.terms_of(text) for t in part]
    monkeypatch.setattr(lexsearch, "PIECE_BYTES", 100)
    assert [t for part in lexsearch.terms_of(text) for t in part] == whole == [t.encode() for t in terms(text.decode())]


def test_bounds_prune_and_lose_nothing():
    """Survivors hold every document that reaches theta, and are few where one document stands out."""
    rng = np.random.default_rng(5)
    size, rows = 200, 300
    dense = rng.integers(1, 1_000_000, (rows, size)) * (rng.random((rows, size)) < 0.05)
    dense[7, :10] = 900_000
    root = np.sqrt(rng.integers(1, 9000, size).astype(float))
    dense = dense[np.argsort(-np.linalg.norm(dense * root, axis=1), kind="stable")]
    doc, term = np.nonzero(dense)
    starts = np.searchsorted(doc, np.arange(rows + 1))
    bucket = lexsearch.Bucket(np.linalg.norm(dense * root, axis=1), starts, term, dense[doc, term], root, size)
    asked = np.arange(10)
    exact = (dense[:, :10] * root[:10] ** 2).sum(axis=1)
    for rank in (1, 3, 10, 50):
        theta = float(np.sort(exact)[-rank])
        found = bucket.survivors(asked, root[:10], theta)
        assert set(np.flatnonzero(exact >= theta)) <= set(found)
        if rank == 1:
            assert len(found) < 5


def test_documents_are_read_once_and_not_shuffled(documents):
    vocabulary = lexsearch.Items.of([(1, "the of and")]).vocabulary
    plan = lexsearch.sparse_documents(documents, vocabulary)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and plan.count("Scan parquet") == 1
