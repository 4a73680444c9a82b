import zlib

import numpy as np
import pytest

from gridmart.llm import mil as M


@pytest.fixture(scope="module")
def bags():
    """Bags that are good unless one of their passages is bad in one feature."""
    rng = np.random.default_rng(2)
    x, starts, y = [], [], []
    for _ in range(400):
        n = rng.integers(1, 9)
        rows = rng.normal(0, 1, (n, M.N_FEATURES))
        good = rng.random() < 0.6
        if not good:
            rows[rng.integers(n), 3] += 6
        starts.append(sum(map(len, x)))
        x.append(rows)
        y.append(float(good))
    return np.concatenate(x), np.array(starts), np.array(y)


def test_attention_finds_the_passage_that_decides(bags):
    x, starts, y = bags
    model = M.fit(x, starts, y)
    p, (_, _, _, _, attention, _, sizes) = M.forward(model, x, starts)
    assert ((p >= 0.5) == y).mean() > 0.97
    assert np.allclose(np.add.reduceat(attention, starts), 1)
    bad = [k for k in range(len(starts)) if not y[k] and sizes[k] > 2]
    hits = [np.argmax(attention[starts[k] : starts[k] + sizes[k]]) == np.argmax(x[starts[k] : starts[k] + sizes[k], 3]) for k in bad]
    assert np.mean(hits) > 0.9


def test_gradient_equals_finite_differences(bags):
    x, starts, y = bags
    n = starts[20]
    x, starts, y = x[:n], starts[:20], y[:20]

    def loss(model):
        p = M.forward(model, x, starts)[0]
        return -np.mean(y * np.log(p) + (1 - y) * np.log(1 - p))

    # One Adam step moves every weight by the learning rate against the sign of its gradient.
    zero, one = M.fit(x, starts, y, epochs=0), M.fit(x, starts, y, epochs=1)
    for name in ("W", "V", "U", "w", "c", "c0", "b"):
        flat = zero[name].reshape(-1)
        for at in range(0, flat.size, max(1, flat.size // 5)):
            step = np.zeros_like(flat)
            step[at] = 1e-6
            up, down = ({**zero, name: (flat + s * step).reshape(zero[name].shape)} for s in (1, -1))
            slope = (loss(up) - loss(down)) / 2e-6 + 1e-5 * flat[at]
            if abs(slope) > 1e-5:
                assert np.sign(zero[name].reshape(-1)[at] - one[name].reshape(-1)[at]) == np.sign(slope), (name, at)


def test_passages_of_whole_texts():
    words = M.Vocabulary()
    assert M.passages(None, words).shape == M.passages(" \n", words).shape == (1, M.N_FEATURES)
    assert len(M.passages("w " * 64, words)) == 1 and len(M.passages("w " * 65, words)) == 2
    assert len(M.passages("long text " * 50000, words)) == -(-100000 // M.PASSAGE)
    row = M.passages("AB! AB! AB! AB! 12 #", words)[0]
    assert row[2] == pytest.approx(4 / 6) and row[M.N_WORD] == pytest.approx(3 / 6)


def test_a_small_memory_changes_nothing(monkeypatch):
    texts = [f"word{i} other{i % 7} # THE the." * 9 for i in range(50)]
    want = [M.passages(t, M.Vocabulary()) for t in texts]
    monkeypatch.setattr(M, "CACHE_WORDS", 5)
    words = M.Vocabulary()
    assert all(np.array_equal(M.passages(t, words), w) for t, w in zip(texts, want, strict=True))


def test_held_out_accuracy(spark):
    base = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{base}/{t}.parquet") for t in ("documents", "labels"))
    model = M.train(docs, labels)
    rows = M.score(docs, model)
    rows = rows.where(M.held_out(rows.doc_id)).join(labels, "doc_id").collect()
    assert len(rows) > 40
    good, bad = ([r.score for r in rows if r.quality == q] for q in (1, 0))
    assert np.mean([g > b for g in good for b in bad]) > 0.97
    assert np.mean([s >= 0.3 for s in good]) > 0.95 and np.mean([s < 0.3 for s in bad]) > 0.8


def test_held_out_labels_are_never_used(documents, spark, sf001):
    labels = spark.read.parquet(f"{sf001}/labels.parquet")
    flipped = labels.withColumn("quality", M.F.when(M.held_out(M.F.col("doc_id")), 1 - labels.quality).otherwise(labels.quality))
    a, b = (M.train(documents, x) for x in (labels, flipped))
    assert all(np.array_equal(a[k], b[k]) for k in a)


def test_the_sample_is_a_bound(make_docs, spark, monkeypatch):
    seen = []
    monkeypatch.setattr(M, "fit", lambda x, starts, y: seen.append((len(x), len(starts), sorted(y))))
    rows = [(1, f"one of many texts {k}") for k in range(3000)] + [(k, "word " * 64 * 50) for k in range(2, 9)]
    labels = spark.createDataFrame([(k, k % 2) for k in range(1, 9)], "doc_id long, quality int")
    known = [k for k in range(1, 9) if zlib.crc32(str(k).encode()) % 5]
    M.train(make_docs(rows, 5), labels, bag=20)
    n, bags, y = seen[0]
    assert bags == len(known) and y == sorted(float(k % 2) for k in known)
    assert n == sum(1 if k == 1 else 20 for k in known)
    M.train(make_docs(rows, 4), labels, sample=3)
    assert seen[1][1] == 3


def test_which_repeated_row_is_learned_from_is_fixed(make_docs, spark):
    rows = [(k % 12, f"text {k} " * (1 + k % 40)) for k in range(240)]
    labels = spark.createDataFrame([(k, k % 2) for k in range(12)], "doc_id long, quality int")
    a, b = (M.train(make_docs(r, n), labels) for r, n in ((rows, 3), (rows[::-1], 7)))
    assert all(np.array_equal(a[k], b[k]) for k in a)


def test_odd_rows_and_missing_labels(odd_rows, make_docs, clashing, spark):
    docs = clashing(make_docs(odd_rows))
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert M.train(docs, none) is None
    rows = M.score(docs, None).collect()
    assert len(rows) == len(odd_rows) and {r.score for r in rows} == {0.5}
    some = spark.createDataFrame([(i, int(i % 2)) for i in range(1, 12)] + [(4, None), (None, 1), (5, 1)], "doc_id long, quality int")
    model = M.train(docs, some)
    assert all(0 <= r.score <= 1 for r in M.score(docs, model).collect())
    assert M.score(make_docs([]), model).count() == 0
