"""Language identification against a plain Kneser-Ney model, and on held-out documents."""

import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from gridmart.llm import langid

LABELLED = "doc_id long, text string, lang string"


def symbols(text):
    out = []
    for c in text or "":
        if c.isalpha():
            out.append(c.lower()[0])
        elif out and out[-1] != " ":
            out.append(" ")
    return "".join(out + [" "] if out and out[-1] != " " else out)


def plain_model(texts, order):
    """context -> (discounted shares by symbol, mass handed down), by length of the context."""
    bodies = [" " * (order - 1) + symbols(t) for t in texts if symbols(t)]
    counts = Counter(b[i - order + 1 : i + 1] for b in bodies for i in range(order - 1, len(b)))
    levels = []
    for n in range(order, 0, -1):
        if n < order:
            counts = Counter(g[1:] for g in counts)
        by_context = defaultdict(dict)
        for gram, c in counts.items():
            by_context[gram[:-1]][gram[-1]] = c
        once, twice = sum(c == 1 for c in counts.values()), sum(c == 2 for c in counts.values())
        d = min(0.95, max(0.05, once / max(1, once + 2 * twice)))
        levels.append({h: ({s: max(c - d, 0) / sum(of.values()) for s, c in of.items()}, d * len(of) / sum(of.values())) for h, of in by_context.items()})
    return levels[::-1]


def plain_bits(levels, text, size):
    order, total = len(levels), 0
    body = " " * (order - 1) + symbols(text)
    for i in range(order - 1, len(body)):
        p = 1 / size
        for n, level in enumerate(levels):
            if (h := body[i - n : i]) in level:
                shares, mass = level[h]
                p = shares.get(body[i], 0.0) + mass * p
        total += round(-math.log2(p) * langid.UNIT)
    return total


def words(seed, letters, n):
    rng = random.Random(seed)
    return " ".join("".join(rng.choices(letters, k=rng.randint(1, 7))) for _ in range(n))


@pytest.mark.parametrize("order", [1, 2, 4])
def test_costs_equal_a_plain_model(order):
    texts = {g: [words(f"{g}{k}", letters, 30) + "! Ü9" for k in range(6)] for g, letters in (("a", "abcdé"), ("b", "cdefgß"))}
    fitted = [langid.count_orders([langid.fold(t) for t in texts[g]], order) for g in "ab"]
    size = len({s for g in "ab" for t in texts[g] for s in symbols(t)}) + 1
    model = langid.Model(["a", "b"], fitted, size)
    plain = [plain_model(texts[g], order) for g in "ab"]
    asked = [words(k, "abcdefgxyz", 12) for k in range(20)] + ["", None, "123 !", "x", "ABC abc", *texts["a"], "日本語 é", " lead", "trail - "]
    lengths, total = langid.Costs(model).of_texts(asked)
    assert lengths.tolist() == [len(symbols(t)) for t in asked]
    for row, text in zip(total.tolist(), asked, strict=True):
        for got, levels in zip(row, plain, strict=True):
            assert abs(got - plain_bits(levels, text, size)) <= len(symbols(text))  # a rounding of each symbol


def test_probabilities_sum_to_one():
    texts = [words(k, "abcde", 40) for k in range(5)]
    fitted = langid.count_orders([langid.fold(t) for t in texts], 3)
    alphabet = sorted({s for t in texts for s in symbols(t)})
    model = langid.Model(["a"], [fitted], len(alphabet))
    for context in ("ab", "zz", " a", "e "):
        hashes = [langid.chain(np.array([0 if s == " " else ord(s) for s in context + c], np.uint32), 3) for c in alphabet]
        bits = [model.bits(h, np.array([2]))[0, 0] / langid.UNIT for h in hashes]
        assert abs(sum(2.0**-b for b in bits) - 1) < 1e-4


def test_costs_do_not_depend_on_slices_or_memory(monkeypatch):
    texts = [words(k, "abcdefgh", 50) for k in range(30)] + [words(99, "abc", 3000)]
    model = langid.Model(["a", "b"], [langid.count_orders([langid.fold(t) for t in part]) for part in (texts[:10], texts[10:])], 12)
    whole = langid.Costs(model).of_texts(texts)
    for size, known in ((7, langid.KNOWN), (100, 50), (1 << 20, 0)):
        monkeypatch.setattr(langid, "KNOWN", known)
        costs = langid.Costs(model)
        costs.slice = size
        for got, expected in zip(costs.of_texts(texts), whole, strict=True):
            assert np.array_equal(got, expected)


def labelled(n, seed=0):
    kinds = {"xx": "abcdefg", "yy": "mnopqrs", "zz": "éüßñø"}
    rng = random.Random(seed)
    return [(k, words(f"{seed}{k}", letters, rng.choice((1, 8, 60))), lang) for k in range(n) for lang, letters in [rng.choice(sorted(kinds.items()))]]


def is_held_out(doc_id):
    return zlib.crc32(str(doc_id).encode()) % 5 == 0


def test_learns_and_rejects(spark):
    docs = spark.createDataFrame(labelled(1200), LABELLED).repartition(3)
    model = langid.train(docs)
    assert model.languages == ["xx", "yy", "zz"]
    got = {r["doc_id"]: r for r in langid.identify(docs, model).collect()}
    assert sum(got[k]["lang_pred"] == lang for k, _, lang in labelled(1200)) >= 1190
    assert all(0 <= r["score"] <= 1 for r in got.values())
    assert np.mean([r["rejected"] for r in got.values()]) < 0.05
    foreign = spark.createDataFrame([(1, words(5, "tuvwxyz", 60), None), (2, words(6, "ΑΒΓδεζ", 60), None)], LABELLED)
    assert all(r["rejected"] and r["cross_entropy"] is not None for r in langid.identify(foreign, model).collect())


def test_only_text_and_language_of_training_rows_count(spark):
    rows = labelled(400)
    changed = [(k, "mmmm nnnn" if is_held_out(k) else t, "qq" if is_held_out(k) else lang) for k, t, lang in rows]
    asked = spark.createDataFrame(labelled(50, seed=3), LABELLED)
    results = []
    for table in (rows, changed, rows + [(None, "other text", "nn"), (1, "unlabelled", None), (2, "123", "digits"), (3, None, "nothing")], rows + rows):
        model = langid.train(spark.createDataFrame(table, LABELLED).repartition(2))
        results.append(sorted(map(tuple, langid.identify(asked, model).collect())))
    assert results[0] == results[1] == results[2] == results[3]


def test_odd_rows(make_docs, odd_rows, clashing):
    rows = odd_rows + [(30, "123 !? 456"), (31, "ǅ"), (32, "٣")]
    docs = clashing(make_docs(rows)).withColumns({"lang_pred": F.lit("?"), "cross_entropy": F.lit("?"), "symbols": F.lit(1)})
    out = langid.identify(docs, langid.train(docs))
    assert out.columns == ["doc_id", "lang_pred", "score", "cross_entropy", "rejected"]
    got = out.collect()
    assert len(got) == len(rows)
    blank = {2, 3, 30, 32}
    for r in got:
        assert r["lang_pred"] == ("und" if r["doc_id"] in blank | {1} else "en")
        assert (r["score"], r["rejected"], r["cross_entropy"]) == (0.0, True, None) if r["lang_pred"] == "und" else 0 <= r["score"] <= 1


def test_without_labels_and_empty(spark, make_docs):
    docs = spark.createDataFrame([(1, "some text", None), (2, None, "en")], LABELLED)
    assert langid.train(docs) is None
    assert [tuple(r)[1:] for r in langid.identify(docs, None).collect()] == [("und", 0.0, None, True)] * 2
    empty = make_docs([])
    assert langid.identify(empty, langid.train(empty)).collect() == []


def test_ties_and_single_documents(spark):
    docs = spark.createDataFrame([(k, "the same words", lang) for k, lang in ((1, "b"), (2, "a"), (3, "c"))], LABELLED)
    assert not any(map(is_held_out, (1, 2, 3)))
    got = langid.identify(docs, langid.train(docs)).collect()
    assert {r["lang_pred"] for r in got} == {"a"} and all(abs(r["score"] - 1 / 3) < 1e-9 for r in got)


def test_sample_is_bounded(spark):
    """Repeated rows count once, and the rows of a language are cut by hash, whatever its size."""
    rows = [(1, "one hot row", "en")] * 3000 + [(k, f"text {words(k, 'abc', 3)}", "en") for k in range(2, 3000)] + [(k, words(k, "xyz", 3), "es") for k in range(5000, 5040)]
    sample = langid.sample_rows(spark.createDataFrame(rows, LABELLED), rows=100, languages=5)
    sizes = {r["lang"]: r["count"] for r in sample.groupBy("lang").count().collect()}
    assert 50 <= sizes["en"] <= 170 and sizes["es"] == sum(not is_held_out(k) for k in range(5000, 5040))
    assert langid.train(spark.createDataFrame(rows, LABELLED), languages=1).languages == ["en"]


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    found = langid.identify(docs, langid.train(docs)).join(docs.select("doc_id", "lang"), "doc_id").where(langid.held_out(F.col("doc_id")))
    right, all_rows = found.agg(F.count_if(F.col("lang") == F.col("lang_pred")), F.count("*")).first()
    assert right >= 0.99 * all_rows
