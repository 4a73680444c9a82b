"""Fill-in-middle transformation against plain slicing."""

import hashlib

import pytest
from pyspark.sql import functions as F

from gridmart.llm import fim


def expected(doc_id, text, seed=1, fim_percent=90, spm_percent=20, markers=("<P>", "<S>", "<M>")):
    text = text or ""
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[8 * k : 8 * k + 8], 16) for k in range(4)]
    n = len(text)
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    if not text or any(m in text for m in markers) or h[2] % 100 >= fim_percent:
        return (doc_id, n, "plain", None, None, text)
    pre, mid, suf = text[:a], text[a:b], text[b:]
    p, s, m = markers
    if h[3] % 100 < spm_percent:
        return (doc_id, n, "spm", a, b - a, s + suf + p + pre + m + mid)
    return (doc_id, n, "psm", a, b - a, p + pre + s + suf + m + mid)


ROWS = [
    (20, "a$1 \\2 <p> $$ \\"), (21, "line\nline\r\n end"), (22, "😀" * 9000), (23, "é" * 64), (24, "with <S> inside"),
    (25, "x" * 4096), (26, "y" * 4097), (27, "z" * 63), (28, "<"), (29, "<P"), (-5, "negative id"), (2**62, "large id"),
]


def test_equals_slicing(make_docs, odd_rows, clashing):
    rows = odd_rows + ROWS + [(k, "déjà vu\n" * (k % 7) + "x" * k) for k in range(100, 400)]
    docs = clashing(make_docs(rows)).withColumns({"n": F.lit(1), "form": F.lit("?"), "output": F.lit("?"), "digest": F.lit("?")})
    out = fim.transform(docs)
    assert out.columns == ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"]
    key = lambda r: (r[0] is not None, r[0] or 0, r[5])
    assert sorted(map(tuple, out.collect()), key=key) == sorted((expected(*r) for r in rows), key=key)


def test_restores(make_docs, odd_rows):
    rows = odd_rows + ROWS + [(k, "<" * (k % 5) + "P>S>" * k) for k in range(100, 300)]
    docs = make_docs(rows)
    back = fim.transform(docs).select("doc_id", fim.restore(F.col("output"), F.col("form")).alias("text"))
    key = lambda r: (r[0] is not None, r[0] or 0, r[1])
    assert sorted(map(tuple, back.collect()), key=key) == sorted(((d, t or "") for d, t in rows), key=key)


def test_parameters(make_docs):
    rows = [(k, "some text of a document " * (k % 9 + 1)) for k in range(300)]
    markers = ("$pre\\", "[suf]", "(mid)")
    out = fim.transform(make_docs(rows), seed=7, fim_percent=50, spm_percent=60, markers=markers)
    assert sorted(map(tuple, out.collect())) == sorted(expected(d, t, 7, 50, 60, markers) for d, t in rows)
    back = out.select("doc_id", fim.restore(F.col("output"), F.col("form"), markers)).collect()
    assert sorted(map(tuple, back)) == rows


@pytest.mark.parametrize("n", [0, 1, 63, 64, 65, 4095, 4096, 4097, 100_000, 3_000_000])
def test_counts_units(spark, n):
    docs = spark.createDataFrame([("é\n😀"[n % 3] * n,)], "text string")
    assert docs.select(fim.count_units(F.col("text"))).first()[0] == n


def test_empty_table_and_no_shuffle(make_docs, documents):
    assert fim.transform(make_docs([])).collect() == []
    plan = fim.transform(documents)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan
