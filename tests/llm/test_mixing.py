from collections import Counter, defaultdict

from brute_mixing import brute_copies, brute_targets
from pyspark.sql import functions as F

from gridmart.llm import mixing as M


def source_rows(sizes):
    return [(k, "w " * n, s) for k, (s, n) in enumerate(sizes.items())]


def check(make_docs, sizes):
    want = brute_targets(sizes)
    rows = {r.source: r for r in M.plan(make_docs(source_rows(sizes))).collect()}
    for s, n in sizes.items():
        assert abs(rows[s].target - want[s]) < 1e-6 * max(1, want[s]), (s, rows[s].target, want[s])
        assert rows[s].source_size == n


def test_targets_equal_round_by_round_sharing(make_docs):
    check(make_docs, {"a": 10, "b": 10, "c": 10})
    check(make_docs, {"a": 1000, "b": 1, "c": 2, "d": 5, None: 30})
    check(make_docs, {"a": 5, "b": 500, "é": 3, "z": 40, "A": 7, "aa": 900})
    check(make_docs, {"a": 0, "b": 12, None: 0})


def test_copies_follow_rate_and_hash(documents):
    rows = [(r.doc_id, r.text, r.source) for r in documents.collect()]
    want = Counter()
    for (source, doc_id, _), n in brute_copies(rows).items():
        want[source, doc_id] += n
    for r in M.plan(documents).collect():
        assert r.copies == want[r.source, r.doc_id]
        assert r.taken == r["size"] * r.copies <= 3 * r["size"]


def hot_rows():
    """A third of all rows alike and without an id, other rows without ids, and a repeated id."""
    rows = [(None, "the very same words", "a")] * 400
    rows += [(None, f"text {k} " * (1 + k % 5), "b") for k in range(300)]
    rows += [(7, f"repeated id {k}", "c") for k in range(200)] + [(k, "x " * (k % 9), None) for k in range(300)]
    return rows


def test_rows_without_ids_and_repeated_rows_draw_apart(make_docs, monkeypatch):
    monkeypatch.setattr(M, "BLOCK", 30)  # groups of equal rows are numbered and dealt in blocks
    rows = hot_rows()
    docs = make_docs(rows, 7)
    want = brute_copies(rows)
    got, taken, target = Counter(), Counter(), {}
    for r in M.plan(docs).collect():
        got[r.source, r.doc_id] += r.copies
        taken[r.source] += r.taken
        target[r.source] = r.target
    by_id = Counter()
    for (source, doc_id, _), n in want.items():
        by_id[source, doc_id] += n
    assert got == by_id
    assert all(abs(taken[s] - t) < 0.05 * t for s, t in target.items()), (taken, target)
    mixed = Counter((r.source, r.doc_id, r.text or "") for r in M.mix(docs).collect())
    assert mixed == Counter({k: n for k, n in want.items() if n})
    monkeypatch.setattr(M, "BROADCAST_SOURCES", 0)
    assert Counter((r.source, r.doc_id, r.text or "") for r in M.mix(docs.repartition(4)).collect()) == mixed


def test_small_sources_come_near_their_targets(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    per = M.plan(docs).groupBy("source").agg(F.sum("taken").alias("taken"), F.first("target").alias("target")).collect()
    assert len(per) == 20 and all(abs(r.taken - r.target) < 0.03 * r.target for r in per)


def test_a_large_source_comes_near_its_target(spark):
    rows = spark.range(30000).select(
        F.col("id").alias("doc_id"), F.expr("repeat('w ', cast(1 + id % 9 as int))").alias("text"), F.expr("concat('s', cast(id % 4 as string))").alias("source")
    )
    got = defaultdict(int)
    target = {}
    for r in M.plan(rows).collect():
        got[r.source] += r.taken
        target[r.source] = r.target
    assert all(abs(got[s] - t) < 0.03 * t for s, t in target.items())


def test_mix_emits_each_document_as_planned(documents, clashing):
    docs = clashing(documents)
    mixed = M.mix(docs)
    assert mixed.columns == docs.columns
    got = Counter(r.doc_id for r in mixed.select("doc_id").collect())
    want = {r.doc_id: r.copies for r in M.plan(documents).collect() if r.copies}
    assert got == want
    again = Counter(r.doc_id for r in M.mix(docs.repartition(5)).select("doc_id").collect())
    assert again == got


def test_beyond_the_broadcast_bound(documents, monkeypatch):
    want = sorted(tuple(r) for r in M.plan(documents).collect())
    monkeypatch.setattr(M, "BROADCAST_SOURCES", 0)
    assert sorted(tuple(r) for r in M.plan(documents).collect()) == want


def test_odd_rows_and_empty_table(odd_rows, make_docs):
    docs = make_docs([(i, t, [None, "a", "b"][k % 3]) for k, (i, t) in enumerate(odd_rows)])
    rows = M.plan(docs).collect()
    assert len(rows) == len(odd_rows) and all(r["size"] == 0 and r.taken == 0 for r in rows if r.doc_id in (1, 2, 3))
    assert M.plan(make_docs([])).count() == 0 and M.mix(make_docs([])).count() == 0
    assert M.plan(make_docs([(1, None), (2, "")])).agg(F.sum("taken")).first()[0] == 0


def test_no_python(documents):
    for df in (M.plan(documents), M.mix(documents)):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "Python" not in plan and "Arrow" not in plan
