import math
import zlib
from collections import Counter

import pytest
import xxhash
from pyspark.sql import functions as F

from gridmart.llm import hashtree as H
from gridmart.llm.common import stored


def draw(path, weight, key):
    h = xxhash.xxh64_intdigest(f"{path}|{key}".encode(), seed=42) >> 11
    return math.log((h + 0.5) / 2**53) / weight


def brute(key, leaves):
    key = H.NULL_KEY if key is None else str(key)
    regions, racks = {}, {}
    for x in leaves:
        regions[x.region] = regions.get(x.region, 0) + x.weight
        racks.setdefault(x.region, {})
        path = f"{x.region}/{x.rack}"
        racks[x.region][path] = racks[x.region].get(path, 0) + x.weight
    region = max(regions, key=lambda r: draw(r, regions[r], key))
    rack = max(racks[region], key=lambda k: draw(k, racks[region][k], key))
    own = [x for x in leaves if f"{x.region}/{x.rack}" == rack]
    return max(own, key=lambda x: draw(f"{rack}/{x.shard}", x.weight, key)).shard


def test_placement_equals_a_walk_down_the_tree(documents):
    leaves = H.topology(40)
    rows = H.shard(documents, leaves, H.grow(leaves)).collect()
    texts = {r.doc_id: r.text for r in documents.collect()}
    for r in rows:
        raw = texts[r.doc_id].encode()
        assert r.shard == brute(r.doc_id, leaves) and r.grown_shard == brute(r.doc_id, H.grow(leaves))
        assert r["size"] == len(raw) + 16 and r.text_crc32 == zlib.crc32(raw)


def gapless(rows, group):
    by = {}
    for r in rows:
        by.setdefault(r[group], []).append(r.slot)
    return all(sorted(v) == list(range(len(v))) for v in by.values())


def test_slots_are_gapless_over_many_buckets(spark):
    df = spark.range(5000).selectExpr("id", "id as at", "cast(if(id % 3 = 0, 0, id % 7) as int) as shard")
    totals = {r["shard"]: r["count"] for r in df.groupBy("shard").count().collect()}
    rows = H.number_slots(df, "shard", ["id"], totals, "at", rows_per_bucket=40).collect()
    assert gapless(rows, "shard") and len(rows) == 5000 and set(rows[0].asDict()) == {"id", "shard", "slot"}


@pytest.mark.parametrize("bound", [H.BROADCAST_BUCKETS, 0])
def test_equal_rows_are_numbered_in_bounded_groups(spark, monkeypatch, bound):
    monkeypatch.setattr(H, "BROADCAST_BUCKETS", bound)
    df = spark.range(9000).selectExpr("if(id % 3 = 0, null, id) as id", "id as at", "cast(if(id % 3 = 0, 0, id % 5) as int) as shard")
    df = stored(df, "test-slots")
    totals = {r["shard"]: r["count"] for r in df.groupBy("shard").count().collect()}
    rows, sizes = H.slot_buckets(df, "shard", ["id"], totals, "at", rows_per_bucket=50)
    want = rows.groupBy("shard", "_bucket", "_piece").count().collect()
    assert {tuple(r) for r in want} == {tuple(r) for r in sizes.select("shard", "_bucket", "_piece", "_n").collect()}
    assert max(r["count"] for r in want) <= H.CROWDED * 50
    numbered = H.number_slots(df, "shard", ["id"], totals, "at", rows_per_bucket=50).collect()
    assert gapless(numbered, "shard") and len(numbered) == 9000


def test_a_third_of_all_rows_without_id_and_text(spark):
    docs = spark.range(60000).selectExpr("if(id % 3 = 0, null, id) as doc_id", "if(id % 3 = 0, '', 'a text') as text")
    leaves = H.topology(40)
    rows = H.shard(docs, leaves, H.grow(leaves)).collect()
    assert len(rows) == 60000 and gapless(rows, "shard") and len({r.shard for r in rows if r.doc_id is None}) == 1


def test_a_new_shard_takes_rows_only_into_itself(spark):
    leaves = H.topology(40)
    df = H.place(H.place(spark.range(20000), F.col("id"), leaves, "a"), F.col("id"), H.grow(leaves), "b")
    moved = df.where("a != b")
    assert {r.b for r in moved.select("b").distinct().collect()} == {40}
    assert abs(moved.count() / 20000 - 1 / 41) < 0.01


def test_movement_stays_in_subtrees_whose_weights_change(spark):
    leaves = H.topology(16)
    heavier = tuple(H.Leaf(x.region, x.rack, x.shard, 3.0 if x.shard == 5 else x.weight) for x in leaves)
    key = F.col("id")
    rows = H.place(H.place(spark.range(20000), key, leaves, "a"), key, heavier, "b").where("a != b").collect()
    region = {x.shard: x.region for x in leaves}
    assert rows and all(region[r.b] == region[5] for r in rows)


def test_weights_are_met(spark):
    leaves = (H.Leaf("g0", "k0", 0, 1.0), H.Leaf("g0", "k1", 1, 2.0), H.Leaf("g1", "k0", 2, 5.0), H.Leaf("g1", "k0", 3, 0.0))
    got = Counter(r.s for r in H.place(spark.range(16000), F.col("id"), leaves, "s").collect())
    assert 3 not in got
    for shard, weight in ((0, 1), (1, 2), (2, 5)):
        assert abs(got[shard] / 16000 - weight / 8) < 0.02


def test_odd_rows_and_empty_table(odd_rows, make_docs, clashing):
    leaves = H.topology(4)
    rows = H.shard(clashing(make_docs(odd_rows)), leaves, H.grow(leaves)).collect()
    assert len(rows) == len(odd_rows)
    assert {r["size"] for r in rows if r.doc_id in (1, 2)} == {16}
    twins = [r for r in rows if r.doc_id == 9]
    assert twins[0].shard == twins[1].shard and twins[0].slot != twins[1].slot
    assert H.shard(make_docs([]), leaves, H.grow(leaves)).count() == 0


def test_no_python(documents):
    leaves = H.topology(40)
    plan = H.shard(documents, leaves, H.grow(leaves))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
