"""Sharding by a hierarchical weighted hash tree (region -> rack -> shard), DataFrame expressions only.

A key descends the tree: at each level every child draws ``ln(u) / weight`` with ``u`` hashed from
(child's path, key), and the largest draw wins. A child's draw depends on nothing but its own path
and weight, so a change of weights moves keys only between subtrees whose weights changed: a new
region takes keys only into itself and leaves every other key where it was.

``grow(topology)`` opens a region of its own for a new shard, for that reason. (A shard added to a
rack that already has others raises the weights of that rack and region, and the keys that this
draws in are dealt among all shards of the rack: also confined to it, but not to the new shard.)

Defined cases: a null key is a key like any other; a null text has no bytes; repeated rows land in
one shard with slots of their own; an empty table gives an empty result; a weight of 0 takes nothing.
Slots are numbered by (shard, hash bucket) groups, whose offsets are summed on a small table, so no
shard's rows are gathered in one task. Buckets that many equal rows have filled (a third of all rows
with a null key and no text, say) are cut again by the rows' stored positions.
"""

from __future__ import annotations

from collections import defaultdict
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridmart.llm.common import parts, stored

NULL_KEY = "\x01null"

ROWS_PER_BUCKET = 2000
CROWDED = 4  # times that many rows, and equal rows are told apart by where they are stored
BROADCAST_BUCKETS = 50_000


@dataclass(frozen=True)
class Leaf:
    region: str
    rack: str
    shard: int
    weight: float = 1.0


def topology(n_shards: int, shards_per_rack: int = 2, racks_per_region: int = 4) -> tuple[Leaf, ...]:
    """Equal shards, filled rack by rack and region by region."""
    per_region = shards_per_rack * racks_per_region
    return tuple(Leaf(f"g{i // per_region}", f"k{i % per_region // shards_per_rack}", i) for i in range(n_shards))


def grow(leaves: tuple[Leaf, ...], weight: float = 1.0) -> tuple[Leaf, ...]:
    """One more shard, in a region of its own."""
    shard = 1 + max((x.shard for x in leaves), default=-1)
    return (*leaves, Leaf(f"x{shard}", "k0", shard, weight))


def _levels(leaves: tuple[Leaf, ...]):
    """Children of the root, of each region and of each rack: path -> weight."""
    regions: dict[str, float] = defaultdict(float)
    racks: dict[str, dict[str, float]] = defaultdict(lambda: defaultdict(float))
    shards: dict[str, dict[int, float]] = defaultdict(dict)
    for x in leaves:
        if x.weight > 0:
            regions[x.region] += x.weight
            racks[x.region][f"{x.region}/{x.rack}"] += x.weight
            shards[f"{x.region}/{x.rack}"][x.shard] = x.weight
    return regions, racks, shards


def _draw(path: Column, weight: Column, key: Column) -> Column:
    h = F.shiftrightunsigned(F.xxhash64(F.concat(path, F.lit("|"), key)), 11)
    return F.log((h.cast("double") + F.lit(0.5)) / F.lit(float(1 << 53))) / weight


def _children(pairs) -> Column:
    return F.array(*[F.struct(F.lit(str(p)).alias("p"), F.lit(float(w)).alias("w")) for p, w in pairs])


def _winner(children: Column, key: Column, prefix: Column | None = None) -> Column:
    def one(c):
        path = c["p"] if prefix is None else F.concat(prefix, F.lit("/"), c["p"])
        return F.struct(_draw(path, c["w"], key).alias("d"), c["p"].alias("p"))

    return F.array_max(F.transform(children, one))["p"]


def _pick(by: dict[str, Column], chosen: Column) -> Column:
    out = None
    for name, children in by.items():
        out = F.when(chosen == name, children) if out is None else out.when(chosen == name, children)
    return out


def place(df: DataFrame, key: Column, leaves: tuple[Leaf, ...], name: str) -> DataFrame:
    """Adds int column ``name``: the shard of each row."""
    regions, racks, shards = _levels(leaves)
    if not regions:
        raise ValueError("the tree has no shard with a weight")
    return (
        df.withColumn("_key", F.coalesce(key.cast("string"), F.lit(NULL_KEY)))
        .withColumn("_region", _winner(_children(sorted(regions.items())), F.col("_key")))
        .withColumn("_rack", _winner(_pick({r: _children(sorted(k.items())) for r, k in racks.items()}, F.col("_region")), F.col("_key")))
        .withColumn(
            name,
            _winner(_pick({k: _children(sorted(s.items())) for k, s in shards.items()}, F.col("_rack")), F.col("_key"), F.col("_rack")).cast("int"),
        )
        .drop("_key", "_region", "_rack")
    )


def slot_buckets(
    df: DataFrame, group: str, order: list[str], totals: dict[int, int], position: str, rows_per_bucket: int = ROWS_PER_BUCKET
) -> tuple[DataFrame, DataFrame]:
    """Rows with (``_bucket``, ``_piece``), and the table (group, _bucket, _piece, _n).

    Equal rows share a bucket. A crowded one is cut by ``position``, which must be a stored column: a
    computed one could differ between the two results.
    """
    buckets = ",".join(str(parts(totals.get(k, 0), rows_per_bucket)) for k in range(max(totals, default=0) + 1))
    own_buckets = F.get(F.split(F.lit(buckets), ",").cast("array<int>"), F.col(group).cast("int"))
    rows = df.withColumn("_bucket", F.pmod(F.xxhash64(*order), own_buckets).cast("int"))
    sizes = stored(rows.groupBy(group, "_bucket").agg(F.count("*").alias("_n")), "slot-sizes")
    crowded = sizes.where(F.col("_n") > CROWDED * rows_per_bucket)
    crowded = crowded.select(F.col(group).alias("_group"), F.col("_bucket").alias("_b"), F.ceil(F.col("_n") / rows_per_bucket).alias("_pieces"))
    n_crowded = crowded.count()
    if not n_crowded:
        return rows.withColumn("_piece", F.lit(0).cast("long")), sizes.withColumn("_piece", F.lit(0).cast("long"))
    crowded = F.broadcast(crowded) if n_crowded <= BROADCAST_BUCKETS else crowded
    rows = rows.join(crowded, (F.col(group) == F.col("_group")) & (F.col("_bucket") == F.col("_b")), "left")
    rows = rows.withColumn("_piece", F.pmod(F.xxhash64(position), F.coalesce("_pieces", F.lit(1).cast("long")))).drop("_group", "_b", "_pieces")
    return rows, rows.groupBy(group, "_bucket", "_piece").agg(F.count("*").alias("_n"))


def number_slots(
    df: DataFrame, group: str, order: list[str], totals: dict[int, int], position: str, rows_per_bucket: int = ROWS_PER_BUCKET
) -> DataFrame:
    """Adds ``slot``: gapless numbers from 0 within each ``group`` (small non-negative integers).

    ``totals`` has the rows of every group: a group is cut into hash buckets of about ``rows_per_bucket``
    rows, so one that holds a third of all rows is numbered by as many tasks as its size asks for. Buckets
    that equal rows have filled are cut by ``position``. Only equal rows (and their bucket) depend on it.
    """
    rows, sizes = slot_buckets(df, group, order, totals, position, rows_per_bucket)
    before = Window.partitionBy(group).orderBy("_bucket", "_piece").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(
        F.col(group).alias("_group"), F.col("_bucket").alias("_b"), F.col("_piece").alias("_p"),
        F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"),
    )
    own = Window.partitionBy(group, "_bucket", "_piece").orderBy(*order, position)
    ranked = rows.withColumn("_rank", F.row_number().over(own) - 1)
    same = (F.col(group) == F.col("_group")) & (F.col("_bucket") == F.col("_b")) & (F.col("_piece") == F.col("_p"))
    joined = ranked.join(offsets, same)
    return joined.withColumn("slot", (F.col("_rank") + F.col("_offset")).cast("long")).drop(
        "_bucket", "_piece", "_group", "_b", "_p", "_offset", "_rank", position
    )


def shard(docs: DataFrame, leaves: tuple[Leaf, ...], grown: tuple[Leaf, ...], key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: ``key``, size, text_crc32, shard, slot, grown_shard (the shard after growing the tree)."""
    body = F.coalesce(F.col(text), F.lit(""))
    slim = docs.select(
        F.col(key).alias(key),
        (F.octet_length(body) + 16).cast("long").alias("size"),
        F.crc32(body).cast("long").alias("text_crc32"),
    )
    slim = place(slim, F.col(key), leaves, "shard")
    slim = place(slim, F.col(key), grown, "grown_shard").withColumn("_at", F.monotonically_increasing_id())
    slim = stored(slim, "shards")
    totals = {r["shard"]: r["count"] for r in slim.groupBy("shard").count().collect()}
    return number_slots(slim, "shard", [key, "text_crc32", "size"], totals, "_at")
