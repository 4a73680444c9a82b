"""Mixing sources to target weights, DataFrame expressions only.

Sizes are words. Sources (by code point, null last) weigh 1, 2, 3, repeating (or as given) and share
all words; a target stops at ``max_rate`` times its source's words and the excess is shared again by
weight. That fixpoint is computed at once: in ascending order of cap / weight, a source is capped
while its cap is below its share of what the capped ones before it leave.

Each document is emitted ``floor(rate)`` times, and once more where a number hashed from a seed and
the document is below the fraction. The document's part of the hash is its source, id, text and, among
rows that agree in all three, a number from 0: rows without ids draw apart, and what a group of equal
rows takes does not depend on their order. Each source uses that of ``SEEDS`` seeds whose draws come
nearest to its target (the lowest of several): one aggregation over (source, seed). Reruns agree.

Defined cases: a null text has size 0; null sources form one source; a source without words has
target 0 and rate 0 (its documents are not emitted: a mix of words takes no words from them);
which of several equal rows is emitted once more is not told apart; an empty table gives an empty result.

Words per source and equal rows are counted with map-side combine, so a hot source or row costs one
row per task; equal rows are dealt again in blocks of ``BLOCK``. The targets are joined by broadcast
only while the source table is at most ``BROADCAST_SOURCES`` rows (the repeated rows' table of ``mix``
likewise); beyond that the join is left to Spark.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridmart.llm.common import hash_unit, n_words, stored

MAX_RATE = 3.0
SEED = "mix-2"
SEEDS = 64
BLOCK = 1000
BROADCAST_SOURCES = 50_000


def source_targets(sizes: DataFrame, max_rate: float = MAX_RATE, cycle: int = 3) -> DataFrame:
    """From (source, size): one row per source with its weight, source_size and target."""
    per = sizes.groupBy("source").agg(F.sum("size").cast("long").alias("source_size"))
    everything = Window.partitionBy(F.lit(0))  # the table of sources, never the documents
    per = per.withColumn("weight", (F.row_number().over(everything.orderBy(F.col("source").asc_nulls_last())) - 1) % cycle + 1)
    per = per.withColumn("cap", F.col("source_size") * F.lit(float(max_rate)))
    order = everything.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    per = per.withColumn(
        "share",
        (F.sum("source_size").over(everything) - F.coalesce(F.sum("cap").over(before), F.lit(0.0)))
        / (F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0))),
    ).withColumn("at", F.row_number().over(order))
    free = F.when(F.col("cap") / F.col("weight") >= F.col("share"), F.struct("at", "share"))
    per = per.withColumn("level", F.min(free).over(everything)["share"])
    target = F.least(F.col("cap"), F.coalesce(F.col("level") * F.col("weight"), F.lit(0.0)))
    return per.select("source", F.col("weight").cast("int").alias("weight"), "source_size", target.alias("target"))


def _digest(source: Column, doc_id: Column, text_md5: Column, nth: Column) -> Column:
    named = [F.coalesce(c.cast("string"), F.lit("null")) for c in (source, doc_id, text_md5, nth)]
    return F.md5(F.concat_ws("|", *named))


def _copies(digest: Column, pick: Column, seed: str) -> Column:
    rate = F.coalesce(F.col("target") / F.nullif(F.col("source_size"), F.lit(0)), F.lit(0.0))
    key = F.concat(F.lit(seed + "|"), pick.cast("string"), F.lit("|"), digest)
    return (F.floor(rate) + F.when(hash_unit(key) < rate - F.floor(rate), 1).otherwise(0)).cast("long")


def _small(df: DataFrame) -> DataFrame:
    return F.broadcast(df) if df.count() <= BROADCAST_SOURCES else df


def _alike(docs: DataFrame) -> DataFrame:
    """doc_id, source, size, text_md5 and ``n``, the number of rows that agree in them."""
    text = F.coalesce(F.col("text"), F.lit(""))
    slim = docs.select("doc_id", "source", n_words(text).cast("long").alias("size"), F.md5(text).alias("text_md5"))
    return stored(slim.groupBy(*slim.columns).agg(F.count("*").alias("n")), "mix-alike")


def _rows(alike: DataFrame) -> DataFrame:
    """One row per document again, with its ``digest``; blocks of large groups go to different tasks."""
    blocks = alike.withColumn("_first", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1, F.lit(BLOCK).cast("long"))))
    if alike.where(F.col("n") > BLOCK).limit(1).count():
        blocks = blocks.repartition("doc_id", "source", "text_md5", "_first")
    last = F.least(F.col("_first") + BLOCK - 1, F.col("n") - 1)
    rows = blocks.withColumn("_nth", F.explode(F.sequence("_first", last)))
    digest = _digest(F.col("source"), F.col("doc_id"), F.col("text_md5"), F.col("_nth"))
    return rows.select("doc_id", "source", "size", digest.alias("digest"))


def _with_targets(rows: DataFrame, targets: DataFrame, source: Column) -> DataFrame:
    named = _small(targets.withColumnRenamed("source", "_source"))
    return rows.join(named, source.eqNullSafe(F.col("_source")), "left").drop("_source")


def _targets(alike: DataFrame, max_rate: float, seed: str, cycle: int) -> DataFrame:
    """Per source: source_size, target and ``pick``, the seed that comes nearest to the target."""
    sizes = alike.select("source", (F.col("size") * F.col("n")).alias("size"))
    targets = stored(source_targets(sizes, max_rate, cycle).drop("weight"), "mix-targets")
    drawn = _with_targets(_rows(alike), targets, F.col("source")).withColumn("pick", F.explode(F.sequence(F.lit(0), F.lit(SEEDS - 1))))
    taken = F.sum(F.col("size") * _copies(F.col("digest"), F.col("pick"), seed))
    tried = drawn.groupBy("source", "pick").agg(F.abs(taken - F.first("target")).alias("miss"))
    best = tried.groupBy("source").agg(F.min(F.struct("miss", "pick"))["pick"].alias("pick"))
    best = best.withColumnRenamed("source", "_source")
    return stored(targets.join(best, F.col("source").eqNullSafe(F.col("_source")), "left").drop("_source"), "mix-picks")


def plan(docs: DataFrame, max_rate: float = MAX_RATE, seed: str = SEED, cycle: int = 3) -> DataFrame:
    """Per document: doc_id, size, source_size, target, copies, taken (size x copies)."""
    alike = _alike(docs)
    joined = _with_targets(_rows(alike), _targets(alike, max_rate, seed, cycle), F.col("source"))
    planned = joined.withColumn("copies", _copies(F.col("digest"), F.col("pick"), seed))
    return planned.select("doc_id", "source", "size", "source_size", "target", "copies", (F.col("size") * F.col("copies")).alias("taken"))


def _numbered(boxed: DataFrame, alike: DataFrame) -> DataFrame:
    """Adds ``_nth``: 0, or a number from 0 among rows that agree in source, id and text.

    Only rows that have an equal one are shuffled: each group by blocks, whose offsets are summed.
    """
    key = ["_k_source", "_k_id", "_k_md5"]
    repeated = alike.where("n > 1").select(F.col("source").alias("_r_source"), F.col("doc_id").alias("_r_id"), F.col("text_md5").alias("_r_md5"), "n")
    if not repeated.limit(1).count():
        return boxed.withColumn("_nth", F.lit(0).cast("long"))
    repeated = _small(repeated)
    same = F.lit(True)
    for a in key:
        same = same & F.col(a).eqNullSafe(F.col(a.replace("_k_", "_r_")))
    many = boxed.join(repeated, same).drop("_r_source", "_r_id", "_r_md5")
    many = stored(many.withColumn("_at", F.monotonically_increasing_id()), "mix-repeated")
    many = many.withColumn("_block", F.pmod(F.xxhash64("_at"), F.ceil(F.col("n") / BLOCK)))
    before = Window.partitionBy(*key).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = many.groupBy(*key, "_block").agg(F.count("*").alias("_n"))
    blocks = blocks.withColumn("_offset", F.coalesce(F.sum("_n").over(before), F.lit(0)))
    blocks = blocks.select(*[F.col(a).alias(a.replace("_k_", "_r_")) for a in key], F.col("_block").alias("_r_block"), "_offset")
    many = many.withColumn("_rank", F.row_number().over(Window.partitionBy(*key, "_block").orderBy("_at")) - 1)
    many = many.join(blocks, same & (F.col("_block") == F.col("_r_block")))
    many = many.withColumn("_nth", (F.col("_rank") + F.col("_offset")).cast("long"))
    once = boxed.join(repeated, same, "left_anti").withColumn("_nth", F.lit(0).cast("long"))
    return once.unionByName(many.select(*once.columns))


def mix(docs: DataFrame, max_rate: float = MAX_RATE, seed: str = SEED, cycle: int = 3) -> DataFrame:
    """The mixed corpus: the input's columns, each document as many times as the mix takes it."""
    names = docs.columns
    boxed = docs.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("_doc"))
    inner = boxed.select(F.col("_doc.doc_id").alias("doc_id"), F.col("_doc.source").alias("source"), F.col("_doc.text").alias("text"))
    alike = _alike(inner)
    targets = _targets(alike, max_rate, seed, cycle)
    text_md5 = F.md5(F.coalesce(F.col("_doc.text"), F.lit("")))
    keyed = boxed.select("_doc", F.col("_doc.source").alias("_k_source"), F.col("_doc.doc_id").alias("_k_id"), text_md5.alias("_k_md5"))
    joined = _with_targets(_numbered(keyed, alike), targets, F.col("_k_source"))
    digest = _digest(F.col("_k_source"), F.col("_k_id"), F.col("_k_md5"), F.col("_nth"))
    taken = joined.withColumn("_copies", _copies(digest, F.col("pick"), seed)).where("_copies > 0")
    out = taken.select("_doc", F.explode(F.sequence(F.lit(1), F.col("_copies").cast("int"))))
    return out.select(*[F.col("_doc").getField(c).alias(c) for c in names])
