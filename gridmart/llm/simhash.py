"""SimHash near-duplicates with a pigeonring filter.

A 64-bit fingerprint is cut into ``max_bits + 1`` segments (three at least) on a ring. If two fingerprints differ in at
most ``max_bits`` bits, then from some segment on, going round, every chain of l consecutive segments
differs in at most ``floor(l * max_bits / (max_bits + 1)) = l - 1`` bits: nothing in the first
segment, at most one bit in the first two, and so on. So

1. equal fingerprints become one row (with map-side combine: a huge group of copies costs one row per task);
2. every fingerprint is listed, for each start, under its first two segments, and under the values that
   arise by clearing one set bit of the second (of two values that differ in one bit, one is the other
   with that bit cleared): about 7 rows for each start, keys of 26 bits;
3. within a key, the longer chains are checked in turn, the last of them being the full Hamming check,
   and only a spanning forest of the links is emitted: a search from one member looks at those not yet
   reached, so a dense group costs about its size, and never all its pairs are listed;
4. a task joins the forests of its keys into stars, and the components of all stars are the groups.

No candidate is capped or dropped: the filter is complete, so groups are exact.

Defined cases: null and empty texts have fingerprint 0, which links like any other; a text with fewer
words than a shingle is one shingle; repeated rows share a fingerprint; null ids are grouped too, but a
group's id is its least non-null doc_id (null if it has none); an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from itertools import repeat

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridmart.llm.common import prepare, stored
from gridmart.llm.components import components

SHINGLE = 4
MAX_BITS = 4
SEED = 42
BITS = 64
NO_ID = -(1 << 63)

_COLUMNS = (256 * np.arange(8, dtype=np.int64))[None, :]
_BIT_OF_BYTE = ((np.arange(256)[:, None] >> np.arange(8)[None, :]) & 1).astype(np.int64)


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """Bit set where over half of the shingles' XXH64 have it; 0 without words. As a signed 64-bit number."""
    import xxhash

    words = (text or "").encode("utf-8", "replace").lower().split()
    if not words:
        return 0
    grams = map(b" ".join, zip(*(words[k:] for k in range(shingle)), strict=False)) if len(words) >= shingle else [b" ".join(words)]
    n = max(1, len(words) - shingle + 1)
    hashes = np.fromiter(map(xxhash.xxh64_intdigest, grams, repeat(SEED)), dtype="<u8", count=n)
    counts = np.zeros(BITS, dtype=np.int64)
    for start in range(0, n, 1 << 15):
        by_byte = hashes[start : start + (1 << 15)].view(np.uint8).reshape(-1, 8) + _COLUMNS
        counts += (np.bincount(by_byte.ravel(), minlength=2048).reshape(8, 256) @ _BIT_OF_BYTE).ravel()
    set_bits = (2 * counts > n).astype(np.uint8)
    return int(np.packbits(set_bits, bitorder="little").view("<i8")[0])


def fingerprint_column(text: Column, shingle: int = SHINGLE) -> Column:
    @F.pandas_udf("long")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series([fingerprint(t, shingle) for t in texts], dtype="int64")

    # Declared non-deterministic so that a join's inferred "is not null" does not evaluate it once more.
    return run.asNondeterministic()(text.cast("string"))


@lru_cache(maxsize=8)
def _segments(n: int) -> tuple[tuple[int, int], ...]:
    """(offset, width) of each of n segments of 64 bits."""
    edges = [BITS * k // n for k in range(n + 1)]
    return tuple((a, b - a) for a, b in zip(edges, edges[1:], strict=False))


def _ring(max_bits: int) -> tuple[tuple[int, int], ...]:
    """One segment more than bits, three at least (a key is two segments and the start)."""
    return _segments(max(3, max_bits + 1))


def _value(fp: np.ndarray, segment: tuple[int, int]) -> np.ndarray:
    offset, width = segment
    return (fp >> np.uint64(offset)) & np.uint64((1 << width) - 1)


def _listed(max_bits: int):
    """Rows (start, key, fp): see 2. above."""
    ring = _ring(max_bits)

    def run(batches):
        for batch in batches:
            fp = batch.column(0).to_numpy().view(np.uint64)
            keys, fps = [], []
            for start in range(len(ring)):
                second = ring[(start + 1) % len(ring)]
                own = (np.uint64(start) << np.uint64(58)) | (_value(fp, ring[start]) << np.uint64(second[1])) | _value(fp, second)
                keys.append(own)
                fps.append(fp)
                for bit in range(second[1]):
                    one = np.uint64(1 << bit)
                    has = (own & one) != 0
                    keys.append(own[has] ^ one)
                    fps.append(fp[has])
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(keys).view(np.int64)), pa.array(np.concatenate(fps).view(np.int64))], names=["key", "fp"]
            )

    return run


def _chains_hold(diff: np.ndarray, start: int, max_bits: int) -> np.ndarray:
    """Every chain from ``start`` within its proportional budget; the longest is the whole ring."""
    ring = _ring(max_bits)
    total = np.zeros(len(diff), dtype=np.int64)
    ok = np.ones(len(diff), dtype=bool)
    for length in range(1, len(ring) + 1):
        offset, width = ring[(start + length - 1) % len(ring)]
        total += np.bitwise_count(diff & np.uint64(((1 << width) - 1) << offset))
        ok &= total * len(ring) <= length * max_bits
    return ok


def _forest(fps: np.ndarray, start: int, max_bits: int) -> list[tuple[int, int]]:
    """A spanning forest of the links among the members of one key."""
    links: list[tuple[int, int]] = []
    rest = fps
    while len(rest) > 1:
        reached, rest = [rest[0]], rest[1:]
        while reached and len(rest):
            one = reached.pop()
            near = _chains_hold(rest ^ one, start, max_bits)
            if near.any():
                found = rest[near]
                links.extend(zip(repeat(int(one)), found.tolist(), strict=False))
                reached.extend(found)
                rest = rest[~near]
    return links


def _linked(max_bits: int):
    """Over rows sorted by key: the forests of all keys of a partition, joined into stars. A key may span batches."""

    def run(batches):
        parent: dict[int, int] = {}  # of the partition's linked fingerprints only

        def find(x: int) -> int:
            while (up := parent.setdefault(x, x)) != x:
                parent[x] = x = parent[up]
            return x

        held_keys, held_fps = np.empty(0, np.uint64), np.empty(0, np.uint64)
        for batch in _with_end(batches):
            if batch is None:
                ready = len(held_keys)
            else:
                held_keys = np.concatenate([held_keys, batch.column(0).to_numpy().view(np.uint64)])
                held_fps = np.concatenate([held_fps, batch.column(1).to_numpy().view(np.uint64)])
                ready = int(np.searchsorted(held_keys, held_keys[-1])) if len(held_keys) else 0
            keys, fps = held_keys[:ready], held_fps[:ready]
            held_keys, held_fps = held_keys[ready:], held_fps[ready:]
            if len(keys):
                first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
                size = np.diff(np.concatenate([first, [len(keys)]]))
                for at, n in zip(first[size > 1].tolist(), size[size > 1].tolist(), strict=True):
                    for a, b in _forest(fps[at : at + n], int(keys[at] >> np.uint64(58)), max_bits):
                        a, b = sorted((find(a), find(b)))
                        parent[b] = a
        stars = np.array([(x, find(x)) for x in list(parent) if find(x) != x], dtype=np.uint64).reshape(-1, 2)
        for start in range(0, len(stars), 10_000):
            a, b = (pa.array(np.ascontiguousarray(x).view(np.int64)) for x in stars[start : start + 10_000].T)
            yield pa.RecordBatch.from_arrays([a, b], names=["a", "b"])

    return run


def _with_end(batches):
    yield from batches
    yield None


def links(fps: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """From distinct fingerprints (fp): edges (a, b) that connect whatever pairs within ``max_bits`` connect."""
    if max_bits < 1:
        return fps.select(F.col("fp").alias("a"), F.col("fp").alias("b")).where(F.lit(False))
    listed = fps.select("fp").mapInArrow(_listed(max_bits), "key long, fp long")
    return listed.repartition("key").sortWithinPartitions("key").mapInArrow(_linked(max_bits), "a long, b long").distinct()


def groups(docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS) -> tuple[DataFrame, DataFrame]:
    """(doc_id, fp) of every document, and (fp, rep, root, component_id) of every fingerprint: rep its least id."""
    prepare(docs.sparkSession)
    prints = stored(docs.select(F.col("doc_id").cast("long"), fingerprint_column(F.col("text"), shingle).alias("fp")), "simhash")
    own = stored(prints.groupBy("fp").agg(F.min("doc_id").alias("rep")), "simhash-distinct")
    roots = components(links(own, max_bits))
    rooted = own.join(roots, F.col("fp") == F.col("node"), "left").select("fp", "rep", F.coalesce("root", "fp").alias("root"))
    least = rooted.groupBy("root").agg(F.min("rep").alias("component_id")).withColumnRenamed("root", "_root")
    return prints, rooted.join(least, F.col("root") == F.col("_root")).select("fp", "rep", "root", "component_id")


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """Per document: doc_id, fingerprint (16 hex digits), component_id."""
    prints, ids = groups(docs, shingle, max_bits)
    joined = prints.join(ids.select(F.col("fp").alias("_fp"), "component_id"), F.col("fp") == F.col("_fp"), "left")
    return joined.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """The input's columns; of each group the row with the least doc_id stays (nulls last), and one row of equal ids."""
    _, ids = groups(docs, shingle, max_bits)
    first = F.min(F.when(F.col("rep").eqNullSafe(F.col("component_id")), F.col("fp")))
    chosen = ids.groupBy("root").agg(F.first("component_id").alias("id"), first.alias("_chosen"))
    chosen = chosen.select(F.coalesce("id", F.lit(NO_ID)).alias("_wanted"), "_chosen")
    names = docs.columns
    boxed = docs.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("_doc"))
    boxed = boxed.select(
        "_doc", F.coalesce(F.col("_doc.doc_id").cast("long"), F.lit(NO_ID)).alias("_id"), fingerprint_column(F.col("_doc.text"), shingle).alias("_fp")
    )
    kept = boxed.join(chosen, (F.col("_id") == F.col("_wanted")) & (F.col("_fp") == F.col("_chosen")), "left_semi")
    kept = kept.dropDuplicates(["_id", "_fp"])
    return kept.select(*[F.col("_doc").getField(c).alias(c) for c in names])
