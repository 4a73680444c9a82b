"""Document fingerprints by MinHash.

Words are lower-cased (A-Z) and cut at ASCII white space; a shingle is five words (fewer words: the
whole sequence; none: no shingle). Each of ``PERMUTATIONS`` universal hash functions
``(a x + b mod 2^64) >> 32`` keeps its least value over the shingles; the 64 values of 32 bits are the
fingerprint, and the share of equal values estimates the Jaccard resemblance of the shingle sets.

* ``signatures(docs)``: fingerprint of every document.
* ``compare_edits(docs)``: fingerprints of every text and of its edited text (last third replaced by
  the head of the next document), with the likeness of both and of the next document.
* ``near_duplicates(docs)``: per document its class: bands of the fingerprints are joined in Spark and
  the Jaccard resemblance of the shingle sets is verified exactly.

Next documents: ids are cut into ranges of similar size; each range also receives the first row of the
range that follows, so that one shuffle brings every document to its next one, in streaming order, and
no task holds more than two texts at a time beside an Arrow batch. Ranges are chosen by approximate
quantiles (they steer the load only; results do not depend on them), at most ``MAX_RANGES`` of them,
whose bounds are all that the driver sees.

Defined cases: a null text is empty; texts without words are alike (likeness 1) and unlike any other;
a null id counts as the least; rows of equal id follow each other by their texts; a single document is
its own next one; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridmart.llm.common import parts, prepare, stored
from gridmart.llm.components import components

PERMUTATIONS = 64
BAND_ROWS = 4
SHINGLE = 5
THRESHOLD = 0.8
ROWS_PER_RANGE = 4000
MAX_RANGES = 20_000
#: Words whose hash a worker remembers before it starts anew (results do not depend on it).
CACHE_WORDS = 200_000
#: Distinct shingle sets that a task compares in one group.
MAX_GROUP = 1000
NO_ID = -(1 << 63)
NONE = np.uint64(0xFFFFFFFF)


def _constants(n: int) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(20240607)
    a, b = rng.integers(0, 1 << 64, size=(2, n), dtype=np.uint64)
    return (a | np.uint64(1))[:, None], b[:, None]


A, B = _constants(PERMUTATIONS)
_POWERS = [np.uint64(pow(0x9E3779B97F4A7C15, k, 1 << 64)) for k in range(64)]


class _WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        import xxhash

        out = self[word] = xxhash.xxh64_intdigest(word)
        return out


_words = _WordHashes()


def shingles(text: str | None, size: int = SHINGLE) -> np.ndarray:
    """The distinct shingle hashes of a text: sorted 32-bit values in uint64."""
    words = (text or "").encode("utf-8", "replace").lower().split()
    if not words:
        return np.empty(0, dtype=np.uint64)
    if len(_words) > CACHE_WORDS:
        _words.clear()
    hashes = np.fromiter(map(_words.__getitem__, words), dtype=np.uint64, count=len(words))
    size = min(size, len(words))
    n = len(words) - size + 1
    mixed = np.zeros(n, dtype=np.uint64)
    for k in range(size):
        mixed += hashes[k : k + n] * _POWERS[k]
    mixed ^= mixed >> np.uint64(29)
    mixed *= np.uint64(0xBF58476D1CE4E5B9)
    return np.unique(mixed >> np.uint64(32))


def signature(grams: np.ndarray) -> np.ndarray:
    """The least value of every permutation, as uint32."""
    least = np.full(PERMUTATIONS, NONE, dtype=np.uint64)
    for start in range(0, len(grams), 4096):
        block = grams[None, start : start + 4096]
        np.minimum(least, ((A * block + B) >> np.uint64(32)).min(axis=1), out=least)
    return least.astype(">u4")


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    return float((a == b).mean())


def signature_column(text: Column) -> Column:
    @F.pandas_udf("binary")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series([signature(shingles(t)).tobytes() for t in texts], dtype=object)

    return run(text.cast("string"))


def signatures(docs: DataFrame) -> DataFrame:
    """doc_id and fingerprint (hex)."""
    prepare(docs.sparkSession)
    return docs.select("doc_id", F.lower(F.hex(signature_column(F.col("text")))).alias("fingerprint"))


# ---- a document and its next one -------------------------------------------------------------


def _with_next(docs: DataFrame) -> DataFrame:
    """Rows (part, id, doc_id, text, guest), every part followed by the first row of the next part."""
    key = F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID))
    ids = docs.select(key.alias("id"))
    ranges = min(MAX_RANGES, parts(ids.count(), ROWS_PER_RANGE))
    cuts = ids.approxQuantile("id", [k / ranges for k in range(1, ranges)], 1 / (8 * ranges)) if ranges > 1 else []
    bounds = np.unique(np.asarray(cuts or [], dtype=np.float64)).astype(np.int64)

    @F.pandas_udf("int")
    def part_of(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for keys in batches:
            yield pd.Series(np.searchsorted(bounds, keys.to_numpy(dtype=np.int64), side="left").astype(np.int32))

    tops = ids.select("id", part_of("id").alias("part")).groupBy("part").agg(F.max("id").alias("top")).collect()
    tops = sorted((r["part"], r["top"]) for r in tops)
    # The first row of a part follows the last row of the part above; that of the highest part, the last row of all.
    goes = {top: above for (_, top), (above, _) in zip(tops, tops[1:] + tops[:1], strict=True)}
    top_ids = np.array(sorted(goes), dtype=np.int64)
    targets = np.array([goes[t] for t in sorted(goes)], dtype=np.int32)

    @F.pandas_udf("int")
    def guest_of(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for keys in batches:
            own = keys.to_numpy(dtype=np.int64)
            at = np.minimum(np.searchsorted(top_ids, own), len(top_ids) - 1)
            yield pd.Series(np.where(top_ids[at] == own, targets[at], -1).astype(np.int32))

    rows = docs.select(key.alias("id"), F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    sent = F.array(F.struct(part_of("id").alias("part"), F.lit(False).alias("guest")), F.struct(guest_of("id").alias("part"), F.lit(True).alias("guest")))
    rows = rows.select("id", "doc_id", "text", F.explode(sent).alias("to")).where("to.part >= 0")
    rows = rows.select("to.part", "to.guest", "id", "doc_id", "text")
    return rows.repartition(max(1, len(tops)), "part").sortWithinPartitions("part", "guest", F.desc("id"), "text")


def edited(text: str, following: str) -> str:
    """The last third of the text replaced by as many code points of the following one."""
    n = len(text) // 3
    return text[: len(text) - n] + following[:n]


def _compare(batches):
    names = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
    types = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
    held = None  # (part, doc_id, text, fingerprint) of the row before
    for batch in batches:
        out = []
        texts = batch.column("text")
        columns = (batch.column(c).to_pylist() for c in ("part", "guest", "doc_id"))
        for k, (part, guest, doc_id) in enumerate(zip(*columns, strict=True)):
            if guest and (held is None or held[0] != part):
                continue  # only the first guest follows a row
            text = texts[k].as_py()
            own = signature(shingles(text))
            if held is not None and held[0] == part:
                changed = edited(held[2], text)
                theirs = signature(shingles(changed))
                digest = hashlib.sha256(changed.encode("utf-8", "replace")).hexdigest()
                out.append(
                    (held[1], len(held[2]), digest, held[3].tobytes().hex(), theirs.tobytes().hex(), likeness(held[3], theirs), likeness(held[3], own))
                )
            held = None if guest else (part, doc_id, text, own)
        columns = list(zip(*out, strict=True)) or [[]] * len(names)
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=names)


def compare_edits(docs: DataFrame) -> DataFrame:
    """Per document: doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next."""
    prepare(docs.sparkSession)
    schema = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
    return _with_next(docs).mapInArrow(_compare, schema)


# ---- near duplicates -------------------------------------------------------------------------


def _bands(signature_bytes: Column) -> Column:
    width = 4 * BAND_ROWS
    one = [
        F.struct(F.lit(k).cast("int").alias("band"), F.xxhash64(F.substring(signature_bytes, 1 + k * width, width)).alias("value"))
        for k in range(PERMUTATIONS // BAND_ROWS)
    ]
    return F.array(*one)


def _forest(ids: list[int], sets: list[np.ndarray], threshold: float) -> list[tuple[int, int]]:
    """A spanning forest of the pairs whose shingle sets resemble each other enough."""
    links, rest = [], list(range(len(ids)))
    while len(rest) > 1:
        reached, rest = [rest[0]], rest[1:]
        while reached and rest:
            one = reached.pop()
            far = []
            for other in rest:
                a, b = sets[one], sets[other]
                if min(len(a), len(b)) < threshold * max(len(a), len(b)):
                    far.append(other)
                    continue
                common = len(np.intersect1d(a, b, assume_unique=True))
                if common >= threshold * (len(a) + len(b) - common):
                    links.append((ids[one], ids[other]))
                    reached.append(other)
                else:
                    far.append(other)
            rest = far
    return links


def _alike(a: bytes, b: bytes, threshold: float) -> bool:
    return bool(_forest([0, 1], [np.frombuffer(a, "<u4"), np.frombuffer(b, "<u4")], threshold))


def _grouped_links(keyed: DataFrame, names: list[str], threshold: float) -> DataFrame:
    """Spanning forests (a, b) of groups of bounded size; rows are the key's columns, set_id and grams."""

    def link(rows: pd.DataFrame) -> pd.DataFrame:
        found = _forest(rows["set_id"].tolist(), [np.frombuffer(g, "<u4") for g in rows["grams"]], threshold)
        return pd.DataFrame(found, columns=["a", "b"], dtype=object)

    return keyed.groupBy(*names).applyInPandas(link, "a string, b string")


def _prefixes(hot: DataFrame, threshold: float) -> DataFrame:
    """(gram, set_id): the rarest grams of a set, so many that two sets alike enough share one of them."""

    @F.pandas_udf("array<long>")
    def listed(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for sets in batches:
            yield pd.Series([np.frombuffer(s, "<u4").astype(np.int64) for s in sets], dtype=object)

    grams = stored(hot.select("set_id", F.explode(listed("grams")).alias("gram")), "hot-grams")
    often = grams.groupBy("gram").agg(F.count("*").alias("n")).withColumnRenamed("gram", "_gram")
    size = F.count("*").over(Window.partitionBy("set_id"))
    place = F.row_number().over(Window.partitionBy("set_id").orderBy("n", "gram"))
    ranked = grams.join(often, F.col("gram") == F.col("_gram")).select("set_id", "gram", "n", size.alias("size"), place.alias("place"))
    needed = F.ceil(F.col("size") * F.lit(threshold) - F.lit(1e-9))
    return ranked.where((F.col("n") > 1) & (F.col("place") <= F.col("size") - needed + 1)).select("gram", "set_id")


def _pivot_links(met: DataFrame, threshold: float) -> DataFrame:
    """Members of a group that resemble its first set, row by row."""

    @F.pandas_udf("boolean")
    def alike(a: pd.Series, b: pd.Series) -> pd.Series:
        return pd.Series([_alike(x, y, threshold) for x, y in zip(a, b, strict=True)], dtype=bool)

    first = met.groupBy("gram").agg(F.min("set_id").alias("pivot"))
    pivots = first.join(met.select(F.col("gram").alias("_gram"), F.col("set_id").alias("_set"), F.col("grams").alias("_grams")), (F.col("gram") == F.col("_gram")) & (F.col("pivot") == F.col("_set")))
    pivots = pivots.select("_gram", "pivot", "_grams")
    pairs = met.join(pivots, F.col("gram") == F.col("_gram")).where("set_id != pivot")
    return pairs.where(alike("grams", "_grams")).select(F.col("pivot").alias("a"), F.col("set_id").alias("b"))


def _cross_links(met: DataFrame, roots: DataFrame, threshold: float) -> DataFrame:
    """Links between members of a large group that are not connected yet: each two of its blocks meet in a group of their own."""
    rooted = met.join(roots.select(F.col("node").alias("_node"), "root"), F.col("set_id") == F.col("_node"), "left")
    rooted = rooted.select("gram", "set_id", "grams", F.coalesce("root", "set_id").alias("root"))
    apart = rooted.groupBy("gram").agg(F.count("*").alias("n"), F.min("root").alias("_least"), F.max("root").alias("_most")).where("_least != _most")
    blocks = F.greatest(F.lit(2), F.ceil(F.col("n") * 2 / F.lit(MAX_GROUP)) + 1).cast("int")
    apart = apart.select(F.col("gram").alias("_gram"), blocks.alias("blocks"))
    left = rooted.join(apart, F.col("gram") == F.col("_gram")).withColumn("block", F.pmod(F.xxhash64("set_id"), F.col("blocks")).cast("int"))
    left = left.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    left = left.select("gram", F.least("block", "other").alias("lo"), F.greatest("block", "other").alias("hi"), "set_id", "grams", "root")

    def link(rows: pd.DataFrame) -> pd.DataFrame:
        ids, roots, sets = rows["set_id"].tolist(), rows["root"].tolist(), rows["grams"].tolist()
        found = [(ids[i], ids[j]) for i in range(len(ids)) for j in range(i) if roots[i] != roots[j] and _alike(sets[i], sets[j], threshold)]
        return pd.DataFrame(found, columns=["a", "b"], dtype=object)

    return left.groupBy("gram", "lo", "hi").applyInPandas(link, "a string, b string")


def _links(own: DataFrame, banded: DataFrame, threshold: float) -> DataFrame:
    """Links (a, b) that connect whatever sets share a band and resemble each other enough."""
    sizes = stored(banded.groupBy("band", "value").agg(F.count("*").alias("n")).where("n > 1"), "bands")
    sizes = sizes.select(F.col("band").alias("_band"), F.col("value").alias("_value"), "n")
    same = (F.col("band") == F.col("_band")) & (F.col("value") == F.col("_value"))
    links = _grouped_links(banded.join(sizes.where(F.col("n") <= MAX_GROUP), same).select("band", "value", "set_id", "grams"), ["band", "value"], threshold)
    large = sizes.where(F.col("n") > MAX_GROUP)
    if large.isEmpty():
        return links
    found = banded.join(large, same).select(F.col("set_id").alias("_set")).distinct()
    hot = stored(own.join(found, F.col("set_id") == F.col("_set")).select("set_id", "grams"), "hot-sets")
    prefixes = stored(_prefixes(hot, threshold), "prefixes")
    counts = prefixes.groupBy("gram").agg(F.count("*").alias("n")).where("n > 1").withColumnRenamed("gram", "_gram")
    sets = hot.select(F.col("set_id").alias("_set"), "grams")
    met = prefixes.join(counts, F.col("gram") == F.col("_gram")).join(sets, F.col("set_id") == F.col("_set")).select("gram", "n", "set_id", "grams")
    links = links.unionByName(_grouped_links(met.where(F.col("n") <= MAX_GROUP), ["gram"], threshold))
    wide = met.where(F.col("n") > MAX_GROUP).drop("n")
    if wide.isEmpty():
        return links
    links = stored(links.unionByName(_pivot_links(wide, threshold)), "links")
    return links.unionByName(_cross_links(wide, components(links), threshold))


def near_duplicates(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Per document: doc_id, class_id (the least doc_id among those reachable by resemblances >= threshold).

    Equal shingle sets are one row from the start. Sets that share a band meet in one group, where a
    search from one member verifies the Jaccard resemblance with those not yet reached; a group emits a
    spanning forest, never all its pairs. Every pair that shares a band and passes is connected.

    The sets of a band value with more than ``MAX_GROUP`` of them meet by their rarest grams instead: two that
    pass share one among the first |A| - ceil(threshold |A|) + 1 of either. Where more than ``MAX_GROUP`` meet
    even so, each is compared with the first; if that does not connect them all, those of different
    components are compared block by block.
    """
    prepare(docs.sparkSession)

    @F.pandas_udf("binary")
    def grams(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series([shingles(t).astype("<u4").tobytes() for t in texts], dtype=object)

    @F.pandas_udf("binary")
    def sign(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for sets in batches:
            yield pd.Series([signature(np.frombuffer(s, "<u4").astype(np.uint64)).tobytes() for s in sets], dtype=object)

    sets = stored(docs.select(F.col("doc_id").cast("long"), grams(F.col("text").cast("string")).alias("grams")).withColumn("set_id", F.sha2("grams", 256)), "shingles")
    own = stored(sets.groupBy("set_id").agg(F.min("doc_id").alias("rep"), F.first("grams").alias("grams")), "shingle-sets")
    banded = own.select("set_id", "grams", F.explode(_bands(sign("grams"))).alias("b")).select("set_id", "grams", "b.band", "b.value")
    roots = components(_links(own, banded, threshold))
    rooted = own.join(roots, F.col("set_id") == F.col("node"), "left").select("set_id", "rep", F.coalesce("root", "set_id").alias("root"))
    least = rooted.groupBy("root").agg(F.min("rep").alias("class_id")).withColumnRenamed("root", "_root")
    ids = rooted.join(least, F.col("root") == F.col("_root")).select(F.col("set_id").alias("_set"), "class_id")
    return sets.join(ids, F.col("set_id") == F.col("_set")).select("doc_id", "class_id")
