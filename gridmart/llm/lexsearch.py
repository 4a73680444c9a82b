"""Ranked lexical search: norm buckets with Cauchy-Schwarz and coordinate bounds, exact integer scores.

Ranks all documents for each item of a query table. A term t that occurs tf times in a document of n terms
has there the impact x = (10^9 tf) div (1000 tf + 8 m), m = 25 + (75 n N) div L, and the weight
w = floor(1000 ln((2N + 2) / (2 df + 1))); a document's score is the sum of w x over the item's terms.

1. The items' terms (a block of items at a time, see ``items_in_blocks``) go to the tasks, which read each
   whole text once and keep (doc_id, n, the items' terms in it, their counts). N, L and df are aggregates
   of that table, which is written to the shared folder: no text is shuffled.
2. Impact vectors are weighted by sqrt(w), and so are the items, so that a score is their inner product.
   A task orders the vectors it holds by length and cuts them into buckets, the longest first.
3. theta is an item's k-th best score so far. A bucket whose largest length times the item's length lies
   below theta is skipped (Cauchy-Schwarz); lengths fall, so the rest of the buckets is skipped as well.
   Inside a bucket the item's coordinates are ranked by the most they can add there. The documents of the
   leading ones are visited, as many coordinates as it takes until the others cannot reach theta by
   themselves; a visited document survives if its partial product plus a bound on the rest (the smaller of
   the coordinates' largest values and Cauchy-Schwarz on the remaining lengths) reaches theta.
4. Survivors are scored exactly, in 64-bit integers, and raise theta.

A sixteenth of the documents, by hash, is searched first; the k-th best scores among them are the theta
that every task over the rest begins with (one number an item). theta never exceeds the final k-th score
and bounds are compared with a margin for rounding, so nothing is lost: pruning decides the time only.
Tasks return at most k rows an item, and the best k of all are ranked in Spark.

Defined cases: null or empty texts have no term: such documents are not counted and such items return no
row; documents without a common term (or with weight 0 throughout) are not returned; equal scores rank by
ascending doc_id, null ids last; repeated documents are ranked one by one; repeated rows of the item table
(same id and text) count once, items with one id and different texts are ranked separately; empty tables
give an empty result; other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gridmart.llm.common import parts, prepare, stored

TOP = 10
#: Items and bytes of item text that are searched in one pass over the documents.
BLOCK_ITEMS = 2000
BLOCK_BYTES = 16_000_000
#: Documents (and entries of their vectors) that a task orders by length at a time, and documents in a bucket.
ORDERED = 32_768
ENTRIES = 4_000_000
BUCKET = 2048
#: One document in so many is searched first, for the thresholds of the rest.
SEED_SHARE = 16
#: Words of text that a task holds at a time.
WORDS_HELD = 1_000_000
PIECE_BYTES = 4_000_000
#: Bounds are compared with this relative margin, far above the rounding of their sums.
MARGIN = 1e-9

SPARSE_SCHEMA = "doc_id long, n long, terms array<int>, counts array<int>"
FOUND_SCHEMA = "block int, item int, item_id long, doc_id long, score long"

#: Bytes of terms as they count: A-Z lower-cased, digits, letters and all of a non-ASCII character; others part terms.
_BYTES = bytes(b + 32 if 0x41 <= b <= 0x5A else b if b >= 0x80 or 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A else 0x20 for b in range(256))


def terms_of(text: bytes) -> Iterator[list[bytes]]:
    """The terms of a UTF-8 text, in lists of bounded size."""
    if len(text) <= PIECE_BYTES:
        yield text.translate(_BYTES).split()
        return
    clean, start = text.translate(_BYTES), 0
    while start < len(clean):
        end = clean.find(b" ", start + PIECE_BYTES)
        end = len(clean) if end < 0 else end
        yield clean[start:end].split()
        start = end


@dataclass(frozen=True)
class Items:
    """A block of items: distinct terms by number, and each item's (term, times) pairs."""

    ids: list
    vocabulary: dict[bytes, int]
    starts: np.ndarray
    terms: np.ndarray
    times: np.ndarray

    @staticmethod
    def of(rows: list[tuple[int | None, str]]) -> Items:
        ids, vocabulary, starts, terms, times = [], {}, [0], [], []
        for item_id, text in rows:
            counts: dict[int, int] = {}
            for term in chain.from_iterable(terms_of(text.encode())):
                number = vocabulary.setdefault(term, len(vocabulary))
                counts[number] = counts.get(number, 0) + 1
            ids.append(item_id)
            terms += counts.keys()
            times += counts.values()
            starts.append(len(terms))
        return Items(ids, vocabulary, np.array(starts), np.array(terms, dtype=np.int64), np.array(times, dtype=np.int64))


def items_in_blocks(items: DataFrame, block_items: int = BLOCK_ITEMS, block_bytes: int = BLOCK_BYTES) -> Iterator[Items]:
    """The items, at most about ``block_items`` and ``block_bytes`` of text at a time: the bound of what is sent to the tasks."""
    slim = items.select(F.col("item_id").cast("long"), F.col("text").cast("string")).where("text is not null").distinct()
    rows, size = slim.agg(F.count("*"), F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()
    count = max(parts(rows, block_items), parts(size, block_bytes))
    for k in range(count):
        chosen = slim.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(count)) == k)
        block = Items.of(sorted((tuple(r) for r in chosen.collect()), key=lambda r: (r[0] is None, r[0] or 0, r[1])))
        if block.vocabulary:
            yield block


def _count_terms(vocabulary: dict[bytes, int]):
    size = len(vocabulary)

    def counted(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Terms of each text; and (text, term, count) of the known ones, by text and term."""
        n, keys = np.zeros(len(texts), dtype=np.int64), []
        for k, text in enumerate(texts):
            for words in terms_of(text):
                n[k] += len(words)
                known = np.fromiter(map(vocabulary.get, words, repeat(-1)), dtype=np.int64, count=len(words))
                keys.append(k * size + known[known >= 0])
        key, count = np.unique(np.concatenate(keys) if keys else np.empty(0, np.int64), return_counts=True)
        return n, key // size, key % size, count

    def run(batches):
        for batch in batches:
            texts = [t.as_buffer().to_pybytes() if t.is_valid else b"" for t in batch.column(1)]
            at = 0
            while at < len(texts):
                end, held = at + 1, len(texts[at])
                while end < len(texts) and held + len(texts[end]) <= 4 * WORDS_HELD:
                    held += len(texts[end])
                    end += 1
                n, doc, term, count = counted(texts[at:end])
                offsets = pa.array(np.searchsorted(doc, np.arange(end - at + 1)), pa.int32())
                lists = [pa.ListArray.from_arrays(offsets, pa.array(v, pa.int32())) for v in (term, count)]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(at, end - at), pa.array(n), *lists], names=["doc_id", "n", "terms", "counts"])
                at = end

    return run


def sparse_documents(docs: DataFrame, vocabulary: dict[bytes, int]) -> DataFrame:
    """Per document: doc_id, n (all its terms), and those of the vocabulary with their counts."""
    slim = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return slim.mapInArrow(_count_terms(vocabulary), SPARSE_SCHEMA)


def weights(vocabulary_size: int, df: dict[int, int], n_docs: int) -> np.ndarray:
    return np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df.get(t, 0) + 1))) for t in range(vocabulary_size)], dtype=np.int64)


def impacts(counts: np.ndarray, n: np.ndarray, n_docs: int, n_terms: int) -> np.ndarray:
    m = 100 - 75 + (75 * n * n_docs) // n_terms
    return (1_000_000_000 * counts) // (1000 * counts + 8 * m)


class Best:
    """Each item's best documents so far, and its threshold."""

    def __init__(self, items: Items, k: int, theta: np.ndarray):
        self.k, self.theta = k, theta.copy()
        self.kept: list[tuple] = [(np.empty(0, np.int64),) * 3 for _ in items.ids]

    def add(self, item: int, score: np.ndarray, no_id: np.ndarray, doc_id: np.ndarray) -> None:
        """Documents of positive score; a null id is flagged and ranks last among equals."""
        joined = [np.concatenate(p) for p in zip(self.kept[item], (score, no_id, doc_id), strict=True)]
        order = np.lexsort((joined[2], joined[1], -joined[0]))[: self.k]
        self.kept[item] = tuple(p[order] for p in joined)
        if len(order) == self.k:
            self.theta[item] = max(self.theta[item], self.kept[item][0][-1])


class Bucket:
    """Documents of similar length: their entries by document and by term."""

    def __init__(self, norms: np.ndarray, starts: np.ndarray, terms: np.ndarray, x: np.ndarray, root: np.ndarray, size: int):
        self.norms, self.starts, self.terms, self.x = norms, starts, terms, x
        rows = np.repeat(np.arange(len(norms)), np.diff(starts))
        order = np.argsort(terms, kind="stable")
        self.rows, self.value = rows[order], (root[terms] * x)[order]
        self.at = np.searchsorted(terms[order], np.arange(size + 1))
        self.largest = np.zeros(size)
        filled = np.flatnonzero(np.diff(self.at))
        if len(filled):
            self.largest[filled] = np.maximum.reduceat(self.value, self.at[filled])

    def survivors(self, terms: np.ndarray, q: np.ndarray, theta: float) -> np.ndarray:
        """Documents that may reach theta for the item with these terms and coordinates."""
        most = q * self.largest[terms]
        order = np.argsort(-most, kind="stable")
        terms, q, most = terms[order], q[order], most[order]
        rest_sum = np.append(np.cumsum(most[::-1])[::-1], 0.0)
        rest_norm = np.sqrt(np.append(np.cumsum((q * q)[::-1])[::-1], 0.0))
        reach = np.minimum(rest_sum, rest_norm * self.norms[0]) * (1 + MARGIN)
        lead = int(np.argmax(reach < theta)) if theta > 0 else int(np.count_nonzero(most))
        if not lead:
            return np.empty(0, np.int64)
        spans = [slice(self.at[t], self.at[t + 1]) for t in terms[:lead]]
        rows = np.concatenate([self.rows[s] for s in spans])
        value = np.concatenate([self.value[s] for s in spans])
        mine = np.repeat(q[:lead], [s.stop - s.start for s in spans])
        partial = np.bincount(rows, mine * value, len(self.norms))
        seen = np.bincount(rows, value * value, len(self.norms))
        left = np.sqrt(np.maximum(self.norms * self.norms - seen, 0) + MARGIN * self.norms * self.norms)
        bound = (partial + np.minimum(rest_sum[lead], rest_norm[lead] * left)) * (1 + MARGIN)
        return np.flatnonzero((partial > 0) & (bound >= theta))

    def scores(self, rows: np.ndarray, dense: np.ndarray) -> np.ndarray:
        """Exact scores of documents, from the item's integer weights by term."""
        sizes = self.starts[rows + 1] - self.starts[rows]
        ends = np.cumsum(sizes)
        at = np.arange(ends[-1]) + np.repeat(self.starts[rows] - ends + sizes, sizes)
        return np.add.reduceat(dense[self.terms[at]] * self.x[at], ends - sizes)


def _search(items: Items, weight: np.ndarray, n_docs: int, n_terms: int, theta: np.ndarray, k: int, block: int):
    size, root = len(weight), np.sqrt(weight.astype(float))
    coordinates = items.times * root[items.terms]
    norm = np.sqrt(np.add.reduceat(np.append(coordinates**2, 0.0), items.starts[:-1]) * (np.diff(items.starts) > 0))

    def take(best: Best, dense: np.ndarray, table: pa.Table) -> None:
        lists = [table.column(c).combine_chunks() for c in ("terms", "counts")]
        terms, counts = (x.flatten().to_numpy().astype(np.int64) for x in lists)
        sizes = lists[0].value_lengths().to_numpy().astype(np.int64)
        n = table.column("n").to_numpy()
        doc = table.column("doc_id").combine_chunks()
        no_id, doc_id = doc.is_null().to_numpy(zero_copy_only=False).astype(np.int64), doc.fill_null(0).to_numpy()
        x = impacts(counts, np.repeat(n, sizes), n_docs, n_terms)
        starts = np.cumsum(sizes) - sizes
        lengths = np.sqrt(np.bincount(np.repeat(np.arange(len(n)), sizes), (root[terms] * x) ** 2, len(n)))
        by_length = np.argsort(-lengths, kind="stable")
        by_length = by_length[: np.count_nonzero(lengths)]
        for first in range(0, len(by_length), BUCKET):
            rows = by_length[first : first + BUCKET]
            active = np.flatnonzero(norm * (lengths[rows[0]] * (1 + MARGIN)) >= np.maximum(best.theta, 1))
            if not len(active):
                break
            own = sizes[rows]
            ends = np.cumsum(own)
            at = np.arange(ends[-1]) + np.repeat(starts[rows] - ends + own, own)
            bucket = Bucket(lengths[rows], np.append(0, ends), terms[at], x[at], root, size)
            for item in active:
                span = slice(items.starts[item], items.starts[item + 1])
                found = bucket.survivors(items.terms[span], coordinates[span], float(best.theta[item]))
                if len(found):
                    dense[items.terms[span]] = items.times[span] * weight[items.terms[span]]
                    score = bucket.scores(found, dense)
                    dense[items.terms[span]] = 0
                    good = score >= max(1, best.theta[item])
                    best.add(item, score[good], no_id[rows[found[good]]], doc_id[rows[found[good]]])

    def run(batches):
        best, dense, held, rows, entries = Best(items, k, theta), np.zeros(size, np.int64), [], 0, 0
        for batch in batches:
            held.append(batch)
            rows += batch.num_rows
            entries += len(batch.column("terms").flatten())
            if rows >= ORDERED or entries >= ENTRIES:
                take(best, dense, pa.Table.from_batches(held))
                held, rows, entries = [], 0, 0
        if held:
            take(best, dense, pa.Table.from_batches(held))
        for item, (score, no_id, doc_id) in enumerate(best.kept):
            if len(score):
                ids = pa.array(doc_id, pa.int64(), mask=no_id.astype(bool))
                same = [pa.array([v] * len(score), t) for v, t in ((block, pa.int32()), (item, pa.int32()), (items.ids[item], pa.int64()))]
                yield pa.RecordBatch.from_arrays([*same, ids, pa.array(score)], names=["block", "item", "item_id", "doc_id", "score"])

    return run


def _ranked(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("block", "item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def search(docs: DataFrame, items: DataFrame, k: int = TOP, seed_share: int = SEED_SHARE) -> DataFrame:
    """Per item (item_id, text) its ``k`` best documents (doc_id, text): item_id, rank, doc_id, score."""
    spark = prepare(docs.sparkSession)
    out = spark.createDataFrame([], FOUND_SCHEMA + ", rank int")
    for number, block in enumerate(items_in_blocks(items)):
        sparse = stored(sparse_documents(docs, block.vocabulary), "search")
        n_docs, n_terms = sparse.agg(F.count_if(F.col("n") > 0), F.sum("n")).first()
        if not n_docs:
            continue
        per_term = sparse.select(F.explode("terms").alias("term")).groupBy("term").count()
        weight = weights(len(block.vocabulary), {r["term"]: r["count"] for r in per_term.collect()}, n_docs)  # <= the block's terms
        held = sparse.where(F.size("terms") > 0)
        early = F.pmod(F.xxhash64("doc_id", "n", "terms"), F.lit(seed_share)) == 0
        none = np.zeros(len(block.ids), dtype=np.int64)
        begun = stored(_ranked(held.where(early).mapInArrow(_search(block, weight, n_docs, n_terms, none, k, number), FOUND_SCHEMA), k), "search-seeds")
        theta = none.copy()
        for r in begun.where(F.col("rank") == k).select("item", "score").collect():  # <= one row an item
            theta[r["item"]] = r["score"]
        rest = held.where(~early).mapInArrow(_search(block, weight, n_docs, n_terms, theta, k, number), FOUND_SCHEMA)
        out = out.unionByName(_ranked(begun.drop("rank").unionByName(rest), k))
    return out.select("item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score")
