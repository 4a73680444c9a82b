"""Substring dedup with difference-cover anchors.

A position of a text is a cover position if its number modulo 13 is in {0, 1, 3, 9}: for any two
positions i, j some shift below 13 takes both to cover positions. So of two equal windows of
20 words, some equal run of 8 words starts at a cover position in both: the anchor.

1. Every chunk sends the hashes of its anchors (4 of 13 positions) to the parts of the key space, which
   answer which of them occur in another chunk too (in its own chunk the sender sees that itself).
2. Extension: a window that contains a repeated anchor is a candidate. Candidates alone are hashed
   whole, and every part finds each window's first chunk: least doc_id. All others are told.
3. A window that starts earlier elsewhere, or earlier in the same chunk, marks its words; the marked
   words are removed. Windows are judged on the input.

The first occurrence is found by a minimum per key, so nothing is paired, and a passage in a third of
all documents costs a part one key per chunk. Equality is that of 64-bit hashes of 64-bit word hashes.

Defined cases: null and empty texts have no words; a text shorter than the window keeps all; a null
doc_id counts as the least; rows of equal doc_id are ordered by chunk and place in it, so of repeated
rows one keeps its words; an empty table gives an empty result; columns beside the text are carried
through unread, whatever their names.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridmart.llm import chunks as C
from gridmart.llm.common import stored

WINDOW = 20
PERIOD = 13
COVER = (0, 1, 3, 9)
NO_ID = -(1 << 63)
_R = 0x9E3779B97F4A7C15


def run_hashes(hashes: np.ndarray, starts: np.ndarray, size: int) -> np.ndarray:
    """Hash of the ``size`` words from each start."""
    out = np.zeros(len(starts), dtype=np.uint64)
    for k in range(size):
        out = out * np.uint64(_R) + hashes[starts + k]
    out ^= out >> np.uint64(32)
    return out * np.uint64(0xD6E8FEB86659FD93)


class Chunk:
    """The words of a chunk's texts, and what the exchanges need of them."""

    def __init__(self, texts, window: int, period: int, cover: tuple[int, ...]):
        sizes, self.words = C.split_words(texts)
        self.window, self.anchor = window, window - period + 1
        self.ends = np.cumsum(sizes)
        self.begins = self.ends - sizes
        hashes, code = C.hash_words(self.words)
        self.hashes = hashes[code]
        place = np.arange(len(self.hashes)) - np.repeat(self.begins, sizes)  # in its own text
        left = np.repeat(self.ends, sizes) - np.arange(len(self.hashes))  # words from here to the text's end
        on_cover = np.isin(np.arange(period), cover)[place % period]
        # An anchor matters inside a whole window only.
        self.at = np.flatnonzero(on_cover & (left >= self.anchor) & (np.repeat(sizes, sizes) >= window))
        self.begins_window = left >= window

    def anchors(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Distinct anchor hashes, the place of each anchor in them, and which repeat in this chunk."""
        keys, place, count = np.unique(run_hashes(self.hashes, self.at, self.anchor), return_inverse=True, return_counts=True)
        return keys, place, count > 1

    def candidates(self, repeated: np.ndarray) -> np.ndarray:
        """Starts of the windows that hold one of the repeated anchors."""
        marks = np.zeros(len(self.hashes) + 1, dtype=np.int64)
        reach = self.window - self.anchor
        np.add.at(marks, np.maximum(repeated - reach, 0), 1)
        np.add.at(marks, repeated + 1, -1)
        return np.flatnonzero((np.cumsum(marks[:-1]) > 0) & self.begins_window)

    def windows(self, starts: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Distinct window hashes, each one's first text, the windows' places in them, and which are the first.

        ``rank`` orders the texts; within a text the earlier start is first.
        """
        text = np.searchsorted(self.ends, starts, side="right")
        hashes = run_hashes(self.hashes, starts, self.window)
        order = np.lexsort((starts, rank[text], hashes))
        keys, first, place = np.unique(hashes[order], return_index=True, return_inverse=True)
        where = np.empty(len(starts), dtype=np.int64)
        where[order] = place
        is_first = np.zeros(len(starts), dtype=bool)
        is_first[order[first]] = True
        return keys, text[order[first]], where, is_first

    def marked(self, starts: np.ndarray) -> np.ndarray:
        """Per word: covered by a window from one of the starts."""
        marks = np.zeros(len(self.hashes) + 1, dtype=np.int64)
        np.add.at(marks, starts, 1)
        np.add.at(marks, starts + self.window, -1)
        return np.cumsum(marks[:-1]) > 0

    def kept(self, gone: np.ndarray) -> pa.Array:
        """Each text's other words, joined by one space."""
        left = np.concatenate([[0], np.cumsum(~gone)])
        ends = pa.array(np.concatenate([[0], left[self.ends]]), pa.int32())
        return pc.binary_join(pa.ListArray.from_arrays(ends, self.words.filter(pa.array(~gone))), " ")


def _ids(table: pa.Table) -> np.ndarray:
    return np.array([NO_ID if x is None else x for x in table.column("doc_id").to_pylist()], dtype=np.int64)


def _send_anchors(count: int, window: int, period: int, cover):
    def run(batches):
        for batch in batches:
            for chunk, body in zip(batch.column("chunk").to_pylist(), batch.column("body"), strict=True):
                own = Chunk(C.unpack_table(body.as_py()).column("text"), window, period, cover)
                yield C.key_rows(chunk, own.anchors()[0], count)

    return run


def _reply(found: list[tuple[int, int, np.ndarray]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [
            pa.array([c for c, _, _ in found], pa.int64()),
            pa.array([p for _, p, _ in found], pa.int32()),
            pa.array([C.squeeze(np.packbits(bits).tobytes()) for _, _, bits in found], pa.binary()),
        ],
        names=["chunk", "part", "reply"],
    )


def _find_repeated(batches):
    """Per chunk of a part: which of its keys another chunk has too."""
    for rows in C.runs_of(batches, "part"):
        arrays = [C.read_keys(r["keys"]) for r in rows]
        keys = np.concatenate(arrays)
        order = np.argsort(keys)
        same = keys[order[1:]] == keys[order[:-1]]
        twice = np.zeros(len(keys), dtype=bool)
        twice[order[1:]] = same
        twice[order[:-1]] |= same
        bits = np.split(twice, np.cumsum([len(a) for a in arrays])[:-1])
        found = [(r["chunk"], r["part"], b) for r, b in zip(rows, bits, strict=True)]
        yield _reply([x for x in found if x[2].any()])


def _find_later(batches):
    """Per chunk of a part: which of its windows start earlier in another chunk (by doc_id, then chunk)."""
    for rows in C.runs_of(batches, "part"):
        arrays = [C.read_keys(r["keys"]) for r in rows]
        sizes = [len(a) for a in arrays]
        keys, ids = np.concatenate(arrays), np.concatenate([C.read_small(r["extra"]) for r in rows])
        order = np.lexsort((np.repeat(np.arange(len(rows)), sizes), ids, keys))
        later = np.zeros(len(keys), dtype=bool)
        later[order[1:]] = keys[order[1:]] == keys[order[:-1]]
        bits = np.split(later, np.cumsum(sizes)[:-1])
        yield _reply([(r["chunk"], r["part"], b) for r, b in zip(rows, bits, strict=True) if b.any()])


def _judged(table: pa.Table, replies, count: int, window: int, period: int, cover):
    """A chunk's words, its candidate windows and their distinct hashes."""
    own = Chunk(table.column("text"), window, period, cover)
    keys, place, repeated = own.anchors()
    repeated = repeated | C.joined_bits(replies, C.split_keys(keys, count), len(keys))
    starts = own.candidates(own.at[repeated[place]])
    ids = _ids(table)
    rank = np.empty(len(ids), dtype=np.int64)
    rank[np.argsort(ids, kind="stable")] = np.arange(len(ids))
    return own, starts, ids, own.windows(starts, rank)


def _send_windows(count: int, window: int, period: int, cover):
    def run(batches):
        for batch in batches:
            for row in C.one_by_one(batch):
                _, _, ids, (keys, first, _, _) = _judged(C.unpack_table(row["body"]), row["replies_0"], count, window, period, cover)
                yield C.key_rows(row["chunk"], keys, count, lambda a, b: C.small_bytes(ids[first[a:b]]))

    return run


def _remove(count: int, window: int, period: int, cover, keep: list[str], texts: bool):
    def run(batches):
        for batch in batches:
            for row in C.one_by_one(batch):
                table = C.unpack_table(row["body"])
                own, starts, _, (keys, _, place, is_first) = _judged(table, row["replies_0"], count, window, period, cover)
                later = C.joined_bits(row["replies_1"], C.split_keys(keys, count), len(keys))
                gone = own.marked(starts[~is_first | later[place]])
                before = np.concatenate([[0], np.cumsum(gone)])
                n_removed = before[own.ends] - before[own.begins]
                kept = own.kept(gone)
                digests = [hashlib.sha256(x.as_buffer()).hexdigest() for x in kept]
                arrays = [table.column(c).combine_chunks() for c in keep]
                arrays = [a.chunk(0) if isinstance(a, pa.ChunkedArray) else a for a in arrays]
                names = [f"in_{i}" for i in range(len(keep))] + ["n_words", "n_removed", "kept_sha256"]
                arrays += [pa.array(own.ends - own.begins, pa.int64()), pa.array(n_removed, pa.int64()), pa.array(digests, pa.string())]
                if texts:
                    names, arrays = [*names, "kept_text"], [*arrays, pc.if_else(pa.array(n_removed > 0), kept, None)]
                yield pa.RecordBatch.from_arrays(arrays, names=names)

    return run


def _run(docs: DataFrame, keep: list[str], texts: bool, window: int, period: int, cover: tuple[int, ...]) -> DataFrame:
    """keep: the columns of ``docs`` to return, as in_0, in_1, ..."""
    shape = (window, period, cover)
    chunks = C.chunk_table(docs)
    count = C.n_parts(chunks, len(cover) / period / 6)  # a word is about six bytes
    anchors = C.by_part(chunks.select("chunk", "body").mapInArrow(_send_anchors(count, *shape), C.KEY_SCHEMA), count)
    repeated = stored(anchors.mapInArrow(_find_repeated, C.REPLY_SCHEMA), "anchors")
    told = C.with_replies(chunks.select("chunk", "body"), repeated)
    windows = C.by_part(told.mapInArrow(_send_windows(count, *shape), C.KEY_SCHEMA), count)
    later = stored(windows.mapInArrow(_find_later, C.REPLY_SCHEMA), "windows")
    told = C.with_replies(chunks.select("chunk", "body"), repeated, later)
    schema = T.StructType([T.StructField(f"in_{i}", docs.schema[c].dataType) for i, c in enumerate(keep)])
    schema = schema.add("n_words", "long").add("n_removed", "long").add("kept_sha256", "string")
    schema = schema.add("kept_text", "string") if texts else schema
    return told.mapInArrow(_remove(count, *shape, keep, texts), schema)


def dedup(docs: DataFrame, window: int = WINDOW, period: int = PERIOD, cover: tuple[int, ...] = COVER) -> DataFrame:
    """Per document: doc_id, n_words, n_removed, kept_sha256 (of the kept words joined by one space)."""
    slim = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    out = _run(slim, ["doc_id"], False, window, period, cover)
    return out.withColumnRenamed("in_0", "doc_id")


def strip(docs: DataFrame, window: int = WINDOW, period: int = PERIOD, cover: tuple[int, ...] = COVER) -> DataFrame:
    """The input's rows and columns; a text that lost words becomes its kept words joined by one space.

    Other texts stay as they are; a column ``n_chars`` is counted again. No row goes.
    """
    names = docs.columns
    renamed = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col("text").cast("string").alias("text"),
        *[F.col(f"`{c}`").alias(f"_c{i}") for i, c in enumerate(names) if c not in ("doc_id", "text")],
    )
    keep = renamed.columns
    out = _run(renamed, keep, True, window, period, cover)
    at = {c: f"in_{i}" for i, c in enumerate(keep)}
    text = F.coalesce("kept_text", F.col(at["text"]))
    columns = []
    for i, c in enumerate(names):
        if c == "text":
            columns.append(text.alias("text"))
        elif c == "n_chars":
            columns.append(F.when(F.col("n_removed") > 0, F.length(text)).otherwise(F.col(at[f"_c{i}"])).cast(docs.schema[c].dataType).alias(c))
        else:
            columns.append(F.col(at["doc_id" if c == "doc_id" else f"_c{i}"]).alias(c))
    return out.select(*columns)
