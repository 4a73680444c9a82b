"""Chunks of documents, and exchanges of hash keys between chunks.

Operators that compare every position of every text would need a shuffled row per word. Instead a task
gathers the documents that it reads into chunks of a few MB, and a chunk exchanges *sorted arrays of
distinct 64-bit keys* with the others: one row per (chunk, part of the key space). A part sees one key
at most once per chunk, so however often a phrase occurs, no part grows with it, and Spark still deals
out, sorts, spills and retries the rows.

The chunk table is written to the shared folder once, so chunk ids are stable from then on.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridmart.llm.common import parts, prepare, stored

CHUNK_BYTES = 2_500_000
KEYS_PER_PART = 1_000_000
CHUNK_SCHEMA = "chunk long, size long, body binary"
KEY_SCHEMA = "part int, chunk long, keys binary, extra binary"
REPLY_SCHEMA = "chunk long, part int, reply binary"


def squeeze(data: bytes) -> bytes:
    """zstd, with the length in front."""
    return len(data).to_bytes(8, "little") + pa.compress(data, codec="zstd", asbytes=True) if data else b""


def expand(data: bytes) -> bytes:
    return pa.decompress(data[8:], int.from_bytes(data[:8], "little"), codec="zstd", asbytes=True) if data else b""


def pack_batch(batch: pa.RecordBatch) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, batch.schema) as writer:
        writer.write_batch(batch)
    return squeeze(sink.getvalue().to_pybytes())


def unpack_table(body: bytes) -> pa.Table:
    with pa.ipc.open_stream(expand(body)) as reader:
        return reader.read_all()


def _gather(text_at: int, chunk_bytes: int, encode: Callable[[pa.Table], bytes]):
    def run(batches):
        first = TaskContext.get().partitionId() << 32
        held: list[pa.RecordBatch] = []
        size = made = 0

        def close():
            nonlocal held, size, made
            body = encode(pa.Table.from_batches(held))
            out = pa.RecordBatch.from_arrays(
                [pa.array([first + made], pa.int64()), pa.array([size], pa.int64()), pa.array([body], pa.binary())], names=["chunk", "size", "body"]
            )
            held, size, made = [], 0, made + 1
            return out

        for batch in batches:
            lengths = [len(x.as_buffer()) if x.is_valid else 0 for x in batch.column(text_at)]
            start = 0
            for k, n in enumerate(lengths):
                size += n + 16
                if size >= chunk_bytes:
                    held.append(batch.slice(start, k + 1 - start))
                    start = k + 1
                    yield close()
            if start < batch.num_rows:
                held.append(batch.slice(start))
        if held:
            yield close()

    return run


def whole(table: pa.Table) -> bytes:
    """The usual encoding of a chunk: all its columns."""
    return pack_batch(table.combine_chunks().to_batches()[0])


def chunk_table(docs: DataFrame, text: str = "text", chunk_bytes: int = CHUNK_BYTES, encode: Callable[[pa.Table], bytes] = whole) -> DataFrame:
    """(chunk, size in bytes, body) of all rows, written to the shared folder; ``text`` must be a string column."""
    prepare(docs.sparkSession)
    return stored(docs.mapInArrow(_gather(docs.columns.index(text), chunk_bytes, encode), CHUNK_SCHEMA), "chunks")


def n_parts(chunks: DataFrame, keys_per_byte: float, keys_per_part: int = KEYS_PER_PART) -> int:
    """How many parts of the key space keep each at about ``keys_per_part`` keys."""
    size = chunks.agg(F.sum("size")).first()[0] or 0
    return parts(int(size * keys_per_byte), keys_per_part)


def split_keys(keys: np.ndarray, count: int) -> list[tuple[int, int, int]]:
    """(part, from, to) of sorted distinct uint64 keys: parts are equal ranges of the key space."""
    edges = [((k << 64) // count) for k in range(1, count)]
    at = [0, *np.searchsorted(keys, np.array(edges, dtype=np.uint64)).tolist(), len(keys)]
    return [(k, a, b) for k, (a, b) in enumerate(zip(at, at[1:], strict=False)) if a < b]


def _planes(values: np.ndarray) -> bytes:
    """uint64 values byte plane by byte plane, as many planes as the largest one needs (their number in front)."""
    if not len(values):
        return b""
    count = max(1, -(-int(values.max()).bit_length() // 8))
    out = np.empty((count, len(values)), np.uint8)
    for k in range(count):
        out[k] = values >> np.uint64(8 * k)
    return bytes([count]) + squeeze(out.tobytes())


def _read_planes(data: bytes) -> np.ndarray:
    if not data:
        return np.empty(0, np.uint64)
    raw = np.frombuffer(expand(data[1:]), np.uint8).reshape(data[0], -1)
    out = raw[0].astype(np.uint64)
    for k in range(1, len(raw)):
        out |= raw[k].astype(np.uint64) << np.uint64(8 * k)
    return out


def key_bytes(keys: np.ndarray) -> bytes:
    """Sorted uint64 keys as compressed differences."""
    return _planes(np.diff(keys, prepend=np.uint64(0)))


def read_keys(data: bytes) -> np.ndarray:
    return np.cumsum(_read_planes(data), dtype=np.uint64)


def small_bytes(values: np.ndarray) -> bytes:
    """Integers, mostly small."""
    return _planes(np.ascontiguousarray(values, dtype=np.int64).view(np.uint64))


def read_small(data: bytes) -> np.ndarray:
    return _read_planes(data).view(np.int64)


def distinct(values: np.ndarray) -> np.ndarray:
    """The distinct values, ascending. (NumPy's own ``unique`` hashes them, which takes many times as long.)"""
    ordered = np.sort(values)
    return ordered[np.append(True, ordered[1:] != ordered[:-1])] if len(ordered) else ordered


def places(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct values of non-negative integers, ascending, and the place of each value among them."""
    bits = len(values).bit_length()
    if not len(values) or int(values.max()).bit_length() + bits > 63:
        return np.unique(values, return_inverse=True)
    # Value and position in one number: a plain sort is faster than a sort of positions.
    ordered = np.sort((values << bits) | np.arange(len(values)))
    at, ordered = ordered & ((1 << bits) - 1), ordered >> bits
    new = np.append(True, ordered[1:] != ordered[:-1])
    place = np.empty(len(values), dtype=np.int64)
    place[at] = np.cumsum(new) - 1
    return ordered[new], place


def split_words(texts: pa.ChunkedArray, lower: bool = False) -> tuple[np.ndarray, pa.Array]:
    """The number of words in each text (null: none), and the words of all texts; ``lower``: A-Z lower-cased."""
    trimmed = pc.ascii_trim_whitespace(pc.fill_null(texts, "")).combine_chunks()
    lists = pc.ascii_split_whitespace(pc.ascii_lower(trimmed) if lower else trimmed)
    sizes, words = pc.list_value_length(lists).to_numpy().astype(np.int64), lists.flatten()
    blank = pc.equal(trimmed, "").to_numpy(zero_copy_only=False)  # split into one empty word
    if blank.any():
        sizes[blank] = 0
        words = words.filter(pc.not_equal(words, ""))
    return sizes, words


def hash_words(words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """XXH64 of the distinct words, and the place of each word among them."""
    import xxhash

    coded = words.dictionary_encode()
    if not len(words):
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    # Joined and split again: Python objects of Arrow's values one by one take longer.
    joined = pc.binary_join(pa.ListArray.from_arrays([0, len(coded.dictionary)], coded.dictionary), " ")
    each = joined[0].as_buffer().to_pybytes().split(b" ")
    return np.fromiter(map(xxhash.xxh64_intdigest, each), dtype=np.uint64, count=len(each)), coded.indices.to_numpy()


def one_by_one(batch: pa.RecordBatch) -> Iterator[dict]:
    """The rows of a batch; a large row is a Python object only in its turn."""
    for k in range(batch.num_rows):
        yield batch.slice(k, 1).to_pylist()[0]


def key_rows(chunk: int, keys: np.ndarray, count: int, extra: Callable[[int, int], bytes] | None = None) -> pa.RecordBatch:
    """Rows of KEY_SCHEMA for a chunk's sorted distinct keys; extra(from, to): what goes with that range."""
    spans = split_keys(keys, count)
    return pa.RecordBatch.from_arrays(
        [
            pa.array([p for p, _, _ in spans], pa.int32()),
            pa.array([chunk] * len(spans), pa.int64()),
            pa.array([key_bytes(keys[a:b]) for _, a, b in spans], pa.binary()),
            pa.array([extra(a, b) if extra else b"" for _, a, b in spans], pa.binary()),
        ],
        names=["part", "chunk", "keys", "extra"],
    )


def by_part(rows: DataFrame, count: int) -> DataFrame:
    """Dealt and sorted so that the rows of a part stand together, in the order of their chunks."""
    return rows.repartition(count, "part").sortWithinPartitions("part", "chunk")


def runs_of(batches: Iterator[pa.RecordBatch], name: str) -> Iterator[list[dict]]:
    """Consecutive rows with the same value of a column (rows of one part, of bounded total size)."""
    held: list[dict] = []
    for batch in batches:
        for row in one_by_one(batch):
            if held and held[0][name] != row[name]:
                yield held
                held = []
            held.append(row)
    if held:
        yield held


def with_replies(chunks: DataFrame, *replies: DataFrame) -> DataFrame:
    """Chunk rows, each with one array of (part, reply) per reply table (``replies_0``, ...)."""
    out = chunks
    for k, table in enumerate(replies):
        gathered = table.groupBy("chunk").agg(F.sort_array(F.collect_list(F.struct("part", "reply"))).alias(f"replies_{k}"))
        out = out.join(gathered.withColumnRenamed("chunk", f"_chunk_{k}"), F.col("chunk") == F.col(f"_chunk_{k}"), "left").drop(f"_chunk_{k}")
    return out


def joined_bits(replies: list[dict] | None, spans: list[tuple[int, int, int]], total: int) -> np.ndarray:
    """Bit replies of all parts, as one boolean per key."""
    out = np.zeros(total, dtype=bool)
    by = {r["part"]: r["reply"] for r in replies or ()}
    for part, a, b in spans:
        if part in by:
            out[a:b] = np.unpackbits(np.frombuffer(expand(by[part]), np.uint8), count=b - a).astype(bool)
    return out
