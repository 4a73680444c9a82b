"""Packing token sequences: shortest-pack-first over the length histogram.

1. Every document is tokenised whole, ends with an end id, and is cut at multiples of the capacity
   into pieces (at most the last one is shorter).
2. The histogram of piece lengths (at most ``capacity`` rows, whatever the input) goes to the driver,
   which places lengths longest first: a length goes on the pattern with the most room left, count by
   count; where none has room, new packs are opened, filled with that length. Only pattern counts
   change, so the work depends on the number of lengths and patterns, not of documents.
3. Patterns become runs ``(length, first rank) -> (sequence, offset)``; a piece finds its run by its
   rank among the pieces of its length.

Bounds: patterns <= 3 x capacity and a pattern holds fewer than sqrt(2 x capacity) distinct lengths,
so the table of runs is bounded by the capacity alone (about 1 million rows at 4096 at the very worst,
some thousands in practice) and is shipped with the tasks. Ranks within a length are numbered by
(length, hash bucket), so a length that a third of all pieces share is spread over many tasks.

Defined cases: a null or empty text has the end id only; repeated rows are packed separately; an
empty table gives an empty result; very long texts are cut into many pieces; input columns beside
``doc_id`` and ``text`` are not read.
"""

from __future__ import annotations

import re
import zlib
from array import array
from collections import defaultdict
from functools import lru_cache
from unicodedata import is_normalized

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridmart.llm.common import prepare, stored
from gridmart.llm.hashtree import number_slots

CAPACITY = 4096
END_ID = 2
VOCABULARY = "word_bpe_49k.json"
#: Words in one generation of a worker's memory (two are kept; results do not depend on it).
CACHE_WORDS = 250_000

PIECE_SCHEMA = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"


@lru_cache(maxsize=2)
def _encoder(vocabulary: str):
    """Text -> little-endian uint32 ids as bytes. A tokenizer file: a path, or a name of public_tokenizers."""
    import os

    from tokenizers import Tokenizer

    if not os.path.exists(vocabulary):
        import public_tokenizers

        vocabulary = public_tokenizers.path(vocabulary)
    return Words(Tokenizer.from_file(vocabulary))


def _byte_letters() -> dict[int, str]:
    """How byte-level vocabularies write a byte: printable Latin-1 as itself, the others from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = (b for b in range(256) if b not in plain)
    return {b: chr(b) for b in plain} | {b: chr(0x100 + k) for k, b in enumerate(others)}


_WORD_AND_MARKS = re.compile(r"([^\W\d_]+)([!-/:-@\[-`{-~]+)")


class Words(dict):
    """Ids of white-space separated words, as bytes.

    The vocabulary's pre-tokenizer never joins characters over ASCII white space and drops it, so
    the ids of a text are those of its words, one after the other. It also parts letters from marks and
    lower-cases, so a new word is looked up by its parts; a lower-case word of letters goes to the
    tokenizer's model directly, anything else through the whole tokenizer (tested against whole texts).
    The words of the generation before are remembered too.
    """

    def __init__(self, tokenizer):
        super().__init__()
        self.tokenizer, self.model, self.before = tokenizer, tokenizer.model, {}
        self.letters = _byte_letters()

    def __missing__(self, word: bytes) -> bytes:
        out = self.before.get(word)
        if out is None:
            out = self.look_up(word)
        self[word] = out
        return out

    def look_up(self, word: bytes) -> bytes:
        text = word.decode()
        if text.isalpha():
            if text == text.lower():
                if word.isascii():
                    return array("I", [t.id for t in self.model.tokenize(text)]).tobytes()
                if is_normalized("NFC", text):
                    return array("I", [t.id for t in self.model.tokenize("".join(map(self.letters.__getitem__, word)))]).tobytes()
            elif word.isascii():
                return self[word.lower()]
        elif (parts := _WORD_AND_MARKS.fullmatch(text)) and parts[1].lower().isalpha() and is_normalized("NFC", text):
            return self[parts[1].encode()] + self[parts[2].encode()]
        return array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()

    def encode(self, text: str) -> bytes:
        if len(self) > CACHE_WORDS:
            self.before = dict(self)
            self.clear()
        return b"".join(map(self.__getitem__, text.encode().split()))


def _cut(vocabulary: str, capacity: int, end_id: int, keep_ids: bool):
    def run(batches):
        encoder = _encoder(vocabulary)
        end = np.asarray([end_id], dtype="<u4").tobytes()
        for batch in batches:
            out: list[list] = [[], [], [], [], [], []]
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                ids = encoder.encode(text.as_py() or "") + end
                total = len(ids) // 4
                for start in range(0, total, capacity):
                    piece = ids[4 * start : 4 * (start + capacity)]
                    row = (doc_id, start, len(piece) // 4, zlib.crc32(piece), total, piece)
                    for column, value in zip(out, row, strict=True):
                        column.append(value)
            names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
            arrays = [pa.array(x, pa.int64()) for x in out[:5]]
            if keep_ids:
                names, arrays = [*names, "ids"], [*arrays, pa.array(out[5], pa.binary())]
            yield pa.RecordBatch.from_arrays(arrays, names=names)

    return run


def cut_pieces(docs: DataFrame, vocabulary: str = VOCABULARY, capacity: int = CAPACITY, end_id: int = END_ID, keep_ids: bool = False) -> DataFrame:
    """One row per piece; with ``keep_ids`` also its ids (little-endian uint32, binary)."""
    prepare(docs.sparkSession)
    schema = PIECE_SCHEMA + (", ids binary" if keep_ids else "")
    slim = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return slim.mapInArrow(_cut(vocabulary, capacity, end_id, keep_ids), schema)


def pack_histogram(histogram: dict[int, int], capacity: int = CAPACITY) -> list[tuple[tuple | None, int]]:
    """Shortest-pack-first: [(pattern, count)], a pattern being a linked list (length, times, rest)."""
    room: dict[int, list[list]] = defaultdict(list)  # room left -> [count, pattern]
    for length in sorted(histogram, reverse=True):
        left = histogram[length]
        at = max((r for r, packs in room.items() if packs), default=-1)
        while left and at >= length:
            if not room[at]:
                at -= 1
                continue
            # The shortest packs: as many as there are pieces of this length get one each.
            count, pattern = room[at].pop()
            taken = min(count, left)
            if count > taken:
                room[at].append([count - taken, pattern])
            if pattern is not None and pattern[0] == length:
                grown = (length, pattern[1] + 1, pattern[2])
            else:
                grown = (length, 1, pattern)
            room[at - length].append([taken, grown])
            left -= taken
        if left:
            each = capacity // length
            for count, times in ((left // each, each), (1, left % each)):
                if count and times:
                    room[capacity - length * times].append([count, (length, times, None)])
    return [(pattern, count) for _, packs in sorted(room.items()) for count, pattern in packs]


def runs(packs, capacity: int = CAPACITY) -> dict[str, np.ndarray]:
    """Runs sorted by (length, first rank): where the ranks of a length go."""
    used: dict[int, int] = defaultdict(int)
    rows, sequence = [], 0
    for pattern, count in packs:
        offset, node = 0, pattern
        while node is not None:
            length, times, node = node
            rows.append((length, used[length], count, sequence, offset))
            used[length] += times * count
            offset += length * times
        sequence += count
    rows.sort()
    columns = np.asarray(rows, dtype=np.int64).reshape(-1, 5).T
    return dict(zip(("length", "first", "count", "sequence", "offset"), columns, strict=True))


def _place(table: dict[str, np.ndarray]):
    def run(batches):
        for batch in batches:
            length = batch.column("length").to_numpy()
            rank = batch.column("slot").to_numpy()
            # The last run of this length whose first rank is not above: two searches, no composite key to overflow.
            at = np.empty(len(length), dtype=np.int64)
            for value in np.unique(length):
                lo, hi = np.searchsorted(table["length"], [value, value + 1])
                own = length == value
                at[own] = lo + np.searchsorted(table["first"][lo:hi], rank[own], side="right") - 1
            k = rank - table["first"][at]
            count = table["count"][at]
            columns = {name: batch.column(name) for name in batch.schema.names if name != "slot"}
            columns["sequence_id"] = pa.array(table["sequence"][at] + k % count)
            columns["offset"] = pa.array(table["offset"][at] + length * (k // count))
            yield pa.RecordBatch.from_pydict(columns)

    return run


def pack(docs: DataFrame, vocabulary: str = VOCABULARY, capacity: int = CAPACITY, end_id: int = END_ID, keep_ids: bool = False) -> DataFrame:
    """Per piece: doc_id, start, length, ids_crc32, doc_tokens, [ids,] sequence_id, offset."""
    pieces = cut_pieces(docs, vocabulary, capacity, end_id, keep_ids).withColumn("_at", F.monotonically_increasing_id())
    pieces = stored(pieces, "pieces")
    histogram = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}
    table = runs(pack_histogram(histogram, capacity), capacity)
    order = ["doc_id", "start", "ids_crc32", "doc_tokens"]
    ranked = number_slots(pieces, "length", order, histogram, "_at")
    ids = ["ids"] if keep_ids else []
    ranked = ranked.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", *ids, "slot")
    schema = PIECE_SCHEMA + (", ids binary" if keep_ids else "") + ", sequence_id long, offset long"
    return ranked.mapInArrow(_place(table), schema)


def sequences(packed: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """From ``pack(keep_ids=True)``: one row per sequence with its ids joined (bounded by the capacity)."""
    spans = F.sort_array(F.collect_list(F.struct("offset", "ids")))
    joined = packed.groupBy("sequence_id").agg(spans.alias("s"), F.sum("length").alias("n_tokens"))
    return joined.select("sequence_id", "n_tokens", F.expr("aggregate(s, X'', (a, x) -> concat(a, x.ids))").alias("ids"))
