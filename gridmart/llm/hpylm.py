"""Language-model scores: a hierarchical Pitman-Yor model over words.

Tokens are lower-cased (A-Z) words and one end per text. A token's context is the word before it, or the
start of the text. Each context is a restaurant; all share the unigram restaurant as their parent, whose
base gives one half to the unknown word and the other half evenly to the V training words:

    P1(w)     = (c_w  - d1 t_w  + (h1 + d1 T1) G0(w)) / (h1 + C1)
    P(w | u)  = (c_uw - d2 t_uw + (h2 + d2 T_u) P1(w)) / (h2 + C_u)

where the parent's customers c_w are the tables t_uw of its children. Seating starts with one table for
each dish and is sampled by blocked Gibbs sweeps: a sweep reseats all customers of every (context, word)
by the Chinese-restaurant rule, given the totals after the sweep before, then those of the parent. (A
customer block of an eighth of those seated is seated against the same counts.) Probabilities are
averaged over the last ``SAMPLES`` sweeps; discounts are estimated from counts of counts.

Distribution: chunks of coded texts (``chunks.py``) send their distinct training pairs to the part of the
context's key, which sums the counts and holds the seating of its restaurants, so that all of a context is
in one place: its customers and tables never travel. The parent's customers are sums over contexts, by word:
in every sweep a part sends the words of its pairs with their tables to the parts of the words, which seat
the parent and answer with its customers and tables. What a sweep has seated (the tables of every pair) passes
through with the sums, so the next one begins there. At the end both kinds of parts answer each chunk for its
own pairs and words: for training pairs by their places in the part, which it has kept for each chunk. Restaurants grow with the corpus and stay distributed; the driver sees only totals.
Sampling is seeded by part and sweep, so retries agree. 64-bit hashes stand for words. A hot context (the
start of a text, a frequent word) is one part's work: its distinct pairs are at most the distinct words.

Each sweep's result is written to the shared folder, the one before it is removed, and the shuffles behind
it are given up, so the disk holds one sweep at a time.

Defined cases: a null or empty text is the end token alone; a null doc_id counts as ''; without training
texts every token is unknown with probability 1; repeated rows are scored alike; an empty table gives an
empty result; other columns are not read.
"""

from __future__ import annotations

import gc

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gridmart.llm import chunks as C
from gridmart.llm.common import prepare, remove, stored

SWEEPS = 3
SAMPLES = 2
STRENGTH = 1.0
SEED = 97
CHUNK_BYTES = 3_000_000
KEYS_PER_PART = 300_000
PAIRS_PER_KEY = 3
END, START = b" end ", b" start "  # no word holds a space


class _Keys(dict):
    """64-bit hash of a word."""

    def __missing__(self, word: bytes) -> int:
        import xxhash

        out = self[word] = xxhash.xxh64_intdigest(word)
        return out


_keys = _Keys()


def _join(*arrays: bytes) -> bytes:
    return b"".join(len(a).to_bytes(8, "little") + a for a in arrays)


def _part(data: bytes) -> list[bytes]:
    out, at = [], 0
    while at < len(data):
        n = int.from_bytes(data[at : at + 8], "little")
        out.append(data[at + 8 : at + 8 + n])
        at += 8 + n
    return out


def _code(table: pa.Table) -> bytes:
    """A chunk: keys, then ids, held-out flags, tokens per text, token codes (places in the keys), places of start and end."""
    sizes, words = C.split_words(table.column("text"), lower=True)
    hashes, code = C.hash_words(words)
    marks = np.array([_keys[START], _keys[END]], dtype=np.uint64)
    keys, place = np.unique(np.concatenate([hashes, marks]), return_inverse=True)
    sizes = sizes + 1
    codes = np.full(sizes.sum(), place[-1])
    is_word = np.ones(len(codes), dtype=bool)
    is_word[np.cumsum(sizes) - 1] = False
    codes[is_word] = place[code]
    ids = table.column("doc_id").to_pylist()
    known = np.array([i is not None for i in ids], dtype=np.int64)
    held = np.array(table.column("held_out").to_pylist(), dtype=np.int64)
    numbers = np.array([i or 0 for i in ids], dtype=np.int64)
    arrays = (numbers, known, held, sizes, codes, np.array([len(keys), *place[-2:]]))
    return _join(C.key_bytes(keys), *map(C.small_bytes, arrays))


def _coded(text_at: int, chunk_bytes: int):
    """Rows (chunk, size, body, keys): the keys stand by themselves, since the scores take the body alone."""
    gather = C._gather(text_at, chunk_bytes, _code)

    def run(batches):
        for batch in gather(batches):
            keys, *numbers = _part(batch.column("body")[0].as_py())
            out = batch.set_column(2, "body", pa.array([_join(*numbers)], pa.binary()))
            yield out.append_column("keys", pa.array([keys], pa.binary()))

    return run


def seat(customers: np.ndarray, strength: np.ndarray, discount: float, rng: np.random.Generator) -> np.ndarray:
    """Tables after seating the customers of every dish: a new table with weight ``strength``, an occupied one
    with weight (seated - discount x tables)."""
    tables = np.minimum(customers, 1)
    active = np.flatnonzero(customers > 1)
    seated, strength, wanted = np.ones(len(active)), strength[active], customers[active]
    own = np.ones(len(active), dtype=np.int64)
    while len(active):
        block = np.minimum(np.maximum(1, seated // 8), wanted - seated).astype(np.int64)
        own += rng.binomial(block, strength / (strength + seated - discount * own))
        seated += block
        done = seated >= wanted
        if done.any():
            tables[active[done]] = own[done]
            active, seated, strength, wanted, own = (x[~done] for x in (active, seated, strength, wanted, own))
    return tables


class Model:
    """The totals that every part and chunk needs; one set after each sweep."""

    def __init__(self):
        self.n_words = self.n_tokens = 0
        self.discount = self.root_discount = 0.5
        self.customers: list[float] = []  # of the parent, per sweep
        self.tables: list[float] = []

    def unigram(self, s: int, customers: np.ndarray, tables: np.ndarray, known=True) -> np.ndarray:
        base = np.where(known, 0.5 / max(1, self.n_words), 0.5 if self.n_words else 1.0)
        weight = STRENGTH + self.root_discount * self.tables[s]
        return (customers - self.root_discount * tables + weight * base) / (STRENGTH + self.customers[s])

    def root_strength(self, s: int) -> float:
        """Weight of a new table in the parent for a known word, after sweep ``s``."""
        return (STRENGTH + self.root_discount * self.tables[s]) * 0.5 / max(1, self.n_words)


def _discount(ones: float, twos: float) -> float:
    return min(0.95, max(0.05, ones / (ones + 2 * twos))) if ones else 0.5


def held_out(doc_id: Column, folds: int = 7, rest: int = 2) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % folds == rest


ENTRY_SCHEMA = "owner int, chunk long, contexts binary, words binary, pairs binary, ones long, twos long"
SUM_SCHEMA = "part int, chunk long, keys binary, extra binary, customers long, roots long, words long, tokens long, ones long, twos long"
#: Chunk numbers from here on, plus the sweep, are those of a part's own tables.
TABLE = -(1 << 20)
#: Parts of rows that pass the sums by: what a sweep has seated.
PASSING = -1


class Bigrams:
    """A chunk's distinct (context, word) pairs, by context key and word key; words are places in the chunk's keys."""

    def __init__(self, body: bytes):
        self.ids, self.known, self.held, self.sizes, self.tokens, (size, self.start, self.end) = map(C.read_small, _part(body))
        self.begins = np.cumsum(self.sizes) - self.sizes
        before = np.concatenate([[0], self.tokens[:-1]])
        before[self.begins] = self.start
        pairs, self.place = C.places(before * size + self.tokens)
        self.context, self.word = pairs // size, pairs % size
        self.count = np.bincount(self.place[np.repeat(self.held == 0, self.sizes)], minlength=len(pairs))

    def rows(self, chunk: int, keys: np.ndarray, parts: int, training: bool) -> pa.RecordBatch:
        """Rows of KEY_SCHEMA: the contexts of each part, with the words of their pairs. Training pairs come
        with their counts, the other ones (of held-out texts alone) ask for replies."""
        chosen = (self.count > 0) == training
        context, word, count, out = self.context[chosen], self.word[chosen], self.count[chosen], []
        for part, a, b in C.split_keys(keys, parts):
            x, y = np.searchsorted(context, [a, b])
            if x < y:
                own, n = np.unique(context[x:y], return_counts=True)
                used, at = np.unique(word[x:y], return_inverse=True)
                numbers = (n, at, count[x:y]) if training else (n, at)
                out.append((part, chunk, C.key_bytes(keys[own]), _join(C.key_bytes(keys[used]), *map(C.small_bytes, numbers))))
        return _key_batch(out)


def _key_batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) or [[]] * 4
    types = [pa.int32(), pa.int64(), pa.binary(), pa.binary()]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=["part", "chunk", "keys", "extra"])


def _sent_pairs(parts: int, training: bool):
    """A chunk's pairs, by the parts of their contexts: those of training texts, or the other ones."""

    def run(batches):
        for batch in batches:
            for row in C.one_by_one(batch):
                yield Bigrams(row["body"]).rows(row["chunk"], C.read_keys(row["keys"]), parts, training)

    return run


def _read_pairs(row: dict) -> tuple[np.ndarray, ...]:
    """(context keys, word keys, pairs per context, word of every pair, ...) of a row of KEY_SCHEMA."""
    words, *numbers = _part(row["extra"])
    return C.read_keys(row["keys"]), C.read_keys(words), *map(C.read_small, numbers)


def _entries(batches):
    """The distinct pairs of a part, by context and word: pairs per context, word and count of every pair; and
    a row for each chunk with the places of its pairs among them, which is all that its replies take later."""
    for rows in C.runs_of(batches, "part"):
        found = [_read_pairs(r) for r in rows]
        contexts, words = (C.distinct(np.concatenate([f[k] for f in found])) for k in (0, 1))
        codes = [np.repeat(np.searchsorted(contexts, c), n) * len(words) + np.searchsorted(words, w)[at] for c, w, n, at, _ in found]
        pairs, place = C.places(np.concatenate(codes))
        del codes
        count = np.bincount(place, weights=np.concatenate([f[4] for f in found]), minlength=len(pairs)).astype(np.int64)
        per_context = np.bincount(pairs // len(words), minlength=len(contexts))
        body = _join(*map(C.small_bytes, (per_context, pairs % len(words), count)))
        owner, ends = rows[0]["part"], np.cumsum([len(f[4]) for f in found])
        out = [(owner, None, C.key_bytes(contexts), C.key_bytes(words), body, int((count == 1).sum()), int((count == 2).sum()))]
        for r, end, n in zip(rows, ends, np.diff(ends, prepend=0), strict=True):
            steps = np.diff(place[end - n : end], prepend=0)  # ascending, as the chunk's pairs are
            out.append((owner, r["chunk"], None, None, C.small_bytes(steps), 0, 0))
        types = [pa.int32(), pa.int64(), pa.binary(), pa.binary(), pa.binary(), pa.int64(), pa.int64()]
        names = ["owner", "chunk", "contexts", "words", "pairs", "ones", "twos"]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), types, strict=True)], names=names)


class Restaurants:
    """The contexts of one part, and the customers of their dishes."""

    def __init__(self, row: dict):
        self.contexts, self.words = C.read_keys(row["contexts"]), C.read_keys(row["words"])
        self.per_context, self.word, self.count = map(C.read_small, _part(row["pairs"]))
        self.context = np.repeat(np.arange(len(self.contexts)), self.per_context)

    def by_context(self, values: np.ndarray) -> np.ndarray:
        return np.bincount(self.context, weights=values, minlength=len(self.contexts)).astype(np.int64)

    def by_word(self, values: np.ndarray) -> np.ndarray:
        return np.bincount(self.word, weights=values, minlength=len(self.words)).astype(np.int64)

    def reseat(self, model: Model, s: int, tables: np.ndarray, customers: np.ndarray, roots: np.ndarray, seed: int) -> np.ndarray:
        """Tables of every pair, given the totals after sweep ``s`` and the parent's customers and tables of the words."""
        parent = model.unigram(s, customers, roots)
        pull = (STRENGTH + model.discount * self.by_context(tables)[self.context]) * parent[self.word]
        return seat(self.count, pull, model.discount, np.random.default_rng([SEED, seed, s]))


def _sweep(model: Model, sweep: int, parts: int):
    """Seat the restaurants and send the words' tables; the tables of every pair pass by. The first time one table a dish."""

    def run(batches):
        for batch in batches:
            for row in C.one_by_one(batch):
                own = Restaurants(row)
                values = []
                if sweep:
                    told = [list(map(C.read_small, _part(r["reply"]))) for r in row["replies_0"] if r["part"] >= 0]
                    customers, roots = (np.concatenate(x) for x in zip(*told, strict=True))
                    before = next(C.read_small(r["reply"]) for r in row["replies_0"] if r["part"] == PASSING)
                    tables = own.reseat(model, sweep - 1, before, customers, roots, row["owner"])
                else:
                    tables = np.ones(len(own.count), dtype=np.int64)
                    values = [own.by_word(own.count)]
                values.insert(0, own.by_word(tables))
                yield C.key_rows(row["owner"], own.words, parts, lambda a, b, values=values: _join(*(C.small_bytes(x[a:b]) for x in values)))
                yield _key_batch([(PASSING, row["owner"], b"", C.small_bytes(tables))])

    return run


def _sums(model: Model, sweep: int, pair_parts: int, last: bool):
    """Of a part's words: the parent's customers and tables; a row for each asking part, and the part's own."""
    names = ["part", "chunk", "keys", "extra", "customers", "roots", "words", "tokens", "ones", "twos"]
    types = [pa.int32(), pa.int64(), pa.binary(), pa.binary(), *[pa.int64()] * 6]

    def batch_of(rows):
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names=names)

    def summed(rows):
        asked = [C.read_keys(r["keys"]) for r in rows]
        keys = C.distinct(np.concatenate(asked))
        at = [np.searchsorted(keys, x) for x in asked]
        columns = zip(*(map(C.read_small, _part(r["extra"])) for r in rows), strict=True)
        place = np.concatenate(at)
        customers, *counts = (np.bincount(place, weights=np.concatenate(x), minlength=len(keys)).astype(np.int64) for x in columns)
        roots = np.minimum(customers, 1)
        if sweep:
            rng = np.random.default_rng([SEED, pair_parts + rows[0]["part"], sweep])
            roots = seat(customers, np.full(len(keys), model.root_strength(sweep - 1)), model.root_discount, rng)
        part, told = rows[0]["part"], (customers, roots)
        # Nothing is seated after the last sweep.
        totals = [customers.sum(), roots.sum(), (customers > 0).sum(), counts[0].sum() if counts else 0, (customers == 1).sum(), (customers == 2).sum()]
        yield batch_of([(part, TABLE + sweep, C.key_bytes(keys), _join(*map(C.small_bytes, told if sweep else counts)), *map(int, totals))])
        for r, k in zip(rows, at, strict=True) if not last else ():
            yield batch_of([(part, r["chunk"], b"", _join(*(C.small_bytes(x[k]) for x in told)), 0, 0, 0, 0, 0, 0)])

    def run(batches):
        for rows in C.runs_of(batches, "part"):
            if rows[0]["part"] == PASSING:
                for r in rows:
                    yield batch_of([(PASSING, r["chunk"], b"", r["extra"], 0, 0, 0, 0, 0, 0)])
            else:
                yield from summed(rows)

    return run


def _asked_words(parts: int):
    """A chunk's words, by their parts."""

    def run(batches):
        for batch in batches:
            for chunk, keys in zip(batch.column("chunk").to_pylist(), batch.column("keys"), strict=True):
                yield C.key_rows(chunk, C.read_keys(keys.as_py()), parts)

    return run


def _seated(batches):
    """Rows of KEY_SCHEMA: the restaurants of a part, with the tables of each sample."""
    for batch in batches:
        for row in batch.to_pylist():
            tables = [r["reply"] for r in sorted(row["replies_0"], key=lambda r: r["part"])]
            yield _key_batch([(row["owner"], TABLE, row["contexts"], _join(row["words"], row["pairs"], *tables))])


def _find(keys: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    if not len(keys):
        return np.zeros(len(wanted), np.int64), np.zeros(len(wanted), bool)
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return at, keys[at] == wanted


def _pick(values: np.ndarray, at: np.ndarray, found: np.ndarray) -> np.ndarray:
    return np.where(found, values[at], 0) if len(values) else np.zeros(len(at), np.int64)


#: Rows of a chunk's training pairs: what is added to its number.
PLACES = 1 << 61


def _told_pairs(rows: list[dict], samples: int):
    """Replies for pairs: count and tables of each pair, tables of each context (its customers are the word's count).

    A chunk's training pairs are told by their places, and marked by a number of PLACES and more; the
    others by context and word.
    """
    none = np.empty(0, np.int64)
    contexts = words = np.empty(0, np.uint64)
    codes, per_pair, per_context = none, [none] * (1 + samples), [none] * samples
    if rows[0]["chunk"] < 0:
        held, pairs, *tables = _part(rows[0]["extra"])
        own = Restaurants({"contexts": rows[0]["keys"], "words": held, "pairs": pairs})
        contexts, words = own.contexts, own.words
        codes = own.context * len(words) + own.word  # sorted
        per_pair = [own.count, *map(C.read_small, tables)]
        per_context = [own.by_context(x) for x in per_pair[1:]]
    for r in rows:
        if r["chunk"] >= PLACES:
            at = np.cumsum(C.read_small(r["extra"]))
            first = np.append(True, np.diff(own.context[at]) > 0) if len(at) else np.empty(0, bool)
            yield r, [*(x[at] for x in per_pair), *(x[own.context[at][first]] for x in per_context)]
        elif r["chunk"] >= 0:
            own_contexts, own_words, n, at = _read_pairs(r)
            c, seen = _find(contexts, own_contexts)
            w, known = _find(words, own_words)
            pair, hit = _find(codes, np.repeat(c, n) * len(words) + w[at])
            hit &= np.repeat(seen, n) & known[at]
            yield r, [*(_pick(x, pair, hit) for x in per_pair), *(_pick(x, c, seen) for x in per_context)]


def _told_words(rows: list[dict], samples: int):
    """Replies for words: training count, then the parent's customers and tables of each sample."""
    own = [r for r in rows if r["chunk"] < 0]
    columns = [x for r in own for x in map(C.read_small, _part(r["extra"]))] or [np.empty(0, np.int64)] * (1 + 2 * samples)
    keys = C.read_keys(own[0]["keys"]) if own else np.empty(0, np.uint64)
    for r in rows:
        if r["chunk"] >= 0:
            at, found = _find(keys, C.read_keys(r["keys"]))
            yield r, [_pick(x, at, found) for x in columns]


#: Added to the part of a reply for training pairs.
TRAINING = 1 << 29


def _told(answer, samples: int, first: int = 0):
    """Replies of all parts, numbered from ``first`` on."""

    def run(batches):
        for rows in C.runs_of(batches, "part"):
            for r, values in answer(rows, samples):
                reply, places = _join(*map(C.small_bytes, values)), r["chunk"] >= PLACES
                # Replies of training pairs are numbered after all parts.
                chunk, part = (r["chunk"] - PLACES, TRAINING + r["part"]) if places else (r["chunk"], first + r["part"])
                yield pa.RecordBatch.from_arrays(
                    [pa.array([chunk], pa.int64()), pa.array([part], pa.int32()), pa.array([reply], pa.binary())], names=["chunk", "part", "reply"]
                )

    return run


def _score(model: Model, sweeps: int, samples: int, pair_parts: int):
    names = ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"]

    def run(batches):
        for batch in batches:
            for row in C.one_by_one(batch):
                own = Bigrams(row["body"])
                told = [(r["part"], list(map(C.read_small, _part(r["reply"])))) for r in row["replies_0"]]
                counts, *parent = (np.concatenate(x) for x in zip(*(c for part, c in told if pair_parts <= part < TRAINING), strict=True))
                per_pair = np.zeros((1 + 2 * samples, len(own.word)), dtype=np.int64)
                for training in (True, False):
                    mine = (own.count > 0) == training
                    found = [c for part, c in told if (part >= TRAINING if training else part < pair_parts)]
                    if found:
                        of_pairs, of_contexts = range(1 + samples), range(1 + samples, 1 + 2 * samples)
                        columns = [np.concatenate(x) for x in zip(*found, strict=True)]
                        # A reply has a value for each context of its pairs, in order.
                        context = np.unique(own.context[mine], return_inverse=True)[1]
                        per_pair[:, mine] = [*(columns[k] for k in of_pairs), *(columns[k][context] for k in of_contexts)]
                count, *tables = per_pair[: 1 + samples]
                in_context = per_pair[1 + samples :]
                # A training word comes before one token each time, the start once before each training text.
                customers = np.where(own.context == own.start, counts[own.end], counts[own.context])
                chance = np.zeros(len(own.word))
                for k, s in enumerate(range(1 + sweeps - samples, sweeps + 1)):
                    chance_of_word = model.unigram(s, parent[2 * k], parent[2 * k + 1], counts > 0)[own.word]
                    weight = STRENGTH + model.discount * in_context[k]
                    chance += (count - model.discount * tables[k] + weight * chance_of_word) / (STRENGTH + customers)
                token_score = np.log10(chance / samples)[own.place]
                base = np.log10((counts + 1) / (model.n_tokens + model.n_words + 1))[own.tokens]
                add = lambda x, own=own: np.add.reduceat(x, own.begins)
                ids = [i if ok else None for i, ok in zip(own.ids.tolist(), own.known.tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(ids, pa.int64()), pa.array(own.held != 0), pa.array(own.sizes, pa.int64()),
                        pa.array(add((counts > 0).astype(np.int64)[own.tokens]), pa.int64()),
                        pa.array(np.full(len(ids), model.n_tokens, np.int64)), pa.array(add(base), pa.float64()), pa.array(add(token_score), pa.float64()),
                    ],
                    names=names,
                )

    return run


def _release(spark: SparkSession) -> None:
    """Spark removes the files of shuffles that nothing refers to any more, when the driver's garbage is collected."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def fit(chunks: DataFrame, pair_parts: int, parts: int, sweeps: int, samples: int) -> tuple[Model, DataFrame, list[DataFrame]]:
    """(totals, the restaurants and the chunks' places in them, the sums that the scores need: counts, then those of each sample)."""
    spark = chunks.sparkSession
    sent = chunks.select("chunk", "body", "keys").mapInArrow(_sent_pairs(pair_parts, True), C.KEY_SCHEMA)
    pairs = stored(C.by_part(sent, pair_parts).mapInArrow(_entries, ENTRY_SCHEMA), "pairs")
    entries = pairs.where("chunk is null").select("owner", F.col("owner").cast("long").alias("chunk"), "contexts", "words", "pairs", "ones", "twos")
    del sent
    _release(spark)
    model, kept, sums = Model(), [], None
    counted = entries.agg(F.sum("ones"), F.sum("twos")).first()
    model.discount = _discount(counted[0] or 0, counted[1] or 0)
    for sweep in range(sweeps + 1):
        if sums is None:
            given = entries
        else:
            replies = sums.where("chunk >= 0").select("chunk", "part", F.col("extra").alias("reply"))
            given = C.with_replies(entries, replies)
        sent = given.mapInArrow(_sweep(model, sweep, parts), C.KEY_SCHEMA)
        before, sums = sums, stored(C.by_part(sent, parts + 1).mapInArrow(_sums(model, sweep, pair_parts, sweep == sweeps), SUM_SCHEMA), "sums")
        names = ("customers", "roots", "words", "tokens", "ones", "twos")
        total = {n: x or 0 for n, x in sums.agg(*(F.sum(n).alias(n) for n in names)).first().asDict().items()}
        if not sweep:
            model.n_words, model.n_tokens = total["words"], total["tokens"]
            model.root_discount = _discount(total["ones"], total["twos"])
        model.customers.append(float(total["customers"]))
        model.tables.append(float(total["roots"]))
        if not sweep or sweep > sweeps - samples:
            kept.append(sums)
        if before is not None:
            at = next((k for k, x in enumerate(kept) if x is before), None)
            if at is not None:  # its replies are not needed any more
                kept[at] = stored(before.where((F.col("chunk") < 0) | (F.col("part") == PASSING)), "sums-kept")
            remove(before)
        del sent, given, before
        _release(spark)
    return model, pairs, kept


def score(docs: DataFrame, sweeps: int = SWEEPS, samples: int = SAMPLES) -> DataFrame:
    """Per document: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, perplexity.

    Learns from the documents outside the held-out fold and scores all of them.
    """
    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out(F.col("doc_id")).alias("held_out"), F.col("text").cast("string").alias("text"))
    prepare(docs.sparkSession)
    chunks = stored(slim.mapInArrow(_coded(slim.columns.index("text"), CHUNK_BYTES), C.CHUNK_SCHEMA + ", keys binary"), "chunks")
    pair_parts, parts = C.n_parts(chunks, 1 / 12, PAIRS_PER_KEY * KEYS_PER_PART), C.n_parts(chunks, 1 / 24, KEYS_PER_PART)
    model, pairs, sums = fit(chunks, pair_parts, parts, sweeps, samples)
    entries = pairs.where("chunk is null").withColumn("chunk", F.col("owner").cast("long"))
    tables = None
    for sweep, one in enumerate(sums[1:]):
        passed = one.where(F.col("part") == PASSING).select("chunk", F.lit(sweep).alias("part"), F.col("extra").alias("reply"))
        tables = passed if tables is None else tables.unionByName(passed)
    seated = C.with_replies(entries, tables).mapInArrow(_seated, C.KEY_SCHEMA)
    numbered = F.col("chunk") + PLACES
    places = pairs.where("chunk is not null").select(F.col("owner").alias("part"), numbered.alias("chunk"), F.lit(b"").alias("keys"), F.col("pairs").alias("extra"))
    asked = chunks.select("chunk", "body", "keys").mapInArrow(_sent_pairs(pair_parts, False), C.KEY_SCHEMA).unionByName(seated).unionByName(places)
    told_pairs = stored(C.by_part(asked, pair_parts).mapInArrow(_told(_told_pairs, samples), C.REPLY_SCHEMA), "told-pairs")
    del asked, seated, places
    remove(pairs)
    _release(docs.sparkSession)
    asked = chunks.select("chunk", "keys").mapInArrow(_asked_words(parts), C.KEY_SCHEMA)
    for one in sums:
        asked = asked.unionByName(one.where("chunk < 0").select("part", "chunk", "keys", "extra"))
    told_words = stored(C.by_part(asked, parts).mapInArrow(_told(_told_words, samples, pair_parts), C.REPLY_SCHEMA), "told-words")
    del asked
    for one in sums:
        remove(one)
    _release(docs.sparkSession)
    told = told_pairs.unionByName(told_words)
    schema = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    scored = C.with_replies(chunks.select("chunk", "body"), told).mapInArrow(_score(model, sweeps, samples, pair_parts), schema)
    return scored.withColumn("perplexity", F.pow(F.lit(10.0), -F.col("score") / F.col("n_tokens")))
