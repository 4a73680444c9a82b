"""Language identification: interpolated Kneser-Ney character models, one per language.

A text is read as its letters, lower-cased, with one space for every run of other characters (``fold``).
Each language has a model of order ``ORDER`` over these symbols. The highest order holds counts, a lower one
the number of distinct symbols seen before an n-gram; each takes a discount D = n1 / (n1 + 2 n2) and gives
the mass to the order below, the lowest to all symbols alike:

    P(c | h) = max(count(hc) - D, 0) / count(h) + D types(h) / count(h) * P(c | h without its first symbol)

An order is two sorted arrays of 64-bit hashes, n-grams with their discounted share and contexts with the
mass that they hand down; a text's n-grams are looked up by binary search, the distinct ones of a few
million characters at a time. Costs are summed as integers (2**-20 bit), so a text's score does not depend
on what else is in its batch. The language of least cross-entropy (cost per symbol) is chosen.

Fit: a sample of documents with a language outside the held-out fold, least hash first, of at most about
``SAMPLE_ROWS`` documents a language and ``SAMPLE_SYMBOLS`` symbols in all, shared by at most ``LANGUAGES``
languages (the most frequent); these bounds are parameters. It is cut by hash thresholds from counts, so no
task ranks a whole language. Each language is counted in one task; n-gram arrays, at most ``ORDER`` times the
symbols of the sample, go to the driver and out to the scoring tasks.

Calibration: a quarter of the sample, whole and in short pieces, is not fitted but scored. It sets the
temperature of ``score`` (a softmax over the languages' total costs, by maximum likelihood) and, for each
language and range of lengths, the cross-entropy that all but ``REJECT`` of its own texts stay under;
``rejected`` texts lie above that of the language chosen for them: likely in none of the learned languages
(a range of lengths with fewer than 20 calibration texts rejects none).

Defined cases: null texts and texts without a letter are ``und`` with score 0, rejected; without any
labelled document all texts are; rows with a null language or a null or held-out id are not learned from,
equal rows count once in the sample; ties go to the first language by code point; repeated rows get equal
results; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridmart.llm.common import prepare, stored
from gridmart.llm.mil import held_out

ORDER = 5
UNDETERMINED = "und"
SAMPLE_ROWS = 3000
SAMPLE_SYMBOLS = 8_000_000
LANGUAGES = 64
REJECT = 0.01
#: Calibration pieces, and the upper ends of the ranges of lengths with thresholds of their own.
PIECES = (8, 24, 80, 250)
UNIT = 1 << 20
#: Symbols times languages that are looked up at a time, and n-grams times languages that a worker remembers.
HELD = 4_000_000
KNOWN = 4_000_000

_FACTOR = np.uint64(0x9E3779B97F4A7C15)
MODEL_SCHEMA = "lang string, n int, grams binary, share binary, contexts binary, mass binary"


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    """Code point -> its lower-case letter, 0 if it is no letter."""
    return np.array([ord(c.lower()[0]) if c.isalpha() else 0 for c in map(chr, range(0x110000))], dtype=np.uint32)


def fold(text: str | None) -> np.ndarray:
    """The symbols of a text: lower-case letters, and 0 for each run of others behind letters and for the end."""
    points = np.frombuffer((text or "").encode("utf-32-le", "replace"), dtype="<u4")
    symbols = np.append(_letters()[points], np.uint32(0))
    keep = symbols > 0
    keep[1:] |= keep[:-1].copy()
    return symbols[keep]


def chain(symbols: np.ndarray, order: int = ORDER) -> list[np.ndarray]:
    """[hashes of the n-grams that end at each position], n from 0 (all alike) to ``order``."""
    one = symbols.astype(np.uint64) + np.uint64(1)
    out = [np.zeros(len(one), dtype=np.uint64), one]
    for _ in range(order - 1):
        longer = one.copy()
        longer[1:] += out[-1][:-1] * _FACTOR
        out.append(longer)
    return out


def padded(bodies: list[np.ndarray], order: int = ORDER) -> tuple[np.ndarray, np.ndarray]:
    """All symbols in a row, ``order - 1`` spaces before each text, and whether a position belongs to a text."""
    pad, real = np.zeros(order - 1, np.uint32), np.zeros(order - 1, bool)
    symbols = np.concatenate([x for body in bodies for x in (pad, body)])
    return symbols, np.concatenate([x for body in bodies for x in (real, np.ones(len(body), bool))])


def _distinct(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sorted distinct keys, a position of each, and how often each occurs."""
    order = np.argsort(keys)
    new = np.flatnonzero(np.append(True, np.diff(keys[order]) != 0)) if len(keys) else np.empty(0, np.int64)
    return keys[order[new]], order[new], np.diff(np.append(new, len(keys)))


def count_orders(bodies: list[np.ndarray], order: int = ORDER) -> list[tuple[np.ndarray, ...]]:
    """For n from 1 to ``order``: (n-gram hashes, shares, context hashes, masses handed down), hashes sorted."""
    symbols, real = padded(bodies, order)
    hashes = chain(symbols, order)
    at, counts, out = np.flatnonzero(real), None, []
    for n in range(order, 0, -1):
        # Below the highest order, one position of every distinct (n+1)-gram: what precedes an n-gram counts once.
        grams, where, counts = _distinct(hashes[n][at])
        at = at[where]
        before = hashes[n - 1][at - 1]
        contexts, _, types = _distinct(before)
        slot = np.searchsorted(contexts, before)
        total = np.bincount(slot, counts, len(contexts))
        once, twice = np.count_nonzero(counts == 1), np.count_nonzero(counts == 2)
        discount = min(0.95, max(0.05, once / max(1, once + 2 * twice)))
        out.append((grams, np.maximum(counts - discount, 0) / total[slot], contexts, discount * types / total))
    return out[::-1]


@dataclass
class Model:
    languages: list[str]
    orders: list[list[tuple[np.ndarray, ...]]]
    symbols: int
    temperature: float = 1.0
    #: Per language: the largest cross-entropy accepted, by range of lengths.
    limits: np.ndarray | None = None

    def bits(self, hashes: list[np.ndarray], at: np.ndarray) -> np.ndarray:
        """Costs (int32, in 1/UNIT bit) of the n-grams that end at these positions, by language."""
        out = np.empty((len(at), len(self.languages)), dtype=np.int32)
        for k, orders in enumerate(self.orders):
            p = np.full(len(at), 1 / self.symbols)
            for n, (grams, share, contexts, mass) in enumerate(orders, 1):
                handed, known = _look_up(contexts, mass, hashes[n - 1][at - 1])
                seen, _ = _look_up(grams, share, hashes[n][at])
                p = np.where(known, seen + handed * p, p)
            out[:, k] = np.round(-np.log2(p) * UNIT)
        return out

    def limit_of(self, language: np.ndarray, length: np.ndarray) -> np.ndarray:
        return self.limits[language, np.searchsorted(PIECES, length)]


def _look_up(keys: np.ndarray, values: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    found = keys[at] == wanted
    return np.where(found, values[at], 0.0), found


class Costs:
    """Costs of texts under a model; a worker's memory of n-grams that it has met (results do not depend on it)."""

    def __init__(self, model: Model):
        self.model, self.order = model, len(model.orders[0])
        self.slice = max(1 << 14, HELD // len(model.languages))
        self.forget()

    def forget(self) -> None:
        self.keys, self.known = np.empty(0, np.uint64), np.empty((0, len(self.model.languages)), np.int32)

    def of_grams(self, hashes: list[np.ndarray], at: np.ndarray) -> np.ndarray:
        """Costs at these positions, summed up along them: one row more than positions."""
        wanted = hashes[self.order][at]
        distinct, where, _ = _distinct(wanted)
        slot = np.searchsorted(self.keys, distinct)
        new = np.append(self.keys, np.uint64(0))[slot] != distinct
        new |= slot == len(self.keys)
        if new.any():
            if (len(self.keys) + np.count_nonzero(new)) * len(self.model.languages) > KNOWN:
                self.forget()
                new = np.ones(len(distinct), bool)
            keys = np.concatenate([self.keys, distinct[new]])
            known = np.concatenate([self.known, self.model.bits(hashes, at[where[new]])])
            order = np.argsort(keys)
            self.keys, self.known = keys[order], known[order]
            slot = np.searchsorted(self.keys, distinct)
        rows = self.known[slot[np.searchsorted(distinct, wanted)]]
        return np.concatenate([np.zeros((1, rows.shape[1]), np.int64), np.cumsum(rows, axis=0, dtype=np.int64)])

    def of_bodies(self, bodies: list[np.ndarray]) -> np.ndarray:
        """Total cost of each text, by language."""
        symbols, real = padded(bodies, self.order)
        ends = np.cumsum([len(b) for b in bodies])
        total = np.zeros((len(bodies), len(self.model.languages)), np.int64)
        done = 0
        for start in range(0, len(symbols), self.slice):
            first = max(0, start - self.order + 1)
            part = symbols[first : start + self.slice]
            at = np.flatnonzero(real[start : start + self.slice]) + (start - first)
            if len(at):
                summed = self.of_grams(chain(part, self.order), at)
                edges = np.clip(np.append(0, ends) - done, 0, len(at))
                total += summed[edges[1:]] - summed[edges[:-1]]
                done += len(at)
        return total

    def of_texts(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """(symbols, costs by language) of each text; texts without a letter have no symbols."""
        lengths = np.zeros(len(texts), np.int64)
        total = np.zeros((len(texts), len(self.model.languages)), np.int64)
        held, size = [], 0
        for k, text in enumerate(texts):
            body = fold(text)
            lengths[k] = len(body)
            if len(body):
                held.append((k, body))
                size += len(body)
            if held and (size >= self.slice or k == len(texts) - 1):
                total[[j for j, _ in held]] = self.of_bodies([b for _, b in held])
                held, size = [], 0
        if held:
            total[[j for j, _ in held]] = self.of_bodies([b for _, b in held])
        return lengths, total


def sample_rows(docs: DataFrame, rows: int, languages: int) -> DataFrame:
    """(lang, key, text): about ``rows`` distinct documents a language, those of least hash."""
    spark = docs.sparkSession
    labelled = docs.where(F.col("lang").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    labelled = labelled.select(
        F.col("lang").cast("string").alias("lang"), F.col("text").cast("string").alias("text"), F.xxhash64("doc_id", "text").alias("key")
    ).where(F.col("text").rlike(r"\p{L}"))
    sizes = labelled.groupBy("lang").agg(F.approx_count_distinct("key").alias("n")).orderBy(F.desc("n"), "lang").limit(languages).collect()
    cuts = [(r["lang"], min(1 << 20, -(-rows * (1 << 20) // max(1, r["n"])))) for r in sizes]
    cut = F.broadcast(spark.createDataFrame(cuts, "_lang string, _cut long"))  # <= ``languages`` rows
    chosen = labelled.join(cut, F.col("lang") == F.col("_lang")).where(F.pmod("key", F.lit(1 << 20)) < F.col("_cut"))
    return chosen.groupBy("lang", "key").agg(F.first("text").alias("text"))


def _calibrating() -> Column:
    return F.pmod(F.shiftright("key", 20), F.lit(4)) == 0


def _count(symbols: int, order: int):
    def run(table: pa.Table) -> pa.Table:
        rows = sorted(zip(table.column("key").to_pylist(), table.column("text").to_pylist(), strict=True))
        bodies, size = [], 0
        for _, text in rows:
            if size >= symbols:
                break
            bodies.append(fold(text))
            size += len(bodies[-1])
        lang = table.column("lang")[0].as_py()
        out = [(lang, n, *(x.tobytes() for x in arrays)) for n, arrays in enumerate(count_orders([b for b in bodies if len(b)] or [fold("a")], order), 1)]
        columns = list(zip(*out, strict=True))
        types = [pa.string(), pa.int32(), *[pa.binary()] * 4]
        return pa.table([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=["lang", "n", "grams", "share", "contexts", "mass"])

    return run


def _cost_rows(model: Model):
    """Calibration texts, whole and their first letters: (lang, symbols, costs)."""

    def run(batches):
        costs = Costs(model)
        for batch in batches:
            lang, texts = batch.column("lang").to_pylist(), batch.column("text").to_pylist()
            cases = [(g, t[:n] if n else t) for g, t in zip(lang, texts, strict=True) for n in (*PIECES, None) if n is None or len(t) > n]
            lengths, total = costs.of_texts([t for _, t in cases])
            yield pa.RecordBatch.from_arrays(
                [pa.array([g for g, _ in cases]), pa.array(lengths), pa.array(total.tolist(), pa.list_(pa.int64()))], names=["lang", "symbols", "costs"]
            )

    return run


def calibrate(model: Model, lang: np.ndarray, lengths: np.ndarray, costs: np.ndarray, reject: float = REJECT) -> None:
    """Sets the model's temperature and limits from scored texts whose languages are known."""
    own = costs[np.arange(len(lang)), lang] / UNIT
    entropy = own / np.maximum(1, lengths)
    bins = np.searchsorted(PIECES, lengths)
    model.limits = np.full((len(model.languages), len(PIECES) + 1), np.inf)
    for k in range(len(model.languages)):
        for b in range(len(PIECES) + 1):
            mine = entropy[(lang == k) & (bins == b)]
            if len(mine) >= 20:
                model.limits[k, b] = np.quantile(mine, 1 - reject)
    nats = (costs - costs.min(axis=1, keepdims=True)) / UNIT * np.log(2)

    def loss(t: float) -> float:
        scaled = nats / t
        return float(np.mean(scaled[np.arange(len(lang)), lang] + np.log(np.exp(-scaled).sum(axis=1))))

    model.temperature = min((float(t) for t in np.geomspace(1, 100, 60)), key=loss) if len(lang) else 1.0


def train(
    docs: DataFrame,
    rows: int = SAMPLE_ROWS,
    symbols: int = SAMPLE_SYMBOLS,
    languages: int = LANGUAGES,
    order: int = ORDER,
    reject: float = REJECT,
) -> Model | None:
    """A calibrated model from a bounded sample of labelled documents (None without any)."""
    prepare(docs.sparkSession)
    sample = stored(sample_rows(docs, rows, languages), "langid-sample")
    known = sample.groupBy("lang").agg(F.count_if(~_calibrating()).alias("n")).collect()  # <= ``languages`` rows
    if not known:
        return None
    few = [r["lang"] for r in known if not r["n"]]
    counted = sample.where(~_calibrating() | F.col("lang").isin(few)).groupBy("lang").applyInArrow(_count(symbols // len(known), order), MODEL_SCHEMA).collect()
    arrays: dict[str, dict[int, tuple]] = {}
    for r in counted:
        kinds = ((r["grams"], "<u8"), (r["share"], "<f8"), (r["contexts"], "<u8"), (r["mass"], "<f8"))
        arrays.setdefault(r["lang"], {})[r["n"]] = tuple(np.frombuffer(x, t) for x, t in kinds)
    fitted = sorted(arrays)
    orders = [[arrays[g][n] for n in range(1, order + 1)] for g in fitted]
    distinct = len(np.unique(np.concatenate([o[0][0] for o in orders])))
    model = Model(fitted, orders, distinct + 1)
    held = sample.where(_calibrating()).mapInArrow(_cost_rows(model), "lang string, symbols long, costs array<long>")
    scored = sorted((fitted.index(r["lang"]), r["symbols"], r["costs"]) for r in held.collect() if r["symbols"])  # <= 5 rows a sampled text
    lang, lengths = (np.array([r[k] for r in scored], dtype=np.int64) for k in (0, 1))
    calibrate(model, lang, lengths, np.array([r[2] for r in scored], dtype=np.int64).reshape(-1, len(fitted)), reject)
    return model


def identify(docs: DataFrame, model: Model | None) -> DataFrame:
    """Per document: doc_id, lang_pred, score, cross_entropy (bits per symbol; null if undetermined), rejected."""
    spark = prepare(docs.sparkSession)
    shared = spark.sparkContext.broadcast(model)

    def run(batches):
        fitted = shared.value
        costs = Costs(fitted) if fitted else None
        for batch in batches:
            texts, size = batch.column(1).to_pylist(), batch.num_rows
            lang, score, entropy, rejected = np.full(size, UNDETERMINED, dtype=object), np.zeros(size), np.full(size, np.nan), np.ones(size, bool)
            if costs and size:
                lengths, total = costs.of_texts(texts)
                some = np.flatnonzero(lengths)
                best = total[some].argmin(axis=1)
                least = total[some, best]
                lang[some] = np.array(fitted.languages, dtype=object)[best]
                nats = (total[some] - least[:, None]) / UNIT * np.log(2)
                score[some] = 1 / np.exp(-nats / fitted.temperature).sum(axis=1)
                entropy[some] = least / UNIT / lengths[some]
                rejected[some] = entropy[some] > fitted.limit_of(best, lengths[some])
            out = [batch.column(0), pa.array(lang, pa.string()), pa.array(score), pa.array(entropy, mask=np.isnan(entropy)), pa.array(rejected)]
            yield pa.RecordBatch.from_arrays(out, names=["doc_id", "lang_pred", "score", "cross_entropy", "rejected"])

    slim = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return slim.mapInArrow(run, "doc_id long, lang_pred string, score double, cross_entropy double, rejected boolean")
