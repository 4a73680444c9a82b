"""Quality classifier: attention-based multiple-instance learning.

A document is a bag of passages of 64 words. Every passage is encoded (means of per-word style
measures, repetition measures, then a learned tanh layer), a gated attention learned from the
documents' labels weighs the passages, and the weighted representation is scored:

    h_k = tanh(W x_k + b),  a = softmax_k(w . (tanh(V h_k) * sigmoid(U h_k))),  score = sigmoid(c . sum a_k h_k + c0)

Fit: a bounded sample of labelled documents (``SAMPLE`` ids, least hash first, and one document of an
id; parameter ``sample``) is encoded on the executors, and its passage vectors come to the driver, where
the few hundred weights are fitted: at most ``BAG`` passages a document (parameter ``bag``), evenly
spaced over a longer one, so at most ``sample * bag`` vectors. Scoring: one narrow pass over all
documents and all their passages, weights shipped with the tasks. Whole texts are read on both sides.

Defined cases: a null or empty text is one passage of zeros and gets a score too; rows with a null
label are not learned from, repeated label rows count once (the highest label); of documents with one
id the one of least text hash is learned from; without any label every score is 0.5; a
null doc_id is scored and counts as held out; an empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridmart.llm.common import prepare
from gridmart.llm.quality_rules import STOP_WORDS

PASSAGE = 64
SAMPLE = 6000
BAG = 256
HIDDEN = 16
ATTENTION = 8
EPOCHS = 250
SEED = 11
#: Words whose measures a worker remembers before it starts anew (results do not depend on it).
CACHE_WORDS = 150_000

_STOP = frozenset(w.encode() for w in STOP_WORDS)
_SYMBOLS = frozenset(b"#*$%&|<>")
N_WORD = 12
N_FEATURES = N_WORD + 6


def _measure(word: bytes) -> tuple:
    text = word.decode("utf-8", "replace")
    n = max(1, len(text))
    letters = sum(c.isalpha() for c in text)
    upper = sum(c.isupper() for c in text)
    return (
        min(len(text), 40) / 10, letters / n, float(letters > 1 and upper == letters), upper / n, sum(c.isdigit() for c in text) / n,
        min(4, sum(c in _SYMBOLS for c in word)) / 4, min(4, word.count(b"!") + word.count(b"?")) / 4, float(letters == 0),
        float(word[-1:] in (b".", b"!", b"?")), float(word[-1:] == b","), float(word.lower() in _STOP), float(len(text) > 20),
    )


class Vocabulary(dict):
    """Word -> row of a growing matrix of word measures."""

    def __init__(self):
        super().__init__()
        self.rows = np.zeros((1 << 12, N_WORD), dtype=np.float32)

    def __missing__(self, word: bytes) -> int:
        at = self[word] = len(self)
        if at >= len(self.rows):
            self.rows = np.concatenate([self.rows, np.zeros_like(self.rows)])
        self.rows[at] = _measure(word)
        return at


def passages(text: str | None, vocabulary: Vocabulary) -> np.ndarray:
    """One row of N_FEATURES per passage of PASSAGE words (at least one row)."""
    words = (text or "").encode("utf-8", "replace").split()
    if not words:
        return np.zeros((1, N_FEATURES), dtype=np.float32)
    if len(vocabulary) > CACHE_WORDS:
        vocabulary.clear()
    ids = np.fromiter(map(vocabulary.__getitem__, words), dtype=np.int64, count=len(words))
    starts = np.arange(0, len(ids), PASSAGE)
    sizes = np.diff(np.concatenate([starts, [len(ids)]])).astype(np.float32)
    out = np.empty((len(starts), N_FEATURES), dtype=np.float32)
    out[:, :N_WORD] = np.add.reduceat(vocabulary.rows[ids], starts, axis=0) / sizes[:, None]
    same = np.zeros(len(ids), dtype=np.float32)
    same[1:] = ids[1:] == ids[:-1]
    out[:, N_WORD] = np.add.reduceat(same, starts) / sizes
    # Words whose pair with the next word, or whose run of four, came earlier in the document.
    for k, width in enumerate((2, 4)):
        again = np.zeros(len(ids), dtype=np.float32)
        if len(ids) > width:
            keys = np.zeros(len(ids) - width + 1, dtype=np.uint64)
            for j in range(width):
                keys = keys * np.uint64(0x9E3779B97F4A7C15) + ids[j : len(ids) - width + 1 + j].astype(np.uint64) + np.uint64(1)
            first = np.unique(keys, return_index=True)[1]
            again[: len(keys)] = 1
            again[first] = 0
        out[:, N_WORD + 1 + k] = np.add.reduceat(again, starts) / sizes
    filled = np.full(len(starts) * PASSAGE, -1, dtype=np.int64)
    filled[: len(ids)] = ids
    rows = np.sort(filled.reshape(-1, PASSAGE), axis=1)
    distinct = (np.diff(rows, axis=1) != 0).sum(axis=1) + 1 - (rows[:, 0] < 0)
    out[:, N_WORD + 3] = distinct / sizes
    out[:, N_WORD + 4] = sizes / PASSAGE
    out[:, N_WORD + 5] = np.log1p(len(ids)) / 10
    return out


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def forward(model: dict, x: np.ndarray, starts: np.ndarray) -> tuple:
    """Scores of the bags that begin at ``starts``, and what the gradient needs."""
    x = (x - model["mean"]) / model["std"]
    h = np.tanh(x @ model["W"] + model["b"])
    t, g = np.tanh(h @ model["V"]), _sigmoid(h @ model["U"])
    e = (t * g) @ model["w"]
    sizes = np.diff(np.concatenate([starts, [len(x)]]))
    e = np.exp(e - np.repeat(np.maximum.reduceat(e, starts), sizes))
    a = e / np.repeat(np.add.reduceat(e, starts), sizes)
    z = np.add.reduceat(a[:, None] * h, starts, axis=0)
    return _sigmoid(z @ model["c"] + model["c0"]), (x, h, t, g, a, z, sizes)


def fit(x: np.ndarray, starts: np.ndarray, y: np.ndarray, epochs: int = EPOCHS, seed: int = SEED) -> dict:
    """Adam on the mean cross-entropy of the bags, all bags in every step."""
    rng = np.random.default_rng(seed)
    d = x.shape[1]
    scale = lambda *shape: rng.normal(0, 1 / np.sqrt(shape[0]), shape)
    model = {
        "W": scale(d, HIDDEN), "b": np.zeros(HIDDEN), "V": scale(HIDDEN, ATTENTION), "U": scale(HIDDEN, ATTENTION),
        "w": scale(ATTENTION), "c": scale(HIDDEN), "c0": np.zeros(1), "mean": x.mean(axis=0), "std": x.std(axis=0) + 1e-3,
    }
    weights = [k for k in model if k not in ("mean", "std")]
    first, second = ({k: np.zeros_like(model[k]) for k in weights} for _ in range(2))
    for step in range(1, epochs + 1):
        p, (xs, h, t, g, a, z, sizes) = forward(model, x, starts)
        dz = (p - y) / len(y)
        grad = {"c": z.T @ dz, "c0": np.array([dz.sum()])}
        bag = np.repeat(np.arange(len(starts)), sizes)
        back = dz[bag, None] * model["c"]
        da = (back * h).sum(axis=1)
        de = a * (da - np.repeat(np.add.reduceat(a * da, starts), sizes))
        dh = a[:, None] * back
        grad["w"] = (t * g).T @ de
        dt, dg = (de[:, None] * model["w"] * g * (1 - t * t)), (de[:, None] * model["w"] * t * g * (1 - g))
        grad["V"], grad["U"] = h.T @ dt, h.T @ dg
        dh += dt @ model["V"].T + dg @ model["U"].T
        dx = dh * (1 - h * h)
        grad["W"], grad["b"] = xs.T @ dx, dx.sum(axis=0)
        for k in weights:
            full = grad[k] + 1e-5 * model[k]
            first[k] = 0.9 * first[k] + 0.1 * full
            second[k] = 0.999 * second[k] + 0.001 * full * full
            model[k] = model[k] - 0.03 * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.999**step)) + 1e-8)
    return model


def _encode(bag: int):
    def run(batches):
        vocabulary = Vocabulary()
        for batch in batches:
            rows = []
            for text in batch.column(1):
                x = passages(text.as_py(), vocabulary)
                if len(x) > bag:
                    x = x[np.arange(bag) * len(x) // bag]
                rows.append(x.astype("<f4").tobytes())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(rows, pa.binary())], names=["label", "passages"])

    return run


def held_out(doc_id: Column, folds: int = 5) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % folds == 0


def train(docs: DataFrame, labels: DataFrame, label: str = "quality", sample: int = SAMPLE, bag: int = BAG) -> dict | None:
    """A model from at most ``sample`` labelled documents outside the held-out fold, ``bag`` passages of each (None without labels)."""
    prepare(docs.sparkSession)
    known = labels.where(F.col(label).isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    known = known.groupBy("doc_id").agg(F.max(label).cast("int").alias("_label"))
    chosen = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample).select(F.col("doc_id").alias("_id"), "_label")
    named = docs.select(F.col("doc_id"), F.col("text").cast("string").alias("text"))
    rows = named.join(F.broadcast(chosen), F.col("doc_id") == F.col("_id"))
    # One document of an id, kept on the map side: repeated ids send one text a task.
    rows = rows.groupBy("_id").agg(F.first("_label").alias("_label"), F.min(F.struct(F.xxhash64("text").alias("h"), "text")).alias("_least"))
    rows = rows.select("_label", F.col("_least.text").alias("text"))
    got = rows.mapInArrow(_encode(bag), "label int, passages binary").collect()
    if not got:
        return None
    got.sort(key=lambda r: (r["label"], bytes(r["passages"])))  # rows come in any order
    bags = [np.frombuffer(r["passages"], "<f4").reshape(-1, N_FEATURES) for r in got]
    starts = np.cumsum([0, *map(len, bags[:-1])])
    return fit(np.concatenate(bags).astype(np.float64), starts, np.array([float(r["label"]) for r in got]))


def score(docs: DataFrame, model: dict | None) -> DataFrame:
    """Per document: doc_id, score."""
    prepare(docs.sparkSession)

    def run(batches):
        vocabulary = Vocabulary()
        for batch in batches:
            scores = []
            for text in batch.column(1):
                x = passages(text.as_py(), vocabulary)
                scores.append(float(forward(model, x, np.zeros(1, dtype=np.int64))[0][0]) if model else 0.5)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores, pa.float64())], names=["doc_id", "score"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, "doc_id long, score double")
