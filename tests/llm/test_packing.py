import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from gridmart.llm import packing as P


@pytest.fixture(scope="module")
def tokenizer():
    import public_tokenizers
    from tokenizers import Tokenizer

    return Tokenizer.from_file(public_tokenizers.path(P.VOCABULARY))


def ids_of(tokenizer, text):
    return [*tokenizer.encode(text or "", add_special_tokens=False).ids, P.END_ID]


ODD_TEXTS = [
    "", "<|endoftext|> a <|startoftext|>", "Don't STOP's it's we'll '", "naïve éa ﬁ ǅ ß İstanbul ΣΑΣ σς", "a b c x²y 3½ 12345 1a2b",
    "#$%& a,b.c!! 'tis", "日本語テキスト русский ТЕКСТ", "\x1c\x1d a\x1eb \x85 z\x0b\x0cq", "a'''s b's. c'S", "été e ́", "  İ! İ, ẞ.",
]


def test_ids_by_words_equal_ids_of_whole_texts(tokenizer):
    rng = random.Random(3)
    letters = "aAbB,. '<>|#éÉẞß１Ⅷǆ̧́ΣσIİ \x1f\x85日"
    texts = ODD_TEXTS + ["".join(rng.choice(letters) for _ in range(50)) for _ in range(400)]
    encoder = P._encoder(P.VOCABULARY)
    for text in texts:
        assert np.frombuffer(encoder.encode(text), "<u4").tolist() == ids_of(tokenizer, text)[:-1], ascii(text)


def test_forgetting_words_changes_nothing(tokenizer, monkeypatch):
    monkeypatch.setattr(P, "CACHE_WORDS", 3)
    encoder = P.Words(tokenizer)
    for text in ["one two three four five", "five six one seven", "eight one nine ten"] * 3:
        assert np.frombuffer(encoder.encode(text), "<u4").tolist() == ids_of(tokenizer, text)[:-1]


def unroll(packs):
    out = []
    for pattern, count in packs:
        lengths = []
        while pattern is not None:
            length, times, pattern = pattern
            lengths += [length] * times
        out += [lengths] * count
    return out


def one_by_one(histogram, capacity):
    """Each piece, longest first, on the shortest pack that has room."""
    packs = []
    for length in sorted(histogram, reverse=True):
        for _ in range(histogram[length]):
            fits = [p for p in packs if sum(p) + length <= capacity]
            if fits:
                min(fits, key=sum).append(length)
            else:
                packs.append([length])
    return packs


def test_histogram_packing_equals_packing_one_by_one():
    rng = random.Random(5)
    for _ in range(200):
        capacity = rng.choice([8, 16, 31])
        histogram = {n: rng.choice([1, 2, 3, 20]) for n in rng.sample(range(1, capacity + 1), rng.randint(1, capacity))}
        got, want = unroll(P.pack_histogram(histogram, capacity)), one_by_one(histogram, capacity)
        assert sorted(x for p in got for x in p) == sorted(n for n, c in histogram.items() for _ in range(c))
        assert all(sum(p) <= capacity for p in got)
        assert sorted(map(sum, got)) == sorted(map(sum, want))


def test_work_depends_on_lengths_not_on_counts():
    packs = P.pack_histogram({n: 10**9 for n in (4096, 3000, 1500, 700, 90, 1)})
    assert len(packs) < 100 and sum(c for _, c in packs) < 10**10


def check(rows, tokenizer, texts, capacity):
    by_doc, by_sequence = {}, {}
    for r in rows:
        by_doc.setdefault(r.doc_id, []).append(r)
        by_sequence.setdefault(r.sequence_id, []).append(r)
    for doc_id, text in texts.items():
        ids = ids_of(tokenizer, text)
        at = 0
        for r in sorted(by_doc[doc_id], key=lambda r: r.start):
            piece = np.array(ids[at : at + r.length], "<u4").tobytes()
            assert (r.start, r.doc_tokens, r.ids_crc32) == (at, len(ids), zlib.crc32(piece))
            at += r.length
        assert at == len(ids)
    for pieces in by_sequence.values():
        at = 0
        for r in sorted(pieces, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= capacity
    return len(by_sequence)


def test_pieces_tile_documents_and_sequences(documents, tokenizer):
    texts = {r.doc_id: r.text for r in documents.collect()}
    for capacity in (4096, 64):
        rows = P.pack(documents, capacity=capacity).collect()
        n = check(rows, tokenizer, texts, capacity)
        assert {r.sequence_id for r in rows} == set(range(n))
        assert sum(r.length for r in rows) > 0.97 * n * capacity


def test_sequences_hold_the_ids(documents, tokenizer):
    packed = P.pack(documents.limit(40), capacity=512, keep_ids=True)
    joined = {r.sequence_id: r for r in P.sequences(packed).collect()}
    for r in packed.collect():
        own = np.frombuffer(bytes(joined[r.sequence_id].ids), "<u4")[r.offset : r.offset + r.length]
        assert zlib.crc32(own.tobytes()) == r.ids_crc32


def test_odd_rows_and_empty_table(odd_rows, make_docs, clashing, tokenizer):
    rows = P.pack(clashing(make_docs(odd_rows))).collect()
    assert sum(r.doc_id == 9 for r in rows) == 2 and sum(r.doc_id is None for r in rows) == 1
    assert {r.length for r in rows if r.doc_id in (1, 2, 3)} == {1}
    assert sum(r.length for r in rows if r.doc_id == 7) == 30001
    assert len({(r.sequence_id, r.offset) for r in rows}) == len(rows)
    assert P.pack(make_docs([])).count() == 0


def test_a_length_that_most_pieces_share(make_docs):
    docs = make_docs([(i, "same text" if i % 3 else f"other text {i}") for i in range(600)])
    rows = P.pack(docs, capacity=16).collect()
    assert len({(r.sequence_id, r.offset) for r in rows}) == 600
    assert P.pack(docs, capacity=16).agg(F.max(F.col("offset") + F.col("length"))).first()[0] <= 16
