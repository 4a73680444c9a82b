"""The pipeline: every stage against its own input, and all of it against brute force."""

import re
import zlib
from collections import Counter

import numpy as np
import pytest
import xxhash
from brute_mixing import brute_copies

import __spark_entry__ as entry
import corpus_pipeline as cp
from gridmart.llm import quality_rules
from gridmart.llm.common import stored

ORDER = ["quality_rules", "simhash_near_dedup", "substring_dedup", "mixing", "packing"]


@pytest.fixture(scope="module")
def runs(spark):
    """Input and output of every stage, written and read again."""
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    out = {}
    for name, stage in cp.STAGES:
        after = stored(stage(spark, docs, "/root/testdata/sf0.001"), f"test-{name}")
        out[name] = (docs, after)
        docs = after
    return out


def test_stages_in_order_and_columns(runs):
    assert [name for name, _ in cp.STAGES] == ORDER
    columns = ["doc_id", "text", "lang", "source", "n_chars"]
    for name in ORDER[:-1]:
        assert runs[name][1].columns == columns
    assert runs["packing"][1].columns[-2:] == ["sequence_id", "offset"]


def rows(df):
    return {r.doc_id: r for r in df.collect()}


def test_quality_stage(runs):
    before, after = runs["quality_rules"]
    kept = {r.doc_id for r in quality_rules.apply_rules(before).where("kept").collect()}
    assert set(rows(after)) == kept and all(r == rows(before)[i] for i, r in rows(after).items())


def prints(docs):
    out = {}
    for i, r in docs.items():
        words = r.text.encode().lower().split()
        grams = [b" ".join(words[k : k + 4]) for k in range(max(1, len(words) - 3))]
        hashes = [xxhash.xxh64_intdigest(g, 42) for g in grams]
        out[i] = sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes)) if words else 0
    return out


def test_simhash_stage(runs):
    before, after = map(rows, runs["simhash_near_dedup"])
    ids = sorted(before)
    fps = prints(before)
    values = np.array([fps[i] for i in ids], dtype=np.uint64)
    near = np.bitwise_count(values[:, None] ^ values[None, :]) <= 4
    label = np.arange(len(ids))
    for _ in ids:
        label = np.array([label[near[k]].min() for k in range(len(ids))])
    assert set(after) == {ids[k] for k in set(label.tolist())}
    assert all(after[i] == before[i] for i in after)


def test_substring_stage(runs):
    before, after = map(rows, runs["substring_dedup"])
    seen = set()
    assert set(before) == set(after)
    for i in sorted(before):
        words = re.findall(r"[^\x20\x09-\x0D]+", before[i].text)
        gone = [False] * len(words)
        for k in range(len(words) - 19):
            key = tuple(words[k : k + 20])
            if key in seen:
                gone[k : k + 20] = [True] * 20
            seen.add(key)
        want = " ".join(w for w, g in zip(words, gone, strict=True) if not g) if any(gone) else before[i].text
        assert after[i].text == want and after[i].n_chars == len(want)


def test_mixing_stage(runs):
    before, after = runs["mixing"]
    docs = before.collect()
    want = Counter()
    for (_, doc_id, _), n in brute_copies([(r.doc_id, r.text, r.source) for r in docs]).items():
        want[doc_id] += n
    assert Counter(r.doc_id for r in after.collect()) == Counter({i: n for i, n in want.items() if n})


def test_packing_stage(runs):
    before, after = runs["packing"]
    copies = Counter(r.doc_id for r in before.collect())
    pieces = after.collect()
    first = Counter(r.doc_id for r in pieces if r.start == 0)
    assert first == copies
    for r in pieces:
        assert r.length == min(4096, r.doc_tokens - r.start)
    by = {}
    for r in pieces:
        by.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for spans in by.values():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at
            at += length
        assert at <= 4096


def test_run_equals_the_stages(spark, runs):
    got = cp.run(spark, "/root/testdata/sf0.001")
    key = lambda df: Counter((r.doc_id, r.start, r.length, r.ids_crc32) for r in df.collect())
    assert key(got) == key(runs["packing"][1])
    assert entry.queries()["pipeline"] is cp.run and "pipeline" not in entry.oracle_sql()


def test_odd_rows_clashing_columns_and_empty_table(spark, make_docs, odd_rows, clashing):
    long = "the cat and the dog sat on a mat by the old oak tree while rain fell on the roof of the house in spring"
    odd = clashing(make_docs([*odd_rows, (40, long), (41, long), (41, long), (42, long + " once more")]))
    for docs in (odd, make_docs([])):
        for _, stage in cp.STAGES:
            docs = stored(stage(spark, docs, ""), "test-odd")
        ids = {r.doc_id for r in docs.collect()}
        assert ids <= {40, 42}


def test_every_numbered_query_is_registered():
    names = [k for k in entry.queries() if re.match(r"op\d+_", k)]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14))


def test_packed_sequences_hold_the_tokens_of_the_mixed_corpus(runs):
    from gridmart.llm import packing

    before, after = runs["packing"]
    encode = packing._encoder(packing.VOCABULARY).encode
    end = np.asarray([packing.END_ID], dtype="<u4").tobytes()
    want = Counter((r.doc_id, encode(r.text or "") + end) for r in before.collect())
    pieces = {}
    for r in after.collect():
        assert len(r.ids) == 4 * r.length and zlib.crc32(r.ids) == r.ids_crc32
        pieces.setdefault((r.doc_id, r.start), []).append(bytes(r.ids))
    got = Counter()
    for (i, start), copies in pieces.items():
        if not start:
            rest = b"".join(pieces[i, at][0] for at in sorted(at for j, at in pieces if j == i and at))
            got.update((i, one + rest) for one in copies)
    assert got == want
    joined = packing.sequences(after).collect()
    assert sum(r.n_tokens for r in joined) == sum(len(t) // 4 * n for (_, t), n in want.items())
    assert all(len(r.ids) == 4 * r.n_tokens <= 4 * packing.CAPACITY for r in joined)
