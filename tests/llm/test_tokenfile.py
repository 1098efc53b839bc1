import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from cohortlens.llm.queries import TOKENIZER
from cohortlens.llm.tokenfile import Encoder, PerfectHash, fetch, read_tokens, write_tokens
from cohortlens.session import new_table_path


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(TOKENIZER)


HARD = ["# <|endoftext|> a#.", "it's. don't, we'll!", "é café.", "İstanbul, ΑΣ. ß", "x y z", "a\x1fb\x1c", "..., ,. 3.14,15.", "\r\n\t", "<|startoftext|>.", "ª º.", "ab" * 3000 + "."]


def test_chunks_encode_like_whole_texts(tokenizer, prose):
    texts = [*HARD, prose(1, 3000), " ".join(HARD)]
    got = [np.frombuffer(b, "<u2").tolist() for b in Encoder(TOKENIZER).encode([t.encode() for t in texts])]
    assert got == [tokenizer.encode(t, add_special_tokens=False).ids for t in texts]


def test_perfect_hash_is_minimal():
    ids = np.arange(50_000, dtype=np.int64) * 977 - 5
    none, zero = np.zeros(len(ids), bool), np.zeros(len(ids), np.int64)
    index = PerfectHash.build(ids, none, zero)
    assert sorted(index.slots(ids, none, zero).tolist()) == list(range(len(ids)))


def test_keys_that_once_hashed_alike_are_told_apart():
    ids, copies = np.array([7, 7 + 0x51ED270B], np.int64), np.array([1, 0], np.int64)
    none = np.zeros(2, bool)
    index = PerfectHash.build(ids, none, copies)
    assert sorted(index.slots(ids, none, copies).tolist()) == [0, 1]
    with pytest.raises(ValueError):
        PerfectHash.build(np.array([1, 1]), none, np.array([0, 0]))


def test_rows_of_one_id_are_spread_over_files(spark, docs_of, prose, tokenizer):
    rows = [(5, prose(i, 30)) for i in range(300)] + [(i, prose(i, 20)) for i in range(100, 160)] + [(None, prose(i, 25)) for i in range(300)]
    path = new_table_path(spark, "tokens-test")
    write_tokens(docs_of(rows), TOKENIZER, path)
    got = read_tokens(spark, path).collect()
    assert len({r["shard"] for r in got if r["doc_id"] == 5}) > 1 and len({r["shard"] for r in got if r["doc_id"] is None}) > 1
    assert sorted(r["copy"] for r in got if r["doc_id"] == 5) == list(range(300))
    assert sorted(r["copy"] for r in got if r["doc_id"] is None) == list(range(300))
    keys = spark.createDataFrame([(d, c) for d in (5, None) for c in range(301)] + [(100, 0), (1, 0)], "doc_id long, copy long")
    found = {(r["doc_id"], r["copy"]): r["ids"] for r in fetch(spark, path, keys).collect()}
    assert len(found) == 604 and found[5, 300] is None and found[None, 300] is None and found[1, 0] is None and found[100, 0]
    for d in (5, None):
        want = sorted([*tokenizer.encode(t, add_special_tokens=False).ids, 2] for i, t in rows if i == d)
        assert sorted(found[d, c] for c in range(300)) == want


def test_round_trip_and_keyed_access(spark, docs_of, odd_rows, tokenizer):
    rows = [*odd_rows, *[(100 + i, t) for i, t in enumerate(HARD)]]
    path = new_table_path(spark, "tokens-test")
    write_tokens(docs_of(rows), TOKENIZER, path)
    got = read_tokens(spark, path).collect()
    assert len(got) == len(rows)
    coded = lambda t: [*tokenizer.encode(t or "", add_special_tokens=False).ids, 2]
    want = {}
    for d, t in rows:
        ids = coded(t)
        want.setdefault(d, []).append((len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
    have = {}
    for r in got:
        have.setdefault(r["doc_id"], []).append((r["n_tokens"], r["ids_crc32"]))
    assert {k: sorted(v) for k, v in have.items()} == {k: sorted(v) for k, v in want.items()}
    order = sorted(got, key=lambda r: r["start"])
    assert [r["start"] for r in order] == np.cumsum([0, *[r["n_tokens"] for r in order[:-1]]]).tolist()
    ids = [r["doc_id"] for r in order if r["doc_id"] is not None]
    assert ids == sorted(ids) and order[0]["doc_id"] is None
    keys = spark.createDataFrame([(4, 0), (7, 0), (9, 0), (9, 1), (9, 2), (9, 3), (50, 0), (105, 0)], "doc_id long, copy long")
    found = {(r["doc_id"], r["copy"]): r["ids"] for r in fetch(spark, path, keys).collect()}
    assert found[4, 0] == coded("one") and found[7, 0] == coded(odd_rows[6][1]) and found[105, 0] == coded(HARD[5])
    assert found[9, 3] is None and found[50, 0] is None
    assert sorted([found[9, 0], found[9, 1], found[9, 2]]) == sorted(coded(t) for d, t in odd_rows if d == 9)


def test_empty_table(spark, docs_of):
    path = new_table_path(spark, "tokens-test")
    write_tokens(docs_of([]), TOKENIZER, path)
    assert read_tokens(spark, path).count() == 0
