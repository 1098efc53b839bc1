import zlib
from collections import Counter

import pytest

from cohortlens.llm.sharding import Permutation, locate, shard_documents


@pytest.mark.parametrize("n", [1, 2, 3, 5, 24, 97, 1000, 4097])
def test_permutation_is_one_to_one_and_walks_are_bounded(n):
    p = Permutation(n, 7)
    assert sorted(p.place(x) for x in range(n)) == list(range(n))
    a, b = p.bases
    assert a * b >= n and (b == 1 or a * (b - 1) < n)

    def steps(x):
        k, y = 1, p.once(x)
        while y >= n:
            k, y = k + 1, p.once(y)
        return k

    assert max(map(steps, range(n))) <= p.walks()


def test_shards_are_even_gapless_and_computable(spark, docs_of):
    docs = docs_of([(i * 3, f"text {i}") for i in range(1000)])
    rows = shard_documents(docs, shards=24, seed=20).collect()
    sizes = Counter(r["shard"] for r in rows)
    assert max(sizes.values()) - min(sizes.values()) <= 1 and set(sizes) == set(range(24))
    for s in range(24):
        assert sorted(r["slot"] for r in rows if r["shard"] == s) == list(range(sizes[s]))
    by_id = sorted(rows, key=lambda r: r["doc_id"])
    assert [r["row_number"] for r in by_id] == list(range(1000))
    assert all((r["shard"], r["slot"]) == locate(r["row_number"], 1000, 24, 20) for r in rows)
    assert all(r["text_crc32"] == zlib.crc32(f"text {r['doc_id'] // 3}".encode()) for r in rows)
    again = shard_documents(docs.repartition(5), shards=24, seed=20).collect()
    assert {r["doc_id"]: r["shard"] for r in again} == {r["doc_id"]: r["shard"] for r in rows}


def test_odd_rows(spark, docs_of, odd_rows):
    rows = shard_documents(docs_of(odd_rows), shards=4).collect()
    assert len(rows) == len(odd_rows)
    assert sorted(r["row_number"] for r in rows) == list(range(len(odd_rows)))
    assert sorted(r["size"] for r in rows) == sorted(len((t or "").encode()) + 8 for _, t in odd_rows)
    assert shard_documents(docs_of([])).count() == 0
