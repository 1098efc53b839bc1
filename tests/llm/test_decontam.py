import random

from cohortlens.llm import decontam
from cohortlens.llm.decontam import contained_items, signature_size, without_contaminated


def shingles(text):
    w = (text or "").encode().lower().split()
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} or ({tuple(w)} if w else set())


def brute(docs, items):
    best = {}
    for d, t in docs:
        have = shingles(t)
        for i, u in items:
            need = shingles(u)
            n = len(have & need)
            if need and 100 * n >= 80 * len(need):
                best[d, i] = max(best.get((d, i), (0, 0)), (n, len(need)))
    return {(d, i, n, q) for (d, i), (n, q) in best.items()}


def items_of(spark, rows):
    return spark.createDataFrame(rows, "item_id long, text string")


def found(docs, items):
    return {(r["doc_id"], r["item_id"], r["n_shared"], r["n_shingles"]) for r in contained_items(docs, items).collect()}


def test_signature_loses_nothing():
    for q in range(1, 400):
        assert signature_size(q) >= q - -(-80 * q // 100) + 1


def test_same_as_brute_force(spark, docs_of, prose, odd_rows):
    rng = random.Random(4)
    items = [(i, prose(1000 + i, 8 + 5 * i % 90)) for i in range(40)]
    rows = []
    for i in range(200):
        text = prose(i, 300).split()
        if i % 3 == 0:  # an item, whole, cut, edited, or scattered in two halves
            w = items[i % 40][1].split()
            w = w[: len(w) - rng.randint(0, len(w) // 3)]
            if i % 2:
                w[rng.randrange(len(w))] = "edited"
            at, half = rng.randrange(len(text)), len(w) // 2
            text = [*text[:at], *w[:half], *(["gap"] * (i % 4 == 0)), *w[half:], *text[at:]]
        rows.append((i, " ".join(text).upper() if i % 5 == 0 else " ".join(text)))
    rows += [(1000 + (d or 0) if d is not None else None, t) for d, t in odd_rows]
    items += [(100, odd_rows[8][1]), (101, None), (102, ""), (103, "one"), (104, items[0][1]), (None, items[1][1])]
    got = found(docs_of(rows), items_of(spark, items))
    assert got == brute(rows, items) and len(got) > 20


def test_filter_and_empty_tables(spark, docs_of, prose):
    items = [(1, prose(1, 40))]
    rows = [(1, prose(5, 50) + " " + prose(1, 40)), (2, prose(6, 50)), (None, prose(1, 40)), (3, None)]
    docs = docs_of(rows)
    kept = without_contaminated(docs, items_of(spark, items))
    assert kept.columns == docs.columns and sorted(r["doc_id"] for r in kept.collect()) == [2, 3]
    assert contained_items(docs_of([]), items_of(spark, items)).count() == 0
    assert contained_items(docs, items_of(spark, [])).count() == 0


def test_signature_finds_fewer_candidates_than_shared_phrases(spark, docs_of, prose):
    """Items with a stock phrase: documents that have only the phrase are seldom candidates."""
    phrase = prose(900, 8)
    items = [(i, f"{phrase} {prose(910 + i, 120)}") for i in range(20)]
    rows = [(i, f"{prose(i, 60)} {phrase} {prose(i + 300, 20)}") for i in range(100)] + [(500 + i, t) for i, t in items]
    inside = decontam.item_shingles(spark.createDataFrame(items, "item_id long, text string")).distinct().persist()
    hits = decontam.hits_of(docs_of(rows), decontam.bit_table(inside.select("key").distinct())).persist()
    found = {(r["doc_id"], r["item_id"]) for r in decontam.candidates(hits, inside).collect()}
    sharing = {(r["doc_id"], r["item_id"]) for r in hits.join(inside, "key").select("doc_id", "item_id").distinct().collect()}
    assert {(500 + i, i) for i in range(20)} <= found < sharing and len(found) < 0.9 * len(sharing)
    got = {(r["doc_id"], r["item_id"]) for r in decontam.contained_items(docs_of(rows), spark.createDataFrame(items, "item_id long, text string")).collect()}
    assert got == {(500 + i, i) for i in range(20)}
