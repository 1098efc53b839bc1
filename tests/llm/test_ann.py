import math

import numpy as np
from pyspark.sql import functions as F

from cohortlens.llm import ann

SCHEMA = "vec_id long, embedding array<double>, label int, v int, part string, chunk int"


def frame(spark, rows):
    return spark.createDataFrame([(i, e, 0, 1, "p", 2) for i, e in rows], SCHEMA)


def brute(rows, k, is_query):
    good = {}
    for i, e in rows:
        if i is not None and e and len(e) == len(rows[0][1]) and all(x is not None and math.isfinite(x) for x in e) and any(e):
            good.setdefault((i, tuple(e)))
    out = {}
    ids = [g[0] for g in good]
    x = np.array([g[1] for g in good])
    for q, v in good:
        if is_query(q):
            d = np.sqrt(((x - np.array(v)) ** 2).sum(1))
            best = {}
            for i, s in zip(ids, d):
                if i != q:
                    best[i] = min(best.get(i, math.inf), float(s))
            for i, s in best.items():
                out.setdefault(q, {})
                out[q][i] = min(out[q].get(i, math.inf), s)
    return {q: sorted(v.items(), key=lambda p: (p[1], p[0]))[:k] for q, v in out.items()}


def found(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r["query_id"], r["rank"])):
        out.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
        assert r["rank"] == len(out[r["query_id"]])
    return out


def close(a, b):
    assert set(a) == set(b)
    for q in a:
        assert [i for i, _ in a[q]] == [i for i, _ in b[q]]
        assert np.allclose([s for _, s in a[q]], [s for _, s in b[q]], rtol=1e-12)


def test_small_tables_are_exact(spark):
    rng = np.random.default_rng(1)
    rows = [(i, rng.normal(size=8).tolist()) for i in range(300)]
    rows += [(400 + i, rows[7][1]) for i in range(20)] + [(7, rows[7][1]), (3, rows[9][1])]
    rows += [(500, None), (600, []), (700, [0.0] * 8), (800, [1.0] * 7 + [None]), (900, [1.0] * 7 + [math.nan]), (1000, [math.inf] * 8), (1100, [1.0] * 9), (None, rows[0][1])]
    close(found(ann.nearest(frame(spark, rows), F.col("vec_id") % 50 == 0)), brute(rows, 10, lambda q: q % 50 == 0))
    few = rows[:4]
    close(found(ann.nearest(frame(spark, few), F.col("vec_id") >= 0)), brute(few, 10, lambda q: True))
    assert ann.nearest(frame(spark, []), F.col("vec_id") >= 0).count() == 0


def test_recall_over_parts(spark):
    rng = np.random.default_rng(2)
    centres = rng.normal(size=(40, 16))
    rows = [(i, (centres[rng.integers(40)] + 0.6 * rng.normal(size=16)).tolist()) for i in range(9000)]
    rows += [(20_000 + i, rows[5][1]) for i in range(3000)]  # a very common vector
    want = brute(rows, 10, lambda q: q % 100 == 0)
    got = found(ann.nearest(frame(spark, rows), F.col("vec_id") % 100 == 0))
    assert set(got) == set(want) and all(len(v) == 10 for v in got.values())
    hits = [len({i for i, _ in got[q]} & {i for i, _ in want[q]}) / 10 for q in want]
    assert np.mean(hits) >= 0.9


def test_nothing_is_missed_without_clusters(spark):
    rng = np.random.default_rng(4)
    rows = [(i, rng.normal(size=48).tolist()) for i in range(12_000)]
    rows += [(20_000 + i, (1e4 * rng.normal(size=48)).tolist()) for i in range(500)]  # far away, none like the rest
    is_query = lambda q: q % 100 == 0
    close(found(ann.nearest(frame(spark, rows), F.col("vec_id") % 100 == 0)), brute(rows, 10, is_query))


def test_parts_are_balanced_and_cut_few_edges():
    rng = np.random.default_rng(3)
    x = rng.normal(size=(8, 12))[rng.integers(8, size=1024)] * 4 + rng.normal(size=(1024, 12))
    graph = ann.neighbours(x, 10)
    part = ann.partition(x, graph, 8)
    assert np.ptp(np.bincount(part)) <= 1
    assert (part[graph] == part[:, None]).mean() > 0.6
