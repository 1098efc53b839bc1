import random
import re
from collections import Counter

import numpy as np
import pandas as pd

from cohortlens.llm import phrases


def low(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def grams(text, sizes=(1, 2, 3, 4)):
    for piece in re.split("[.,;:!?\x0a-\x0d]", low(text)):
        w = [x for x in re.split("[\x20\x09]+", piece) if x]
        for m in sizes:
            for i in range(len(w) - m + 1):
                yield tuple(w[i : i + m])


def brute(rows, least, top):
    f = {}
    for _, text, lang, _ in rows:
        f.setdefault(lang or "und", Counter()).update(grams(text))
    out = []
    for lang, c in f.items():
        n = sum(v for g, v in c.items() if len(g) == 1)
        often = {g: v for g, v in c.items() if len(g) > 1 and v >= least}
        kept = []
        for g, a in often.items():
            inside = (h for h, v in often.items() if len(h) > len(g) and 100 * v >= 80 * a and any(h[i : i + len(g)] == g for i in range(len(h))))
            if next(inside, None):
                continue
            score, k = min((2000000 * a // (c[g[:k]] + c[g[k:]]), k) for k in range(1, len(g)))
            kept.append((-score, -a, " ".join(g).encode(), c[g[:k]], c[g[k:]]))
        out += [(lang, i + 1, p.decode(), -a, left, right, n, -s) for i, (s, a, p, left, right) in enumerate(sorted(kept)[:top])]
    return sorted(out)


def sayings(seed, n):
    rng = random.Random(seed)
    words = ["der", "Über", "weg", "to", "be", "or", "not", "naïve", "x\x1fy", "漢字", "A"]
    return "".join(rng.choice([*words, *words, "new york city hall", "by the way"]) + rng.choice([" "] * 8 + ["  ", "\t", ". ", ",", "\r\n", "? "]) for _ in range(n))


def check(docs_of, rows, least, top):
    got = phrases.collocations(docs_of(rows), least, top)
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    found = sorted(tuple(r) for r in got.collect())
    assert found == brute(rows, least, top)
    return found


def test_collocations_equal_brute_force(docs_of, odd_rows):
    rows = [(i, sayings(i, 40), ["en", "de", None, "und"][i % 4], "src") for i in range(120)]
    rows += [(*r, "en", "src") for r in odd_rows]
    assert len(check(docs_of, rows, 4, 30)) > 60
    assert check(docs_of, rows, 40, 5)


def test_repeated_rows_and_no_rows(docs_of):
    rows = [(1, "good morning dear all", "en", "s")] * 9 + [(2, None, "en", "s"), (3, "", None, "s"), (4, " ,. ", "fr", "s")]
    assert [r[2] for r in check(docs_of, rows, 9, 10)] == ["good morning dear all"]
    assert check(docs_of, rows, 10, 10) == []
    assert phrases.collocations(docs_of([])).count() == 0


def all_ones(n=1 << 16):
    return b"\xff" * (n // 8)


def counted(texts, sizes, parts=3):
    """Counts by language and words, through tries, spilled runs and merges."""
    counting = phrases.Counting(sizes, 42, all_ones(), None, parts)
    rows = [r for lang, t in texts for b in counting.add(lang, t.encode()) for r in b.to_pylist()]
    rows += [r for b in counting.close() for r in b.to_pylist()]
    names, out = {}, Counter()
    for lang, t in texts:
        for (w,) in grams(t, (1,)):
            names[np.uint64(phrases.code_of(w.encode(), 42)).astype(np.int64)] = w
    pdf = pd.DataFrame(rows)
    for part, group in pdf.groupby("part"):
        for r in phrases.merged_runs(group, max(sizes), 1).itertuples():
            out[(r.lang, tuple(names[c] for c in r.codes))] += r.n
    return out, pdf


def test_tries_burst_spill_and_renumber(monkeypatch):
    texts = [(["en", "de"][i % 2], sayings(i, 300) + " end") for i in range(30)]
    texts.append(("en", " ".join(f"w{i % 977}" for i in range(9000))))
    for sizes in ((2,), (3, 4)):
        want = Counter((lang, g) for lang, t in texts for g in grams(t, sizes))
        whole, once = counted(texts, sizes)
        assert whole == want
        for name, value in {"BURST": 8, "HELD": 400, "BATCH": 50, "WORDS": 90, "SLICE": 64}.items():
            monkeypatch.setattr(phrases, name, value)
        small, often = counted(texts, sizes)
        assert small == want and len(often) > 5 * len(once)
        monkeypatch.undo()


def test_containers_burst_by_next_word(monkeypatch):
    monkeypatch.setattr(phrases, "BURST", 10)
    rng = random.Random(1)
    keys = np.sort(np.array([rng.randrange(5) << 42 | rng.randrange(9) << 21 | rng.randrange(4) for _ in range(500)], np.uint64))
    container = phrases.Container(3)
    for part in np.split(keys, 7 * np.arange(1, 70)):
        container.add(part)
    assert container.table is None and container.size == len(set(keys.tolist()))
    held, counts = container.sorted_arrays()
    assert dict(zip(held.tolist(), counts.tolist())) == Counter(keys.tolist()) and (np.diff(held.astype(np.int64)) > 0).all()


def test_words_of_one_code_start_again_with_another_seed(spark, docs_of, monkeypatch):
    texts = phrases.texts_of(docs_of([(1, "a b c a")]))
    rows, seed = phrases.word_table(texts)
    assert seed == 42 and {(bytes(r["word"]), r["n"]) for r in rows.collect()} == {(b"a", 2), (b"b", 1), (b"c", 1)}


def test_bitmap_holds_all_that_is_frequent(spark):
    rows = [("en", [i, i * i]) for i in range(3000)] + [("de", [5, 7])]
    raw = phrases.bitmap_of(spark.createDataFrame(rows, "lang string, codes array<long>"))
    bits = phrases.Bitmap(raw)
    a = np.array([x for _, (x, _) in rows[:3000]], np.uint64)
    assert bits.holds(phrases.folded([a, a * a], phrases.lang_code("en"))).all()
    assert bits.holds(phrases.folded([a + np.uint64(9), a], phrases.lang_code("en"))).mean() < 0.2
    assert len(raw) * 8 <= phrases.BITS[1]
