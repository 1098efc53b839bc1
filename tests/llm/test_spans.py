import re

from cohortlens.llm.queries import op7_sentence_spans
from cohortlens.llm.spans import SENTENCES, WORDS, deduplicate


def brute(rows):
    """Removed sentences by (id, text)."""
    docs, seen, out = sorted(set(rows), key=lambda r: (r[0] is None, r[0] or 0)), {}, {}
    cut = {}
    for d, t in docs:
        cut[d, t] = [s for s in re.findall(r"[^.!?\n]*[.!?]+|[^.!?\n]+", t or "") if s.strip(" \t\n\r\x0b\x0c")]
        words = [s.encode().lower().split() for s in cut[d, t]]
        for i in range(len(words)):
            j = i
            while j < len(words) and (j - i < SENTENCES or sum(map(len, words[i:j])) < WORDS):
                j += 1
            if j - i >= SENTENCES and sum(map(len, words[i:j])) >= WORDS:
                seen.setdefault(tuple(tuple(w) for w in words[i:j]), []).append((d, t, i, j))
    for places in seen.values():
        for d, t, i, j in places[1:]:
            out.setdefault((d, t), set()).update(range(i, j))
    return {(d, t): (len(cut[d, t]), sorted(out.get((d, t), ()))) for d, t in docs}, cut


def check(docs_of, rows):
    want, cut = brute(rows)
    got = deduplicate(docs_of(rows)).collect()
    assert len(got) == len(rows)
    have = sorted(((r["doc_id"], r["n_sentences"], r["removed"], r["kept_text"]) for r in got), key=str)
    expected = []
    for d, t in rows:
        n, gone = want[d, t]
        places = [m.span() for m in re.finditer(r"[^.!?\n]*[.!?]+|[^.!?\n]+", t or "") if m[0].strip(" \t\n\r\x0b\x0c")]
        dropped = {x for i in gone for x in range(*places[i])}
        kept = "".join(c for x, c in enumerate(t or "") if x not in dropped) if len(gone) < n else ""
        expected.append((d, n, gone, kept))
    assert have == sorted(expected, key=str)
    return have


def test_same_as_brute_force(docs_of, prose):
    passages = [prose(500 + i, 55) for i in range(6)]
    rows = []
    for i in range(120):
        parts = [prose(i, 60)]
        if i % 2:
            parts.insert(i % 3 % 2, passages[i % 6])
        if i % 7 == 0:
            parts += [prose(i, 60)]  # repeats itself
        rows.append((1000 - i, " ".join(parts)))
    have = check(docs_of, rows)
    assert sum(bool(h[2]) for h in have) > 50


def test_odd_rows(docs_of, odd_rows):
    # rows of an id with different texts are ordered by their hash, so brute force leaves them out
    rows = [r for r in odd_rows if r[0] != 9] + [odd_rows[8], odd_rows[9]]
    have = check(docs_of, rows)
    by_id = {h[0]: h for h in have}
    # the last sentences of a copy stay if they have too few words for a span
    assert by_id[7][2] == [] and len(by_id[8][2]) > by_id[8][1] - 10
    assert len(deduplicate(docs_of(odd_rows)).collect()) == len(odd_rows)
    assert deduplicate(docs_of([])).count() == 0


def every_run(rows):
    """Removed sentences by id: of all runs of at least SENTENCES sentences, those that occurred before."""
    seen, out = set(), {}
    for d, t in sorted(rows):
        cut = [tuple(s.lower().split()) for s in re.findall(r"[^.!?\n]*[.!?]+|[^.!?\n]+", t) if s.strip()]
        gone = set()
        for i in range(len(cut)):
            for j in range(i + SENTENCES, len(cut) + 1):
                run = tuple(cut[i:j])
                if run in seen:
                    gone.update(range(i, j))
                seen.add(run)
        out[d] = (len(cut), sorted(gone))
    return out


def test_query_covers_every_run(spark, docs_of, prose, tmp_path):
    passages = [prose(700 + i, n) for i, n in enumerate((40, 25, 12, 8))]
    passages += ["One is here. Two are there. Three.", "Yes. No."]
    rows = []
    for i in range(60):
        parts = [prose(4000 + i, 40)]
        if i % 2:
            parts.insert(i % 3 % 2, passages[i % 12 // 2])
        if i % 9 == 0:
            parts.append(parts[0])  # repeats itself
        rows.append((i, " ".join(parts)))
    tail = "Here a first sentence of many words which is long enough to make up a run of twenty words all by itself. "
    rows += [(100, tail + "Ten more words are in this one to go on with. And so it ends."), (101, "Other. Ten more words are in this one to go on with. And so it ends.")]
    rows += [(110, "A short copy. As whole."), (111, "A short copy. As whole."), (112, "One sentence only."), (113, "One sentence only.")]
    docs_of(rows).write.parquet(f"{tmp_path}/documents.parquet")
    got = {r["doc_id"]: (r["n_sentences"], r["removed"]) for r in op7_sentence_spans(spark, str(tmp_path)).collect()}
    assert got == every_run(rows)
    assert got[101][1] == [1, 2] and got[111][1] == [0, 1] and got[113][1] == []
