import hashlib
import random
import re
from collections import Counter

import pytest

from cohortlens.llm import pii

PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        v = int(c) * (1 + i % 2)
        total += v - 9 * (v > 9)
    return total % 10 == 0


def passes(kind, value):
    digits = re.sub("[^0-9]", "", value)
    if kind == "ip":
        return all(int(p) <= 255 for p in value.split("."))
    if kind == "card":
        return 16 <= len(digits) <= 19 and luhn(digits)
    return kind == "email" or 8 <= len(digits) <= 15


def base_spans(text):
    return [(k, m.start(), m.end()) for k in PLAIN for m in re.finditer(PLAIN[k], text or "") if passes(k, m[0])]


def told(spans):
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def as_spans(text):
    return [(k, int(a), int(b)) for k, a, b in (x.split(":") for x in text.split(",") if x)]


def pieces(rng):
    return "".join(rng.choice(["1", "23", "456", "+1 ", ".", "-", " ", "@", "a", "b.c", "255", "256", "(", ")", "é", "𝒳", "\n", "4111111111111111", "0"]) for _ in range(rng.randint(1, 60)))


def check(spark, docs_of, rows):
    texts = Counter()
    for i, t in rows:
        spans = base_spans(t)
        counts = Counter(k for k, _, _ in spans)
        texts[(i, *(counts[k] for k in pii.KINDS), hashlib.sha256(told(spans).encode()).hexdigest())] += 1
    got = pii.personal_data(docs_of(rows)).collect()
    assert Counter((r["doc_id"], *(r[f"n_{k}"] for k in pii.KINDS), r["base_sha256"]) for r in got) == texts
    return got


def test_base_spans_equal_brute_force(spark, docs_of, odd_rows):
    rng = random.Random(5)
    rows = [(100 + i, pieces(rng)) for i in range(400)]
    long = [(600, "a@b.c" * 3000), (601, "9" * 30_000), (602, "x" * 30_000), (603, "a@b.c_d@e.f " * 400), (604, "1.2.3.4.5.6.7.8 " * 700), (605, "a@" + "b." * 5000 + "c")]
    long += [(606, "4111 1111-1111 1111 +44 20 7946 0958 host 10.0.0.1 me@x.org"), (607, "000.00.255.0001 1.2.3.256")]
    check(spark, docs_of, rows + long + odd_rows)


def test_no_rows(spark, docs_of):
    out = pii.personal_data(docs_of([]))
    assert out.count() == 0 and out.columns[:6] == ["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256"]
    assert pii.extract(docs_of([(1, None), (2, "")])).count() == 0


@pytest.fixture(scope="module")
def planted(prose):
    rng = random.Random(7)
    rows, hidden = [], {}
    for i in range(40):
        rows.append((i, f"{prose(i, 20)} Please call me at +1 ({rng.randint(200, 999)}) 555-{rng.randint(1000, 9999)} tonight {prose(i + 50, 9)}"))
        rows.append((100 + i, f"{prose(i, 9)} contact mail: user{i}@mail{i}.example.com thanks"))
    for i in range(5):
        value = f"{rng.randint(200, 999)} 555 {rng.randint(1000, 9999)}"
        rows.append((200 + i, f"{prose(i + 90, 12)} Please call me at {value} tonight again"))
        hidden[200 + i] = ("phone", value)
        value = f"some.user{i} [at] host{i} [dot] org"
        rows.append((300 + i, f"contact mail: {value} thanks"))
        hidden[300 + i] = ("email", value)
    # a value that is known from its context is found where the context is missing
    rows.append((400, f"no label {hidden[200][1]} here"))
    hidden[400] = hidden[200]
    for i in range(60):
        rows.append((500 + i, f"{prose(i + 300, 15)} {rng.randint(100000, 9999999)} {prose(i + 400, 5)} ab{rng.randint(10**6, 10**7)}"))
    return rows, hidden


def test_contexts_discover_unseen_identifiers(spark, docs_of, planted):
    rows, hidden = planted
    got = {r["doc_id"]: r for r in check(spark, docs_of, rows)}
    for i, text in rows:
        extra = set(as_spans(got[i]["spans"])) - set(base_spans(text))
        if i in hidden:
            kind, value = hidden[i]
            assert extra == {(kind, text.index(value), text.index(value) + len(value))}
        else:
            assert not extra and got[i]["spans"] == told(base_spans(text))
        assert got[i]["n_discovered"] == len(extra)
    full = pii.extract(docs_of(rows)).where("belief < 1").collect()
    assert {(r["doc_id"], r["kind"], r["value"]) for r in full} == {(i, k, v.lower()) for i, (k, v) in hidden.items()}


def test_a_context_of_mixed_values_accepts_nothing(spark, docs_of, planted):
    rows, hidden = planted
    noise = [(1000 + i, f"Please call me at {100000 + 7 * i} tonight") for i in range(300)]
    got = pii.personal_data(docs_of([r for r in rows if r[0] < 300] + noise)).where("n_discovered > 0")
    assert got.count() == 0


def test_graph_scores_equal_brute_force(spark, docs_of, planted):
    rows, _ = planted
    found = pii.occurrences(pii.scanned(docs_of(rows)))
    values, edges = pii.graph(found)
    kinds = {r["value"]: r["kind"] for r in values.collect()}
    reached = {}
    for r in edges.collect():
        reached.setdefault(r["pattern"], set()).add(r["value"])
    expect = {}
    for p, of in reached.items():
        total = sum(1.0 if kinds[v] else pii.UNKNOWN for v in of)
        for k in pii.KINDS:
            n = sum(kinds[v] == k for v in of)
            if n >= pii.SUPPORT and n / (total + 1) >= 0.5:
                expect[p, k] = (round(n / (total + 1), 9), n)
    beliefs = values.selectExpr("value", "kind", "if(kind is null, 0D, 1D) as belief", "if(kind is null, 0, 1) as known")
    got = {(r["pattern"], r["kind"]): (r["confidence"], r["support"]) for r in pii.pattern_scores(edges, beliefs).collect()}
    assert got == expect and got
