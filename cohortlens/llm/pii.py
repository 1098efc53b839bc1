"""Personal data by bootstrapped contextual extraction. DataFrame functions only.

Base spans come from one pattern per kind (``BASE``) and a check of the match (``VALID``). They are
the seeds. Further spans are found by what stands around the seeds:

1. Candidates are pieces of text shaped like an identifier that no base span touches: digit groups,
   tokens of letters and digits, addresses with a spelled-out at sign (``CANDIDATES``).
2. Every seed and candidate occurrence has up to four lexical patterns: two words before, two words
   after, one word on both sides, and a label that ends in ``:``, ``=`` or ``#``. Words are
   lower-cased, digits count as 0. Distinct (pattern, value) pairs are the edges of a graph.
3. Rounds over the graph: a pattern's confidence for a kind is the belief in that kind among its
   values, over all its values plus one; unknown values count half at least. It needs ``SUPPORT``
   distinct known values. A candidate value's belief is the noisy-or of its patterns, the best of each
   sort of pattern. Values of belief ``ACCEPT`` or more count as known in the next round.
   Rounds end when no value is added, after ``ROUNDS`` at most.
4. All occurrences of accepted values become spans of the accepted kind; base spans stay.

The text is scanned once and only spans and contexts are kept (by a checkpoint). Pairs are made
distinct before they are joined, sums combine before the shuffle, and the joins are plain, so Spark
can split a frequent pattern or value. No document id is a key: rows are joined by a number of their own.

Results of the awkward cases: null and empty texts have no spans; repeated ids and rows are separate
rows, each with its spans; a very long text is one row, its spans numbered in blocks so that work
stays far from quadratic; other columns are left out; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortlens.session import reliable_checkpoint

KINDS = ("email", "ip", "card", "phone")
LOCAL = "[A-Za-z0-9._%+-]"

#: A pattern of each kind. Possessive repeats and fixed starts keep long runs from being tried again and again;
#: they match what plain greedy repeats match.
BASE = {
    "email": rf"(?:\G|(?<!{LOCAL})){LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: What a text must hold for its kind's pattern to be tried at all.
HINT = {"email": "@", "ip": r"[0-9]\.[0-9]", "card": "[0-9][0-9 -][0-9]", "phone": r"\+[0-9]"}
PART = "0*(?:[0-9]{1,2}|1[0-9][0-9]|2[0-4][0-9]|25[0-5])"
DIGITS = "regexp_replace(x.value, '[^0-9]', '')"
LUHN = f"""aggregate(sequence(1, length({DIGITS})), 0, (sum, i) -> sum +
    if(i % 2 = 1, int(substring(reverse({DIGITS}), i, 1)),
       2 * int(substring(reverse({DIGITS}), i, 1)) - if(int(substring(reverse({DIGITS}), i, 1)) > 4, 9, 0))) % 10 = 0"""
VALID = {
    "email": "true",
    "ip": rf"x.value rlike r'^{PART}(?:\.{PART}){{3}}$'",
    "card": f"length({DIGITS}) between 16 and 19 and {LUHN}",
    "phone": f"length({DIGITS}) between 8 and 15",
}

AT = r"(?:@|\x20?[\[({][Aa][Tt][\])}]\x20?)"
DOT = r"(?:\.|\x20?[\[({][Dd][Oo][Tt][\])}]\x20?)"
#: Shapes of unseen identifiers, and the kinds that each may turn out to be.
CANDIDATES = {
    "mail": rf"(?:\G|(?<!{LOCAL})){LOCAL}++{AT}[A-Za-z0-9-]++(?:{DOT}[A-Za-z0-9-]++)*+",
    "number": r"(?<![0-9A-Za-z])[+(]?[0-9](?:[\x20()./-]{0,2}[0-9])++(?![0-9A-Za-z])",
    "token": r"(?<![A-Za-z0-9])(?:[A-Za-z]++[0-9]|[0-9]++[A-Za-z:])[A-Za-z0-9:._-]*+",
}
CANDIDATE_HINT = {"mail": "@|[\\[({][Aa][Tt][\\])}]", "number": "[0-9][0-9 ()./-]+[0-9]", "token": "[A-Za-z:][0-9]|[0-9][A-Za-z:]"}
CANDIDATE_VALID = {
    "mail": "true",
    "number": f"length({DIGITS}) between 6 and 24",
    "token": f"length(x.value) >= 8 and length({DIGITS}) >= 4",
}
FITS = {"mail": ["email"], "number": ["ip", "card", "phone"], "token": ["ip", "card", "phone"]}

#: Every pattern needs one of these; other texts are not searched.
ANY = "[0-9@]|[\\[({][Aa][Tt][\\])}]"

#: Characters of context kept on each side of a span.
REACH = 48
#: Spans whose ends are summed up at a time.
BLOCK = 256
SUPPORT = 3
ACCEPT = 0.9
UNKNOWN = 0.5
ROUNDS = 6


def ends(steps: str) -> str:
    """Running totals of an array of lengths, block by block."""
    last = "coalesce(try_element_at(acc, -1), 0L)"
    blocks = f"transform(sequence(0, (size({steps}) - 1) div {BLOCK}), b -> slice({steps}, int(b) * {BLOCK} + 1, {BLOCK}))"
    inner = f"transform({blocks}, v -> aggregate(v, cast(array() as array<bigint>), (acc, s) -> concat(acc, array({last} + s))))"
    before = f"aggregate({inner}, array(0L), (acc, v) -> concat(acc, array({last} + element_at(v, -1))))"
    return f"flatten(zip_with({inner}, slice({before}, 1, size({inner})), (v, base) -> transform(v, e -> e + base)))"


def with_spans(df: DataFrame, text: str, into: str, pattern: str, hint: str, valid: str) -> DataFrame:
    """Add the leftmost non-overlapping matches: start, end (code points), value and context on both sides."""
    hits, gaps, steps, stops = (f"_{into}_{x}" for x in ("hits", "gaps", "steps", "stops"))
    df = df.withColumn(hits, F.when(F.col(text).rlike(hint), F.regexp_extract_all(text, F.lit(pattern), F.lit(0))))
    df = df.withColumn(gaps, F.when(F.size(F.coalesce(hits, F.array())) > 0, F.split(text, pattern, -1)))
    df = df.withColumn(steps, F.expr(f"transform({hits}, (h, i) -> bigint(length(h) + length({gaps}[int(i)])))"))
    df = df.withColumn(stops, F.expr(f"if({gaps} is null, cast(array() as array<bigint>), {ends(steps)})"))
    return df.withColumn(
        into,
        F.expr(
            f"""filter(transform({stops}, (e, i) -> named_struct(
                'start', e - length({hits}[int(i)]), 'end', e, 'value', {hits}[int(i)],
                'left', lower(right({gaps}[int(i)], {REACH})), 'right', lower(left({gaps}[int(i) + 1], {REACH})))), x -> {valid})"""
        ),
    ).drop(hits, gaps, steps, stops)


def scanned(docs: DataFrame) -> DataFrame:
    """``doc_id``, a row number, the base spans of each kind and the candidates of each shape; no texts."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    rows = rows.withColumn("text", F.when(F.col("text").rlike(ANY), F.col("text")).otherwise(""))
    for kind in KINDS:
        rows = with_spans(rows, "text", kind, BASE[kind], HINT[kind], VALID[kind])
    for shape in CANDIDATES:
        rows = with_spans(rows, "text", shape, CANDIDATES[shape], CANDIDATE_HINT[shape], CANDIDATE_VALID[shape])
    return reliable_checkpoint(rows.drop("text").withColumn("row", F.monotonically_increasing_id()))


def exploded(scan: DataFrame, names: tuple[str, ...], as_name: str) -> DataFrame:
    """One row per span, named after the array that it comes from."""
    arrays = [f"transform({n}, x -> named_struct('{as_name}', '{n}', 'span', x))" for n in names]
    return scan.select("row", F.explode(F.expr(f"concat({', '.join(arrays)})")).alias("s")).select("row", f"s.{as_name}", "s.span.*")


def patterns() -> Column:
    """The lexical patterns of an occurrence, from its two contexts."""
    left = "transform(filter(split(regexp_replace(left, '[0-9]', '0'), '[ \\t\\n\\x0B\\f\\r]+'), w -> w <> ''), w -> w)"
    right = left.replace("(left,", "(right,")
    return F.expr(
        f"""array_compact(array(
            if(size({left}) >= 2, concat('before ', array_join(slice({left}, -2, 2), ' ')), null),
            if(size({right}) >= 2, concat('after ', array_join(slice({right}, 1, 2), ' ')), null),
            if(size({left}) >= 1 and size({right}) >= 1, concat('around ', try_element_at({left}, -1), ' _ ', try_element_at({right}, 1)), null),
            if(regexp_replace(left, '[ \\t]+$', '') rlike '[\\\\p{{L}}0-9][:=#]$', concat('label ', regexp_replace(try_element_at({left}, -1), '^.*[ \\t]', '')), null)))"""
    )


def occurrences(scan: DataFrame) -> DataFrame:
    """Seeds (``kind``) and candidates (``shape``); candidates that touch a base span or a longer candidate before them go."""
    seeds = exploded(scan, KINDS, "kind").withColumn("shape", F.lit(None).cast("string"))
    found = exploded(scan, tuple(CANDIDATES), "shape").withColumn("kind", F.lit(None).cast("string"))
    both = seeds.unionByName(found)
    base_end = F.max(F.when(F.col("kind").isNotNull(), F.col("end")))
    base_start = F.min(F.when(F.col("kind").isNotNull(), F.col("start")))
    w = Window.partitionBy("row").orderBy("start")
    far = both.withColumn("_from", base_end.over(w)).withColumn(
        "_to", base_start.over(w.rangeBetween(Window.currentRow, Window.unboundedFollowing))
    )
    free = (F.coalesce("_from", F.lit(-1)) <= F.col("start")) & (F.coalesce(F.col("_to") >= F.col("end"), F.lit(True)))
    kept = far.where(F.col("kind").isNotNull() | free).drop("_from", "_to")
    # shapes may overlap each other: the one that starts first, and of these the longest, stays
    order = Window.partitionBy("row", F.col("kind").isNull()).orderBy("start", F.col("end").desc(), "shape")
    earlier = F.max("end").over(order.rowsBetween(Window.unboundedPreceding, -1))
    kept = kept.withColumn("_earlier", earlier).where(F.col("kind").isNotNull() | (F.coalesce("_earlier", F.lit(-1)) <= F.col("start")))
    return kept.drop("_earlier").withColumn("value", F.lower("value"))


def graph(found: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Distinct values (``value``, ``shape``, ``kind`` if known) and distinct edges to their patterns."""
    values = found.groupBy("value").agg(F.min("kind").alias("kind"), F.min("shape").alias("shape"))
    edges = found.select("value", F.explode(patterns()).alias("pattern")).distinct()
    return reliable_checkpoint(values), reliable_checkpoint(edges)


def pattern_scores(edges: DataFrame, beliefs: DataFrame) -> DataFrame:
    """Confidence of each pattern for each kind; ``beliefs`` has value, kind, belief and known (base or accepted) for every value."""
    seen = edges.join(beliefs, "value")
    total = F.sum(F.when(F.col("known") == 1, 1.0).otherwise(F.greatest(F.lit(UNKNOWN), F.col("belief"))))
    of = {k: F.when(F.col("kind") == k, F.col("belief")).otherwise(0.0) for k in KINDS}
    wide = seen.groupBy("pattern").agg(
        total.alias("total"),
        *[F.sum(of[k]).alias(f"sum_{k}") for k in KINDS],
        *[F.sum(F.when((F.col("kind") == k) & (F.col("known") == 1), 1).otherwise(0)).alias(f"n_{k}") for k in KINDS],
    )
    each = F.array(*[F.struct(F.lit(k).alias("kind"), F.col(f"sum_{k}").alias("mass"), F.col(f"n_{k}").alias("support")) for k in KINDS])
    return (
        wide.select("pattern", "total", F.explode(each).alias("e"))
        .where(F.col("e.support") >= SUPPORT)
        .select("pattern", F.col("e.kind").alias("kind"), F.round(F.col("e.mass") / (F.col("total") + 1), 9).alias("confidence"), F.col("e.support").alias("support"))
        .where(F.col("confidence") >= 0.5)
    )


def value_beliefs(edges: DataFrame, scores: DataFrame, values: DataFrame) -> DataFrame:
    """Best kind and belief of every candidate value that a scored pattern reaches."""
    fits = F.create_map(*[x for s, kinds in FITS.items() for x in (F.lit(s), F.array(*map(F.lit, kinds)))])
    by_sort = (
        edges.join(scores, "pattern")
        .groupBy("value", "kind", F.substring_index("pattern", " ", 1).alias("sort"))
        .agg(F.max("confidence").alias("best"))
    )
    by_kind = by_sort.groupBy("value", "kind").agg(F.round(1 - F.exp(F.sum(F.log(1 - F.col("best")))), 9).alias("belief"))
    unknown = values.where("kind is null").select("value", "shape")
    fitting = by_kind.join(unknown, "value").where(F.array_contains(F.try_element_at(fits, F.col("shape")), F.col("kind")))
    at = F.when(F.col("kind") == KINDS[0], 0)
    for i, k in enumerate(KINDS[1:], 1):
        at = at.when(F.col("kind") == k, -i)
    return fitting.groupBy("value").agg(F.max(F.struct("belief", at.alias("place"), "kind")).alias("m")).select("value", "m.kind", "m.belief")


def bootstrapped(values: DataFrame, edges: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Accepted candidate values (value, kind, belief) and the pattern scores of the last round."""
    seeds = values.where("kind is not null").select("value", "kind", F.lit(1.0).alias("belief"), F.lit(1).alias("known"))
    unknown = values.where("kind is null").select("value")
    believed = values.sparkSession.createDataFrame([], "value string, kind string, belief double")
    accepted = -1
    for _ in range(ROUNDS):
        open_ones = unknown.join(believed, "value", "left").select(
            "value", "kind", F.coalesce("belief", F.lit(0.0)).alias("belief"), (F.coalesce("belief", F.lit(0.0)) >= ACCEPT).cast("int").alias("known")
        )
        scores = reliable_checkpoint(pattern_scores(edges, seeds.unionByName(open_ones)))
        believed = reliable_checkpoint(value_beliefs(edges, scores, values))
        before, accepted = accepted, believed.where(F.col("belief") >= ACCEPT).count()
        if accepted == before or not accepted:
            break
    return believed.where(F.col("belief") >= ACCEPT), scores


def discovered(scan: DataFrame) -> DataFrame:
    """Spans that the context gives: row, kind, start, end, value, belief."""
    found = reliable_checkpoint(occurrences(scan))
    values, edges = graph(found)
    accepted, _ = bootstrapped(values, edges)
    return found.where("kind is null").drop("kind").join(accepted, "value").select("row", "kind", "start", "end", "value", "belief")


def extract(docs: DataFrame) -> DataFrame:
    """All spans, base and discovered: doc_id, kind, start, end, value, belief (1 for base spans)."""
    scan = scanned(docs)
    base = exploded(scan, KINDS, "kind").select("row", "kind", "start", "end", F.lower("value").alias("value"), F.lit(1.0).alias("belief"))
    return base.unionByName(discovered(scan)).join(scan.select("row", "doc_id"), "row").drop("row")


def personal_data(docs: DataFrame) -> DataFrame:
    """Counts, digest and list of spans, one row per document row.

    ``n_<kind>`` and ``base_sha256`` are of base spans; ``spans`` lists all; ``n_discovered`` counts the added ones.
    """
    scan = scanned(docs)
    place = {k: i for i, k in enumerate(KINDS)}
    at = F.create_map(*[x for k, i in place.items() for x in (F.lit(k), F.lit(i))])
    extra = (
        discovered(scan)
        .groupBy("row")
        .agg(F.collect_list(F.struct(F.try_element_at(at, F.col("kind")).alias("k"), F.col("start").alias("start"), F.col("end").alias("end"))).alias("extra"))
    )
    base = "concat(" + ", ".join(f"transform({k}, x -> named_struct('k', {i}, 'start', x.start, 'end', x.end))" for k, i in place.items()) + ")"
    names = "array(" + ", ".join(f"'{k}'" for k in KINDS) + ")"
    told = f"transform(%s, x -> concat({names}[x.k], ':', x.start, ':', x.end))"
    thin = scan.select("row", "doc_id", *[F.size(k).cast("long").alias(f"n_{k}") for k in KINDS], F.expr(base).alias("base"))
    joined = thin.join(extra, "row", "left").withColumn("extra", F.expr("coalesce(extra, filter(base, x -> false))"))
    joined = joined.withColumn("every", F.expr("array_sort(concat(base, extra))"))
    return joined.select(
        "doc_id",
        *[f"n_{k}" for k in KINDS],
        F.sha2(F.array_join(F.expr(told % "base"), ",").cast("binary"), 256).alias("base_sha256"),
        F.array_join(F.expr(told % "every"), ",").alias("spans"),
        F.size("extra").cast("long").alias("n_discovered"),
    )
