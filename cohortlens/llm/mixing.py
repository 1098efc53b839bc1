"""Mixing sources to target weights over a tree of domains, languages and sources.

The token budget goes down the tree: each node's share is split among its children in
proportion to their weights. A child can take no more than its documents hold in
``max_epochs`` passes; what it can't take goes to its siblings, again by weight. A node
therefore falls short only if all below it is used up, and only then do its siblings (the
next level up) get the rest. Budgets are whole tokens; floors leave some over, and these
go to the children with the largest remainders.

A leaf reads its documents in seeded epochs, each a permutation by hash, until its budget
is spent: ``epochs`` whole passes and a prefix of one more. The document in which the
budget ends is taken in part (``prefix_tokens`` of ``n_tokens``).

No task holds a leaf: its tokens are added up per hash digit (two digits of 256 values),
the cut is found among the sums, and only documents that share both digits of the cut are
ordered.

Results of the awkward cases: a null language, source or domain is the child "unknown" of
its parent; texts without words have no tokens and take nothing; documents whose id, size
and leaf are all equal count each, in any order; weights below 1 count as 0, and such a child
gets nothing; an empty table gives an empty result; columns other than those used are ignored.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortlens.session import reliable_checkpoint

LEVELS = ("domain", "lang", "source")
WORD = r"[^\x20\x09-\x0D]+"
#: Leaves whose few numbers are sent to all tasks; with more, documents are joined by leaf.
MOST_LEAVES = 20_000


@dataclass(frozen=True)
class Mix:
    """Weights by child name on each level; names that aren't listed have weight ``other``."""

    domain_of: Mapping[str, str]
    weights: Mapping[str, Mapping[str, int]]
    budget_ppm: int = 1_000_000  # of all tokens
    max_epochs: int = 4
    other: int = 1
    seed: int = 11
    other_domain: str = field(default="other")


def case_of(column: str, names: Mapping[str, object], otherwise: object) -> Column:
    found = F.create_map(*[F.lit(x) for pair in names.items() for x in pair]) if names else None
    return F.coalesce(found[F.col(column)], F.lit(otherwise)) if names else F.lit(otherwise)


def leaves_of(docs: DataFrame, mix: Mix) -> DataFrame:
    """One thin row per document: id, leaf and number of words."""
    unknown = F.lit("unknown")
    named = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col("lang").cast("string"), unknown).alias("lang"),
        F.coalesce(F.col("source").cast("string"), unknown).alias("source"),
        F.coalesce(F.regexp_count(F.col("text").cast("string"), F.lit(WORD)), F.lit(0)).cast("long").alias("n_tokens"),
    )
    return named.withColumn("domain", case_of("source", mix.domain_of, mix.other_domain))


def pour(children: DataFrame, parent: list[str], child: str, mix: Mix) -> DataFrame:
    """Split ``amount`` of each parent among its children (``weight``, ``capacity``).

    In ascending order of capacity for its weight, a child is full if even the equal split of
    what is left among it and those after it would exceed its capacity. The tree has one row
    per child here, not per document.
    """
    wide = "decimal(38,0)"
    group = Window.partitionBy(*parent) if parent else Window.partitionBy(F.lit(0))
    order = group.orderBy(F.col("capacity") / F.col("weight"), child)
    earlier = order.rowsBetween(Window.unboundedPreceding, -1)
    onward = order.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    live = children.where((F.col("weight") > 0) & (F.col("capacity") > 0))
    state = (
        live.withColumn("amount", F.least("amount", F.sum("capacity").over(group)))
        .withColumn("left", F.col("amount") - F.coalesce(F.sum("capacity").over(earlier), F.lit(0)))
        .withColumn("rest", F.sum("weight").over(onward))
    )
    fits = F.col("capacity").cast(wide) * F.col("rest") <= F.col("weight").cast(wide) * F.col("left")
    marked = state.withColumn("full", fits & (F.col("left") > 0))
    # once a child isn't full none after it is
    marked = marked.withColumn("full", F.min(F.col("full").cast("int")).over(order.rowsBetween(Window.unboundedPreceding, 0)) == 1)
    open_left = F.col("amount") - F.sum(F.when(F.col("full"), F.col("capacity")).otherwise(0)).over(group)
    open_rest = F.nullif(F.sum(F.when(F.col("full"), 0).otherwise(F.col("weight"))).over(group), F.lit(0))
    split = marked.withColumn("open_left", open_left).withColumn("open_rest", open_rest)
    product = F.col("open_left").cast(wide) * F.col("weight").cast(wide)
    remainder = (product % F.col("open_rest").cast(wide)).cast("long")
    share = ((product - product % F.col("open_rest").cast(wide)) / F.col("open_rest").cast(wide)).cast("long")
    split = split.withColumn("share", F.when(F.col("full"), F.col("capacity")).otherwise(share))
    split = split.withColumn("over", F.when(F.col("full"), F.lit(-1).cast("long")).otherwise(remainder))
    spare = F.col("amount") - F.sum("share").over(group)
    turn = F.row_number().over(group.orderBy(F.col("over").desc(), child))
    return split.withColumn("spare", spare).withColumn("turn", turn).withColumn(
        "amount", F.least("capacity", F.col("share") + F.when(F.col("turn") <= F.col("spare"), 1).otherwise(0))
    )


def budgets(leaves: DataFrame, mix: Mix) -> DataFrame:
    """Tokens that each leaf gives (``amount``) and has (``tokens``)."""
    sums = reliable_checkpoint(leaves.groupBy(*LEVELS).agg(F.sum("n_tokens").alias("tokens")))
    total = sums.agg(F.sum("tokens")).first()[0] or 0
    amount = total * mix.budget_ppm // 1_000_000
    tree = sums.withColumn("capacity", F.col("tokens") * mix.max_epochs)
    poured = None
    for depth, child in enumerate(LEVELS):
        path = list(LEVELS[: depth + 1])
        nodes = tree.groupBy(*path).agg(F.sum("capacity").alias("capacity"))
        nodes = nodes.withColumn("weight", F.greatest(F.lit(0), case_of(child, mix.weights.get(child, {}), mix.other)).cast("long"))
        if poured is None:
            nodes = nodes.withColumn("amount", F.lit(amount).cast("long"))
        else:
            nodes = nodes.join(poured.select(*path[:-1], "amount"), path[:-1])
        poured = pour(nodes, path[:-1], child, mix)
    return sums.join(poured.select(*LEVELS, "amount"), list(LEVELS), "left").withColumn("amount", F.coalesce("amount", F.lit(0)))


def digits(doc_id: Column, epoch: Column, mix: Mix) -> Column:
    """First 60 bits of a keyed hash, as a number; null ids count as the empty text."""
    text = F.concat(F.lit(f"{mix.seed}:"), epoch.cast("string"), F.lit(":"), F.coalesce(doc_id.cast("string"), F.lit("")))
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 15), 16, 10).cast("long")


def taken_from(leaves: DataFrame, mix: Mix) -> DataFrame:
    """Add ``leaf_budget``, ``epochs`` and ``prefix_tokens`` to the rows of ``leaves_of``."""
    leaves = reliable_checkpoint(leaves)
    plan = (
        budgets(leaves, mix)
        .withColumn("epochs", F.when(F.col("tokens") > 0, F.floor(F.expr("amount div tokens"))).otherwise(0).cast("int"))
        .withColumn("rest", F.when(F.col("tokens") > 0, F.expr("amount % tokens")).otherwise(0))
        .select(*LEVELS, F.col("amount").alias("leaf_budget"), "epochs", "rest")
    )
    leaf = list(LEVELS)
    plan = reliable_checkpoint(plan)
    few = plan.count() <= MOST_LEAVES

    def by_leaf(table: DataFrame) -> DataFrame:
        """A table of one row per leaf goes to the documents, unless there are very many leaves."""
        return F.broadcast(table) if few else table

    rows = leaves.join(by_leaf(plan), leaf).withColumn("place", digits(F.col("doc_id"), F.col("epochs"), mix))
    rows = rows.withColumn("high", F.shiftright("place", 52)).withColumn("low", F.shiftright("place", 44).bitwiseAND(F.lit(255)))
    rows = reliable_checkpoint(rows)

    def cut(part: DataFrame, keys: list[str], digit: str, rest: str) -> DataFrame:
        """The digit in which the rest of the budget ends, and what is left for it."""
        sums = part.groupBy(*keys, rest, digit).agg(F.sum("n_tokens").alias("held"))
        before = Window.partitionBy(*keys).orderBy(digit).rowsBetween(Window.unboundedPreceding, -1)
        sums = sums.withColumn("before", F.coalesce(F.sum("held").over(before), F.lit(0)))
        ends = sums.where((F.col("before") <= F.col(rest)) & (F.col(rest) < F.col("before") + F.col("held")))
        return ends.select(*keys, F.col(digit).alias(f"cut_{digit}"), (F.col(rest) - F.col("before")).alias(f"rest_{digit}"))

    first = cut(rows, leaf, "high", "rest")
    staged = rows.join(by_leaf(first), leaf, "left")
    edge = staged.where(F.col("high") == F.col("cut_high"))
    second = cut(edge, leaf, "low", "rest_high")
    # kept, so that only the documents on an edge are dealt by leaf below
    staged = reliable_checkpoint(staged.join(by_leaf(second), leaf, "left"))
    on_edge = (F.col("high") == F.col("cut_high")) & (F.col("low") == F.col("cut_low"))
    inside = F.coalesce((F.col("high") < F.col("cut_high")) | ((F.col("high") == F.col("cut_high")) & (F.col("low") < F.col("cut_low"))), F.lit(False))
    # only documents that share both digits of their leaf's cut are ordered
    order = Window.partitionBy(*leaf).orderBy("place", "doc_id", "n_tokens").rowsBetween(Window.unboundedPreceding, -1)
    columns = ["doc_id", *leaf, "n_tokens", "leaf_budget", "epochs", "prefix_tokens"]
    ends = staged.where(on_edge).withColumn("before", F.coalesce(F.sum("n_tokens").over(order), F.lit(0)))
    ends = ends.withColumn("prefix_tokens", F.greatest(F.lit(0), F.least("n_tokens", F.col("rest_low") - F.col("before"))).cast("long"))
    others = staged.where(~F.coalesce(on_edge, F.lit(False))).withColumn("prefix_tokens", F.when(inside, F.col("n_tokens")).otherwise(0).cast("long"))
    return others.select(*columns).union(ends.select(*columns))


def mix_documents(docs: DataFrame, mix: Mix) -> DataFrame:
    """Every document with its leaf, its words, and the tokens that the mix takes from it."""
    found = taken_from(leaves_of(docs, mix), mix)
    return found.withColumn("taken_tokens", F.col("epochs") * F.col("n_tokens") + F.col("prefix_tokens"))


def mixed_documents(docs: DataFrame, mix: Mix) -> DataFrame:
    """The documents of the mix, with the columns of ``docs``.

    A document is repeated for each epoch that takes it. One that is taken in part keeps its
    first ``prefix_tokens`` words, joined by single spaces. Rows without tokens aren't taken.
    Rows of ``docs`` that share an id, a leaf and a size all follow the decision of each of them.
    """
    chosen = mix_documents(docs, mix)
    # equal thin rows are merged first: they are taken alike except where the budget ends
    chosen = chosen.where(F.col("taken_tokens") > 0).groupBy("doc_id", *LEVELS, "n_tokens").agg(F.max("epochs").alias("_llm_epochs"), F.max("prefix_tokens").alias("_llm_prefix"))
    keys = [c for c in ("doc_id", "lang", "source")]
    chosen = chosen.select(*[F.col(c).alias(f"_llm_{c}") for c in keys], F.col("n_tokens").alias("_llm_n"), "_llm_epochs", "_llm_prefix")
    unknown = F.lit("unknown")
    same = (
        F.col("doc_id").eqNullSafe(F.col("_llm_doc_id"))
        & (F.coalesce("lang", unknown) == F.col("_llm_lang"))
        & (F.coalesce("source", unknown) == F.col("_llm_source"))
        & (F.coalesce(F.regexp_count(F.col("text"), F.lit(WORD)), F.lit(0)) == F.col("_llm_n"))
    )
    rows = docs.join(chosen, same)
    part = (F.col("_llm_prefix") > 0) & (F.col("_llm_prefix") < F.col("_llm_n"))
    cut = F.array_join(F.slice(F.regexp_extract_all("text", F.lit(WORD), F.lit(0)), 1, F.col("_llm_prefix").cast("int")), " ")
    whole = F.col("_llm_epochs") + F.when((F.col("_llm_prefix") > 0) & ~part, 1).otherwise(0)
    full = rows.where(whole > 0).withColumn("_llm_copy", F.explode(F.sequence(F.lit(1), whole))).select(*docs.columns)
    return full.union(rows.where(part).withColumn("text", cut).select(*docs.columns))


def sql(mix: Mix) -> str:
    """The result of ``mix_documents`` on ``documents``, in DuckDB's SQL."""

    def names(column: str, found: Mapping[str, object], otherwise: object) -> str:
        text = lambda x: f"'{x}'" if isinstance(x, str) else str(max(0, x))
        if not found:
            return text(otherwise)
        return "CASE " + column + "".join(f" WHEN '{k}' THEN {text(v)}" for k, v in found.items()) + f" ELSE {text(otherwise)} END"

    parts = [
        "d AS (SELECT doc_id, COALESCE(lang, 'unknown') AS lang, COALESCE(source, 'unknown') AS source, "
        "CAST(COALESCE(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0) AS BIGINT) AS n_tokens FROM documents)",
        f"e AS (SELECT *, {names('source', mix.domain_of, mix.other_domain)} AS domain FROM d)",
        f"leaf AS (SELECT domain, lang, source, SUM(n_tokens)::HUGEINT AS tokens, {mix.max_epochs} * SUM(n_tokens)::HUGEINT AS capacity FROM e GROUP BY ALL)",
        f"p AS (SELECT SUM(tokens)::HUGEINT * {mix.budget_ppm} // 1000000 AS amount FROM leaf)",
    ]
    above = "p"
    for depth, child in enumerate(LEVELS):
        path, parent = ", ".join(LEVELS[: depth + 1]), ", ".join(LEVELS[:depth]) or "1"
        weight = names(child, mix.weights.get(child, {}), mix.other)
        match = " AND ".join(f"n.{c} = u.{c}" for c in LEVELS[:depth]) or "TRUE"
        order = f"PARTITION BY {parent} ORDER BY capacity::DOUBLE / weight, {child}"
        n = f"{child}_"
        parts += [
            f"{n}n AS (SELECT n.*, u.amount FROM (SELECT {path}, SUM(capacity)::HUGEINT AS capacity, CAST({weight} AS HUGEINT) AS weight FROM leaf GROUP BY {path}) n "
            f"JOIN {above} u ON {match} WHERE weight > 0 AND capacity > 0)",
            f"{n}a AS (SELECT * EXCLUDE (amount), LEAST(amount, SUM(capacity) OVER (PARTITION BY {parent})) AS amount FROM {n}n)",
            f"{n}b AS (SELECT *, amount - COALESCE(SUM(capacity) OVER ({order} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS lft, "
            f"SUM(weight) OVER ({order} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS rst FROM {n}a)",
            f"{n}c AS (SELECT *, MIN(CASE WHEN lft > 0 AND capacity * rst <= weight * lft THEN 1 ELSE 0 END) OVER ({order} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS ful FROM {n}b)",
            f"{n}f AS (SELECT *, amount - SUM(ful * capacity) OVER (PARTITION BY {parent}) AS ol, NULLIF(SUM((1 - ful) * weight) OVER (PARTITION BY {parent}), 0) AS wl FROM {n}c)",
            f"{n}g AS (SELECT *, CASE WHEN ful = 1 THEN capacity ELSE (ol * weight) // wl END AS share, CASE WHEN ful = 1 THEN -1 ELSE (ol * weight) % wl END AS ovr FROM {n}f)",
            f"{n}h AS (SELECT {path}, LEAST(capacity, share + CASE WHEN ROW_NUMBER() OVER (PARTITION BY {parent} ORDER BY ovr DESC, {child}) "
            f"<= amount - SUM(share) OVER (PARTITION BY {parent}) THEN 1 ELSE 0 END) AS amount FROM {n}g)",
        ]
        above = f"{n}h"
    parts += [
        "q AS (SELECT leaf.*, COALESCE(amount, 0) AS leaf_budget, CASE WHEN tokens > 0 THEN COALESCE(amount, 0) // tokens ELSE 0 END AS epochs, "
        f"CASE WHEN tokens > 0 THEN COALESCE(amount, 0) % tokens ELSE 0 END AS rest FROM leaf LEFT JOIN {above} USING (domain, lang, source))",
        "r AS (SELECT e.*, leaf_budget, epochs, rest, "
        f"CAST('0x' || substr(md5('{mix.seed}:' || CAST(epochs AS VARCHAR) || ':' || COALESCE(CAST(doc_id AS VARCHAR), '')), 1, 15) AS BIGINT) AS place FROM e JOIN q USING (domain, lang, source))",
        "s AS (SELECT *, COALESCE(SUM(n_tokens) OVER (PARTITION BY domain, lang, source ORDER BY place, doc_id, n_tokens ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM r)",
        "t AS (SELECT *, GREATEST(0, LEAST(n_tokens, rest - before)) AS prefix_tokens FROM s)",
    ]
    return (
        "WITH " + ",\n".join(parts) + "\nSELECT doc_id, domain, lang, source, n_tokens, CAST(leaf_budget AS BIGINT) AS leaf_budget, CAST(epochs AS INTEGER) AS epochs, "
        "CAST(prefix_tokens AS BIGINT) AS prefix_tokens, CAST(epochs * n_tokens + prefix_tokens AS BIGINT) AS taken_tokens FROM t"
    )
