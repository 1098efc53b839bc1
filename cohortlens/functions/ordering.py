"""Ordered computations that stay distributed.

A window without a partition key moves every row to one task. The functions here
cut the value range into buckets, so that no task sees more than a slice of the
distinct values, whatever the skew. Quantiles are selected digit by digit.
"""

from __future__ import annotations

import struct
from collections import defaultdict
from collections.abc import Mapping, Sequence
from math import ceil, floor

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortlens.session import reliable_checkpoint, shuffle_width

#: Binary digits that a pass of a quantile search settles; a number has 64.
DIGIT = 16


def value_buckets(df: DataFrame, value: str, into: str = "_bucket") -> DataFrame:
    """Add a bucket number that grows with ``value``; equal values share a bucket.

    Buckets are the ranges of Spark's own range split, one per shuffle partition. They are kept,
    so every use of the result, and every retry of a lost task, sees the same buckets.
    """
    n = shuffle_width(df.sparkSession)
    return reliable_checkpoint(df.repartitionByRange(n, F.col(value)).withColumn(into, F.spark_partition_id()))


def join_same(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Equi-join in which NULL keys match each other; the keys appear once."""
    renamed = right.withColumnsRenamed({k: f"_same_{k}" for k in keys})
    same = F.lit(True)
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"_same_{k}"))
    return left.join(renamed, same, how).drop(*[f"_same_{k}" for k in keys])


def running_totals(
    df: DataFrame,
    value: str,
    totals: Mapping[str, str],
    within: Sequence[str] = (),
    descending: bool = False,
) -> DataFrame:
    """Inclusive running sums over ``value`` order, per ``within`` group.

    ``totals`` maps new column names to the summed columns. ``df`` must hold one
    row per (group, value), i.e. ties are aggregated before the call; a group may
    hold any share of the rows because the work is split by bucket.

    The merged values are kept, as the split, the bucket sums and the rows each read them;
    what they were made from is not read again.
    """
    return bucket_totals(value_buckets(reliable_checkpoint(df), value), value, totals, within, descending).drop("_bucket")


def bucket_totals(
    bucketed: DataFrame,
    value: str,
    totals: Mapping[str, str],
    within: Sequence[str] = (),
    descending: bool = False,
) -> DataFrame:
    """The same for rows that have their bucket: sums per bucket, then sums inside buckets."""
    keys = list(within)
    step = F.col("_bucket").desc() if descending else F.col("_bucket").asc()
    per_bucket = bucketed.groupBy(*keys, "_bucket").agg(
        *[F.sum(src).alias(f"_sum_{name}") for name, src in totals.items()]
    )
    earlier = (
        Window.partitionBy(*(keys or [F.lit(0)]))
        .orderBy(step)
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    offsets = per_bucket.select(
        *keys,
        "_bucket",
        *[
            F.coalesce(F.sum(f"_sum_{name}").over(earlier), F.lit(0)).alias(f"_off_{name}")
            for name in totals
        ],
    )
    order = F.col(value).desc() if descending else F.col(value).asc()
    inside = (
        Window.partitionBy(*keys, "_bucket")
        .orderBy(order)
        .rowsBetween(Window.unboundedPreceding, 0)
    )
    joined = join_same(bucketed, offsets, [*keys, "_bucket"])
    return joined.select(
        *bucketed.columns,
        *[
            (F.col(f"_off_{name}") + F.sum(src).over(inside)).alias(name)
            for name, src in totals.items()
        ],
    )


def average_ranks(df: DataFrame, value: str, into: str = "rank") -> DataFrame:
    """Rank of every row by ``value`` ascending; tied rows get their mean rank."""
    ties = df.groupBy(value).agg(F.count("*").alias("_n"))
    ranked = running_totals(ties, value, {"_upto": "_n"}).select(
        value, (F.col("_upto") - (F.col("_n") - 1) / 2).alias(into)
    )
    return df.join(ranked, value)


def distinct_numbers(values: DataFrame) -> DataFrame:
    """Number the distinct values of ``_value`` from 0 in ascending order (``_number``).

    The values are split by range and sorted within the ranges; the ranges' sizes, one row
    per partition, give each range its first number.
    """
    sorted_values = (
        values.where(F.col("_value").isNotNull()).distinct().repartitionByRange("_value").sortWithinPartitions("_value")
    )
    kept = reliable_checkpoint(sorted_values.withColumn("_id", F.monotonically_increasing_id()))
    part = F.shiftright("_id", 33)
    sizes = kept.groupBy(part.alias("_part")).agg(F.count("*").alias("_n"))
    before = Window.partitionBy(F.lit(0)).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    inside = F.col("_id").bitwiseAND(F.lit((1 << 33) - 1))
    return kept.withColumn("_part", part).join(starts, "_part").select("_value", (F.col("_start") + inside).alias("_number"))


def top_n(df: DataFrame, per: str | Sequence[str], order: Sequence[Column], n: int, rank: str = "rank") -> DataFrame:
    """First ``n`` rows per key; Spark trims each task's rows before the shuffle."""
    keys = [per] if isinstance(per, str) else list(per)
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(rank, F.row_number().over(w)).where(F.col(rank) <= n)


def ordered_key(x: Column) -> Column:
    """A 64-bit number for each double that is ordered like the doubles; no two doubles share one.

    It is the double's binary form: exponent and fraction, negated for negative numbers.
    """
    a = F.abs(x)
    guess = F.floor(F.log2(a)).cast("double")
    # the logarithm may be off by a rounding next to a power of two
    e = F.when(F.pow(F.lit(2.0), guess) > a, guess - 1).when(F.pow(F.lit(2.0), guess + 1) <= a, guess + 1).otherwise(guess)
    normal = (e.cast("long") + 1023) * F.lit(1 << 52) + ((a / F.pow(F.lit(2.0), e) - 1) * float(1 << 52)).cast("long")
    tiny = (a * 2.0**537 * 2.0**537).cast("long")
    size = (
        F.when(F.isnan(a), F.lit(0x7FF8 << 48))
        .when(a == float("inf"), F.lit(0x7FF0 << 48))
        .when(a >= 2.0**-1022, normal)
        .otherwise(tiny)
    )
    return F.when(x.isNull(), None).when(x < 0, -size).otherwise(size)


def key_value(key: int) -> float:
    """The double of a key."""
    size = struct.unpack("<d", struct.pack("<q", abs(key)))[0]
    return -size if key < 0 else size


def exact_quantiles(
    df: DataFrame, columns: Sequence[str], shares: Sequence[float]
) -> dict[tuple[str, float], float]:
    """Exact interpolated quantiles of each column, as a small dict.

    The two rows beside each quantile are found by radix selection: a pass counts the next
    ``DIGIT`` binary digits of the numbers that begin like a wanted row, for all columns and
    quantiles together, combined in the tasks; running counts over the digits tell which digit
    the row has. After 64 / ``DIGIT`` passes its number is known, whatever the data.
    """
    names = [f"_key_{i}" for i in range(len(columns))]
    keys = reliable_checkpoint(df.select(*[ordered_key(F.col(c).cast("double")).alias(k) for c, k in zip(columns, names)]))
    sizes = keys.agg(*[F.count(k).alias(k) for k in names]).first()
    # a cell: a column and the leading digits of its wanted rows, which are told by their place among the cell's rows
    cells: dict[tuple[int, int], set[int]] = {}
    route: dict[tuple[int, int], tuple[int, int, int]] = {}
    for i, k in enumerate(names):
        wanted = {p for s in shares for p in (floor(s * (sizes[k] - 1)), ceil(s * (sizes[k] - 1)))} if sizes[k] else set()
        if wanted:
            cells[i, 0] = wanted
            route.update({(i, p): (i, 0, p) for p in wanted})
    for shift in range(64 - DIGIT, -1, -DIGIT):
        found = next_digits(keys, names, cells, shift)
        cells = defaultdict(set)
        for row, (i, prefix, place) in route.items():
            digit, before = found[i, prefix, place]
            lead = (prefix << DIGIT) + digit
            route[row] = (i, lead, place - before)
            cells[i, lead].add(place - before)
    out = {}
    for i, (c, k) in enumerate(zip(columns, names)):
        for share in shares if sizes[k] else ():
            position = share * (sizes[k] - 1)
            low, high = (key_value(route[i, p][1]) for p in (floor(position), ceil(position)))
            out[c, share] = low + (high - low) * (position - floor(position)) if low != high else low
    return out


def next_digits(
    keys: DataFrame, names: Sequence[str], cells: Mapping[tuple[int, int], set[int]], shift: int
) -> dict[tuple[int, int, int], tuple[int, int]]:
    """For the wanted rows of each cell their next digit, and how many of the cell's rows have smaller ones."""
    if not cells:
        return {}
    first = shift == 64 - DIGIT
    order = list(cells)
    options = []
    for n, (i, prefix) in enumerate(order):
        key = F.col(names[i])
        # the first digit carries the sign
        digit = F.shiftright(key, shift) if first else F.shiftright(key, shift).bitwiseAND(F.lit((1 << DIGIT) - 1))
        inside = key.isNotNull() if first else F.shiftright(key, shift + DIGIT) == F.lit(prefix)
        options.append(F.when(inside, F.struct(F.lit(n).alias("cell"), digit.alias("digit"))))
    counted = keys.select(F.explode(F.array_compact(F.array(*options))).alias("c")).groupBy("c.cell", "c.digit").agg(F.count("*").alias("n"))
    upto = Window.partitionBy("cell").orderBy("digit").rowsBetween(Window.unboundedPreceding, 0)
    totals = counted.withColumn("upto", F.sum("n").over(upto))  # at most 2^DIGIT rows per cell
    wanted = [(n, place) for n, cell in enumerate(order) for place in cells[cell]]
    asked = keys.sparkSession.createDataFrame(wanted, "cell int, place long")
    before = F.col("upto") - F.col("n")
    hits = totals.join(F.broadcast(asked), "cell").where((F.col("place") >= before) & (F.col("place") < F.col("upto")))
    return {(*order[r["cell"]], r["place"]): (r["digit"], r["before"]) for r in hits.select("cell", "place", "digit", before.alias("before")).collect()}


def fit_medians(df: DataFrame, columns: Sequence[str]) -> dict[str, float]:
    """Exact median of each column that has missing values (a few numbers)."""
    missing = df.agg(*[F.count_if(F.col(c).isNull()).alias(f"n_{i}") for i, c in enumerate(columns)]).first()
    gaps = [c for i, c in enumerate(columns) if missing[i]]
    return {c: v for (c, _), v in exact_quantiles(df, gaps, [0.5]).items()} if gaps else {}
