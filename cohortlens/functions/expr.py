"""Column helpers used across the feature and label jobs."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def flag(condition: Column) -> Column:
    """1 where the condition holds, 0 where it is false or NULL."""
    return F.coalesce(condition.cast("int"), F.lit(0))


def band(x: Column, edges: Sequence[float], labels: Sequence[str]) -> Column:
    """Right-closed banding ``(lo, hi]``; NULL outside the outer edges."""
    out = F.lit(None).cast("string")
    for lo, hi, label in reversed(list(zip(edges, edges[1:], labels))):
        out = F.when((x > lo) & (x <= hi), label).otherwise(out)
    return out


def ladder(x: Column, steps: Sequence[tuple[float, object]], default: object) -> Column:
    """First label whose threshold ``x`` reaches, steps in descending order."""
    (limit, label), *rest = steps
    out = F.when(x >= limit, F.lit(label))
    for limit, label in rest:
        out = out.when(x >= limit, F.lit(label))
    return out.otherwise(F.lit(default))


def lookup(key: Column, table: Mapping[str, object], default: object = None) -> Column:
    """Value of a small constant table, ``default`` for unknown and NULL keys."""
    pairs = [F.lit(v) for kv in table.items() for v in kv]
    hit = F.try_element_at(F.create_map(*pairs), F.coalesce(key, F.lit("")))
    return hit if default is None else F.coalesce(hit, F.lit(default))


def clip(x: Column, lo: float, hi: float) -> Column:
    """Limit to ``[lo, hi]``, keeping NULL as NULL."""
    return F.when(x < lo, F.lit(lo)).when(x > hi, F.lit(hi)).otherwise(x)


def safe_ratio(x: Column, n: Column) -> Column:
    """``x / max(n, 1)``."""
    return x / F.greatest(n, F.lit(1))


def share(condition: Column) -> Column:
    """Aggregate: share of rows for which the condition holds."""
    return F.avg(condition.cast("double"))


def count_where(condition: Column) -> Column:
    """Aggregate: number of rows for which the condition holds, 0 for none."""
    return F.count(F.when(condition, 1))


def std0(x: Column) -> Column:
    """Aggregate: sample standard deviation, 0 for a single row."""
    return F.coalesce(F.stddev(x), F.lit(0.0))


def truthy(x: Column) -> Column:
    """Whether the value reads as true, yes or 1."""
    return F.coalesce(F.lower(x.cast("string")).isin("true", "yes", "1"), F.lit(False))


def one_hot(x: Column, levels: Sequence[str], prefix: str) -> list[Column]:
    """One 0/1 column per level, to be used in a single ``select``."""
    return [flag(x == level).alias(column_name(prefix, level)) for level in levels]


def column_name(prefix: str, level: object) -> str:
    return f"{prefix}_{level}".replace(" ", "_")


def sigmoid(x: Column) -> Column:
    return 1 / (1 + F.exp(-x))


def squared(x: Column) -> Column:
    return x * x
