"""Which features drive a prediction."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F


def top_factors(contributions: Mapping[str, Column], n: int) -> Column:
    """The ``n`` strongest signed contributions as an array of ``struct<factor, value>``."""
    cells = F.array(*[
        F.struct((-F.abs(v)).alias("order"), F.lit(name).alias("factor"), v.alias("value"))
        for name, v in contributions.items()
    ])
    ordered = F.slice(F.array_sort(cells), 1, n)
    return F.transform(ordered, lambda f: F.struct(f["factor"].alias("factor"), f["value"].alias("value")))
