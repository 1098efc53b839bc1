"""Catalogue of runnable queries and the SQL that states what each must return."""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortlens.plans.canonical_sql import CTES
from cohortlens.sources.tables import Campus

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None, doubles: Sequence[str] = ()):
    """Register ``fn(campus) -> DataFrame`` under ``name``.

    ``sql`` is the same result in ANSI SQL over the parquet tables; it may name the
    canonical tables, which are put in front of it. ``doubles`` lists its floating
    columns: both sides print them with six decimals.
    """

    def register(fn: Callable[[Campus], DataFrame]):
        def run(spark: SparkSession, folder: str) -> DataFrame:
            return six_decimals(fn(Campus(spark, folder)))

        run.__name__ = name
        run.__doc__ = fn.__doc__
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = run
        if sql is not None:
            ORACLE[name] = oracle(sql, doubles)
        return fn

    return register


def six_decimals(df: DataFrame) -> DataFrame:
    """Round double columns, without a negative zero."""
    return df.select(
        *[
            F.when(F.round(F.col(f"`{f.name}`"), 6) == 0, F.lit(0.0))
            .otherwise(F.round(F.col(f"`{f.name}`"), 6))
            .alias(f.name)
            if isinstance(f.dataType, T.DoubleType)
            else F.col(f"`{f.name}`")
            for f in df.schema.fields
        ]
    )


def oracle(sql: str, doubles: Sequence[str]) -> str:
    body = sql.strip()
    own, final = [], body
    if body[:5].upper() == "WITH ":
        # the query brings its own CTEs: keep them behind the canonical ones
        depth, cut = 0, None
        for m in re.finditer(r"[()]|\bSELECT\b", body):
            token = m.group()
            depth += token == "("
            depth -= token == ")"
            if token == "SELECT" and depth == 0:
                cut = m.start()
                break
        own, final = [body[5:cut].strip()], body[cut:]
    needed = with_dependencies(body)
    if doubles:
        shown = ", ".join(
            f'CASE WHEN ROUND(CAST("{c}" AS DOUBLE), 6) = 0 THEN CAST(0 AS DOUBLE) '
            f'ELSE ROUND(CAST("{c}" AS DOUBLE), 6) END AS "{c}"'
            for c in doubles
        )
        final = f"SELECT * REPLACE ({shown}) FROM (\n{final}\n) AS result"
    ctes = [f"{name} AS (\n{CTES[name].strip()}\n)" for name in needed] + own
    return ("WITH " + ",\n".join(ctes) + "\n" if ctes else "") + final


def with_dependencies(text: str) -> list[str]:
    """Canonical tables a statement uses, each after those it builds on."""
    found: list[str] = []

    def visit(statement: str) -> None:
        for name, body in CTES.items():
            if name not in found and re.search(rf"\b{name}\b", statement):
                visit(body)
                if name not in found:
                    found.append(name)

    visit(text)
    return found
