"""Data-quality rules, evaluated together in one pass over the table."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

SEVERITIES = ["info", "warning", "error", "critical"]
FAMILIES = {"numeric": T.NumericType, "string": T.StringType, "datetime": (T.TimestampType, T.TimestampNTZType, T.DateType)}


@dataclass
class Rule:
    """A check made of aggregates over the table and a verdict on their results.

    ``measures`` names the aggregates the rule needs; ``verdict`` turns the resulting
    one-row columns into (passed, message). Subclass it to add a rule.
    """

    name: str = "rule"
    description: str = ""
    severity: str = "error"

    def measures(self, df: DataFrame) -> dict[str, Column]:
        return {}

    def verdict(self, df: DataFrame) -> tuple[Column, Column]:
        raise NotImplementedError


def joined(problems: Sequence[Column], fine: str) -> Column:
    """The messages that are not NULL, or ``fine`` if there are none."""
    text = F.concat_ws("; ", *problems) if problems else F.lit("")
    return F.when(text == "", fine).otherwise(text)


def all_of(conditions: Sequence[Column]) -> Column:
    out = F.lit(True)
    for c in conditions:
        out = out & c
    return out


@dataclass
class SchemaRule(Rule):
    """Columns are present and of the expected family (numeric, string, datetime)."""

    columns: Sequence[str] = ()
    families: dict[str, str] = field(default_factory=dict)
    allow_missing: bool = False
    name: str = "schema_validation"
    description: str = "Validate column presence and types"

    def verdict(self, df):
        missing = sorted(set(self.columns) - set(df.columns))
        kinds = {f.name: f.dataType for f in df.schema.fields}
        wrong = [
            f"Column {c} has type {kinds[c].simpleString()}, expected {family}"
            for c, family in self.families.items()
            if c in kinds and not isinstance(kinds[c], FAMILIES[family])
        ]
        note = "Missing columns (allowed): " if self.allow_missing else "Missing required columns: "
        messages = ([note + ", ".join(missing)] if missing else []) + wrong
        passed = not wrong and (self.allow_missing or not missing)
        return F.lit(passed), F.lit("; ".join(messages) or "Schema validation passed")


@dataclass
class NullRule(Rule):
    """The share of NULLs in each column stays within a limit."""

    columns: Sequence[str] = ()
    max_share: float = 0.0
    allow_nulls: bool = False
    name: str = "null_check"
    description: str = "Check for null values"

    def __post_init__(self):
        self.severity = "warning" if self.allow_nulls else "error"

    def measures(self, df):
        return {f"null_{c}": F.avg(F.col(c).isNull().cast("double")) for c in self.columns if c in df.columns}

    def verdict(self, df):
        shares = {c: F.col(f"null_{c}") for c in self.columns if c in df.columns}
        over = {c: F.coalesce(s > self.max_share, F.lit(False)) for c, s in shares.items()}
        problems = [
            F.when(
                over[c],
                F.concat(F.lit(f"Column {c} has "), F.format_string("%.1f", s * 100), F.lit(f"% nulls (max: {self.max_share * 100}%)")),
            )
            for c, s in shares.items()
        ]
        passed = F.lit(True) if self.allow_nulls else all_of([~o for o in over.values()])
        return passed, joined(problems, "Null check passed")


@dataclass
class RangeRule(Rule):
    """No value lies below the minimum or above the maximum; NULLs do not count."""

    column: str = ""
    minimum: float | None = None
    maximum: float | None = None
    name: str = "range_check"
    severity: str = "warning"

    def __post_init__(self):
        self.description = f"Check {self.column} is within range"

    def measures(self, df):
        c, out = F.col(self.column), {}
        if self.column in df.columns and self.minimum is not None:
            out[f"below_{self.column}"] = F.count_if(c < self.minimum)
        if self.column in df.columns and self.maximum is not None:
            out[f"above_{self.column}"] = F.count_if(c > self.maximum)
        return out

    def verdict(self, df):
        if self.column not in df.columns:
            return F.lit(True), F.lit(f"Column {self.column} not found")
        limits = {"below": ("minimum", self.minimum), "above": ("maximum", self.maximum)}
        counts = {side: F.col(f"{side}_{self.column}") for side, (_, v) in limits.items() if v is not None}
        problems = [
            F.when(n > 0, F.concat(n, F.lit(f" values in {self.column} {side} {limits[side][0]} {limits[side][1]}")))
            for side, n in counts.items()
        ]
        return all_of([n == 0 for n in counts.values()]), joined(problems, "Range check passed")


@dataclass
class UniqueRule(Rule):
    """Each column has no repeated value; NULL counts as one value."""

    columns: Sequence[str] = ()
    allow_duplicates: bool = False
    name: str = "uniqueness_check"
    description: str = "Check for uniqueness"

    def __post_init__(self):
        self.severity = "warning" if self.allow_duplicates else "error"

    def measures(self, df):
        return {f"repeated_{c}": repeated(F.col(c)) for c in self.columns if c in df.columns}

    def verdict(self, df):
        counts = {c: F.col(f"repeated_{c}") for c in self.columns if c in df.columns}
        problems = [
            F.when(n > 0, F.concat(F.lit(f"Column {c} has "), n, F.lit(" duplicate values"))) for c, n in counts.items()
        ]
        passed = F.lit(True) if self.allow_duplicates else all_of([n == 0 for n in counts.values()])
        return passed, joined(problems, "Uniqueness check passed")


@dataclass
class CardinalityRule(Rule):
    """Too few distinct values fail; too many are only reported."""

    column: str = ""
    minimum: int = 1
    maximum: int = 100
    name: str = "cardinality_check"
    severity: str = "warning"

    def __post_init__(self):
        self.description = f"Check {self.column} cardinality"

    def measures(self, df):
        return {f"distinct_{self.column}": F.count_distinct(F.col(self.column))} if self.column in df.columns else {}

    def verdict(self, df):
        if self.column not in df.columns:
            return F.lit(True), F.lit(f"Column {self.column} not found")
        n = F.col(f"distinct_{self.column}")
        head = F.lit(f"Column {self.column} has ")
        problems = [
            F.when(n < self.minimum, F.concat(head, F.lit("low cardinality ("), n, F.lit(f" < {self.minimum})"))),
            F.when(n > self.maximum, F.concat(head, F.lit("high cardinality ("), n, F.lit(f" > {self.maximum})"))),
        ]
        return n >= self.minimum, joined(problems, "Cardinality check passed")


def repeated(c: Column) -> Column:
    """Aggregate: rows beyond the first of each value, NULL being a value."""
    return F.count("*") - F.count_distinct(c) - F.max(F.when(c.isNull(), 1).otherwise(0))


def validate(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """One row per rule: (rule_no, rule, description, severity, passed, message).

    The aggregates of all rules are computed in a single pass. A rule that cannot be
    set up is reported as failed with its error.
    """
    measures: dict[str, Column] = {}
    cells: list[Column] = []
    for i, rule in enumerate(rules, start=1):
        try:
            if rule.severity not in SEVERITIES:
                raise ValueError(f"unknown severity {rule.severity!r}")
            measures |= rule.measures(df)
            passed, message = rule.verdict(df)
        except Exception as e:
            passed, message = F.lit(False), F.lit(f"error: {e}")
        cells.append(
            F.struct(
                F.lit(i).alias("rule_no"),
                F.lit(rule.name).alias("rule"),
                F.lit(rule.description).alias("description"),
                F.lit(rule.severity).alias("severity"),
                passed.alias("passed"),
                message.alias("message"),
            )
        )
    one = df.agg(F.count("*").alias("n_rows"), *[m.alias(name) for name, m in measures.items()])
    return one.select(F.explode(F.array(*cells)).alias("cell")).select("cell.*")


def summary(results: DataFrame) -> DataFrame:
    """Passed and failed rules, their score and the overall status."""
    counted = results.agg(F.count_if("passed").alias("rules_passed"), F.count_if(~F.col("passed")).alias("rules_failed"))
    total = F.col("rules_passed") + F.col("rules_failed")
    return counted.select(
        "rules_passed",
        "rules_failed",
        F.when(F.col("rules_failed") == 0, "passed").otherwise("failed").alias("overall_status"),
        F.coalesce(F.try_divide("rules_passed", total), F.lit(1.0)).alias("validation_score"),
    )
