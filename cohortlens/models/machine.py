"""Factorisation machine for pairs of rows of two tables, with its coefficients in a table."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortlens.functions.expr import sigmoid
from cohortlens.operators.sparse import LevelTable, level
from cohortlens.session import new_table_path, reliable_checkpoint

#: Columns of at most so many levels are joined by broadcast.
FEW_LEVELS = 2**14
FIRST_DECAY, SECOND_DECAY, EPSILON = 0.9, 0.999, 1e-8


@dataclass
class Side:
    """Rows of one table, each a node with the positions of its levels in ``at_0``, ``at_1`` …"""

    rows: DataFrame  # key, node, at_0 …
    ranges: list[tuple[int, int]]  # first and last position of each column

    @classmethod
    def of(cls, table: DataFrame, key: str, levels: LevelTable, parity: int) -> Side:
        """Node numbers are even or odd by ``parity``, so that two sides share none."""
        rows = table.withColumn("node", F.monotonically_increasing_id() * 2 + parity)
        for i, c in enumerate(levels.columns):
            mine = levels.table.where(F.col("column") == c).select(F.col("level").alias("_level"), F.col("position").alias(f"at_{i}"))
            rows = rows.withColumn("_value", level(F.col(f"`{c}`"), levels.missing))
            rows = rows.join(mine, F.col("_value") == F.col("_level"), "left").drop("_value", "_level")
        kept = reliable_checkpoint(rows.select(key, "node", *[f"at_{i}" for i in range(len(levels.columns))]))
        found = levels.table.groupBy("column").agg(F.min("position"), F.max("position")).collect()
        ranges = {name: (low, high) for name, low, high in found}
        return cls(kept, [ranges.get(c, (0, -1)) for c in levels.columns])

    @property
    def positions(self) -> Column:
        return F.array_compact(F.array(*[f"at_{i}" for i in range(len(self.ranges))]))

    def sums(self, state: DataFrame, factors: int) -> DataFrame:
        """Bias and sum of factors of every node: (node, s0, s1 …)."""
        rows, none = self.rows, F.lit(0.0)
        for i, (low, high) in enumerate(self.ranges):
            mine = state.where(F.col("position").between(low, high))
            mine = mine.select(F.col("position").alias(f"at_{i}"), *[F.col(f"x{j}").alias(f"_{i}_{j}") for j in range(factors + 1)])
            rows = rows.join(F.broadcast(mine) if high - low < FEW_LEVELS else mine, f"at_{i}", "left")
        value = lambda i, j: F.coalesce(F.col(f"_{i}_{j}"), none)
        columns = range(len(self.ranges))
        bias = sum((value(i, 0) for i in columns), none)
        sums = [sum((value(i, j) for i in columns), none) for j in range(1, factors + 1)]
        squares = sum((value(i, j) * value(i, j) for i in columns for j in range(1, factors + 1)), none)
        whole = bias + (sum((s * s for s in sums), none) - squares) / 2
        return rows.select("node", *[c.alias(f"s{j}") for j, c in enumerate([whole, *sums])])


def drawn(position: Column, factor: int, seed: int, deviation: float) -> Column:
    """A normal number that follows from the position, the factor and the seed."""
    even = lambda which: (F.pmod(F.xxhash64(position, F.lit(factor), F.lit(seed), F.lit(which)), F.lit(2**52)) + 1) / F.lit(2.0**52 + 1)
    return F.sqrt(-2 * F.log(even(0))) * F.cos(2 * F.pi() * even(1)) * deviation


def gradients(edges: DataFrame, students: Side, courses: Side, state: DataFrame, intercept: float, last: int, factors: int) -> DataFrame:
    """Sums over the edges of the logistic loss's derivatives by position: (position, g0, g1 …).

    An edge's miss counts once for every position of its two nodes, times the edge's sum of factors
    less the position's own; it is added up by node first. The intercept is the position ``last``.
    """
    none = F.lit(0.0)
    of = lambda side, key, p: side.sums(state, factors).select(F.col("node").alias(key), *[F.col(f"s{j}").alias(f"{p}{j}") for j in range(factors + 1)])
    joined = edges.join(of(students, "_s", "_p"), "_s", "left").join(of(courses, "_c", "_q"), "_c", "left")
    p, q = ([F.coalesce(F.col(f"{x}{j}"), none) for j in range(factors + 1)] for x in ("_p", "_q"))
    raw = sum((a * b for a, b in zip(p[1:], q[1:])), F.lit(intercept) + p[0] + q[0])
    missed = joined.select("_s", "_c", (sigmoid(raw) - F.col("label")).alias("g0"), *[(p[j] + q[j]).alias(f"t{j}") for j in range(1, factors + 1)])
    weighted = missed.select(
        # the intercept is a node of its own, -1
        F.explode(F.array("_s", "_c", F.lit(-1).cast("long"))).alias("node"), "g0", *[(F.col("g0") * F.col(f"t{j}")).alias(f"g{j}") for j in range(1, factors + 1)]
    )
    names = [f"g{j}" for j in range(factors + 1)]
    add = lambda df, key: df.groupBy(key).agg(*[F.sum(n).alias(n) for n in names])
    by_node = add(weighted.where("node is not null"), "node")
    whole = edges.sparkSession.range(1).select(F.lit(-1).cast("long").alias("node"), F.array(F.lit(last).cast("long")).alias("at"))
    nodes = whole.unionByName(students.rows.select("node", students.positions.alias("at"))).unionByName(courses.rows.select("node", courses.positions.alias("at")))
    return add(nodes.join(by_node, "node").select(F.explode("at").alias("position"), *names), "position")


def moved(state: DataFrame, slopes: DataFrame, rows: int, turn: int, step: float, last: int, factors: int) -> DataFrame:
    """One step of Adam: coefficients x, running means m of the slopes and v of their squares."""
    whole = state.join(slopes, "position", "left")
    g = [F.coalesce(F.col("g0"), F.lit(0.0)) / rows]
    for j in range(1, factors + 1):
        own = (F.col(f"g{j}") - F.col("g0") * F.col(f"x{j}")) / rows
        g.append(F.when(F.col("position") == last, 0.0).otherwise(F.coalesce(own, F.lit(0.0))))
    first = [F.col(f"m{j}") * FIRST_DECAY + g[j] * (1 - FIRST_DECAY) for j in range(factors + 1)]
    second = [F.col(f"v{j}") * SECOND_DECAY + g[j] * g[j] * (1 - SECOND_DECAY) for j in range(factors + 1)]
    mean = lambda j: first[j] / (1 - FIRST_DECAY**turn)
    size = lambda j: F.sqrt(second[j] / (1 - SECOND_DECAY**turn)) + EPSILON
    new = [F.col(f"x{j}") - step * mean(j) / size(j) for j in range(factors + 1)]
    shift = sum(((n - F.col(f"x{j}")) * (n - F.col(f"x{j}")) for j, n in enumerate(new)), F.lit(0.0))
    named = [c.alias(f"{kind}{j}") for kind, columns in (("x", new), ("m", first), ("v", second)) for j, c in enumerate(columns)]
    return stored(whole.select("position", *named, shift.alias("shift")))


def stored(state: DataFrame) -> DataFrame:
    """Write the state and read it back.

    A checkpoint would hand the estimated size of its plan on, which the joins of each turn multiply.
    """
    path = new_table_path(state.sparkSession, "machine")
    state.write.parquet(path)
    return state.sparkSession.read.schema(state.schema).parquet(path)


def fit_machine(
    pairs: DataFrame,
    students: DataFrame,
    courses: DataFrame,
    of_students: LevelTable,
    of_courses: LevelTable,
    factors: int = 4,
    max_iter: int = 10,
    step: float = 0.05,
    deviation: float = 0.01,
    tolerance: float = 1e-6,
    seed: int = 42,
) -> tuple[float, DataFrame]:
    """Intercept and (position, weight, vector) of a second-order machine on pairs (student_id, course_id, label).

    The steps are those of Spark's ``FMClassifier`` (logistic loss, Adam on all rows), whose coefficients and
    slopes lie on the driver; here they stay in tables, and only sums of them reach the driver. The
    starting factors are drawn by position.
    """
    left, right = Side.of(students, "student_id", of_students, 0), Side.of(courses, "course_id", of_courses, 1)
    ends = pairs.join(left.rows.select("student_id", F.col("node").alias("_s")), "student_id", "left")
    ends = ends.join(right.rows.select("course_id", F.col("node").alias("_c")), "course_id", "left")
    edges = reliable_checkpoint(ends.select("_s", "_c", "label"))
    rows, last = edges.count(), of_students.size + of_courses.size
    at = of_students.table.select("position").unionByName(of_courses.table.select("position"))
    at = at.unionByName(pairs.sparkSession.range(last, last + 1).select(F.col("id").alias("position")))
    start = [F.lit(0.0), *[F.when(F.col("position") == last, 0.0).otherwise(drawn(F.col("position"), j, seed, deviation)) for j in range(1, factors + 1)]]
    zeros = [F.lit(0.0).alias(f"{kind}{j}") for kind in ("m", "v") for j in range(factors + 1)]
    state = stored(at.select("position", *[c.alias(f"x{j}") for j, c in enumerate(start)], *zeros))
    intercept = 0.0
    for turn in range(1, max_iter + 1 if rows else 1):
        slopes = gradients(edges, left, right, state, intercept, last, factors)
        state = moved(state, slopes, rows, turn, step, last, factors)
        length = sum((F.col(f"x{j}") * F.col(f"x{j}") for j in range(factors + 1)), F.lit(0.0))
        only = F.max(F.when(F.col("position") == last, F.col("x0")))
        intercept, shift, norm = state.agg(only, F.sqrt(F.sum("shift")), F.sqrt(F.sum(length))).first()
        if turn > 1 and shift < tolerance * max(norm, 1.0):
            break
    vector = F.array(*[f"x{j}" for j in range(1, factors + 1)])
    return intercept, reliable_checkpoint(state.where(F.col("position") < last).select("position", F.col("x0").alias("weight"), vector.alias("vector")))
