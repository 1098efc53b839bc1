"""Diverse re-ranking of short lists."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LISTS = "student_id long, course_id long, rank int, score double"


def mmr(listed: DataFrame, vectors: DataFrame, n: int = 10, weight: float = 0.7, candidates: int | None = None) -> DataFrame:
    """Pick courses one by one by weight · relevance − (1 − weight) · similarity to those picked.

    ``listed`` is (student_id, course_id, rank, score), which all take part unless the
    caller asks for the first ``candidates`` per student; ``vectors`` is (course_id, vector). Each
    list is packed into one row, so a batch of students is one numpy computation.
    Similarity is (cosine + 1) / 2, and 0 where a course has no vector or a zero one.
    """
    chosen = listed if candidates is None else listed.where(F.col("rank") <= candidates)
    rows = chosen.join(vectors, "course_id", "left")
    cell = F.struct("rank", "course_id", "score", F.transform("vector", lambda x: x.cast("double")).alias("vector"))
    packed = rows.groupBy("student_id").agg(F.array_sort(F.collect_list(cell)).alias("c"))
    plain = packed.select("student_id", F.col("c.course_id").alias("courses"), F.col("c.score").alias("scores"), F.col("c.vector").alias("vectors"))

    def rerank(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for _, same_size in batch.groupby(batch["courses"].map(len)):
                yield pick(same_size, n, weight)

    return plain.mapInPandas(rerank, LISTS)


def pick(batch: pd.DataFrame, n: int, weight: float) -> pd.DataFrame:
    """Greedy choice for all students of a batch at once (lists of equal length)."""
    courses, scores = np.stack(batch["courses"]), np.stack(batch["scores"]).astype(float)
    size = courses.shape[1]
    similar = np.stack([similarity(v) for v in batch["vectors"]])
    nearest = np.zeros_like(scores)
    free = np.ones_like(scores, dtype=bool)
    rows = np.arange(len(batch))
    out = []
    for step in range(min(n, size)):
        value = np.where(free, weight * scores - (1 - weight) * nearest, -np.inf)
        at = value.argmax(axis=1)
        chosen = scores[rows, at] if size == 1 else value[rows, at]
        out.append(
            pd.DataFrame(
                {"student_id": batch["student_id"].to_numpy(), "course_id": courses[rows, at], "rank": step + 1, "score": chosen}
            )
        )
        free[rows, at] = False
        nearest = np.maximum(nearest, similar[rows, at])
    return pd.concat(out, ignore_index=True)


def similarity(vectors) -> np.ndarray:
    """Pairwise (cosine + 1) / 2 of one list."""
    width = next((len(v) for v in vectors if v is not None), 1)
    m = np.stack([np.zeros(width) if v is None else np.asarray(v, dtype=float) for v in vectors])
    length = np.linalg.norm(m, axis=1)
    known = length > 0
    unit = m / np.where(known, length, 1.0)[:, None]
    return np.where(known[:, None] & known[None, :], (unit @ unit.T + 1) / 2, 0.0)
