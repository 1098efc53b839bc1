"""All registered queries, by section."""

from cohortlens.plans import (  # noqa: F401
    aggregates,
    alerts,
    fairness,
    features,
    metrics,
    modelling,
    outcomes,
    quality,
    ranking,
    recommend,
    relational,
    scalars,
    splits,
    tables,
)
from cohortlens.plans.registry import ORACLE, QUERIES

__all__ = ["ORACLE", "QUERIES"]
