"""The library's operators run over the benchmark tables."""

from stayscope.workload import (  # noqa: F401
    cohort_queries,
    feature_queries,
    metric_queries,
    model_queries,
    source_queries,
    text_queries,
)
from stayscope.workload.feature_queries import flagship
from stayscope.workload.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES", "flagship"]
