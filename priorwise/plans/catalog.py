"""All registered queries of the library: importing this module fills the registry."""

from . import feature_queries, metric_queries, profile_queries, robustness_queries, splits_and_cohorts, tables_and_bridges  # noqa: F401
from .registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
