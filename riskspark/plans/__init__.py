"""All registered queries."""

from riskspark.plans import (  # noqa: F401
    assoc_plans, cluster_plans, lookback_plans, report_plans, rule_plans, sampling_plans, score_plans, screening_plans, shape_plans, static_plans)
from riskspark.plans.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
