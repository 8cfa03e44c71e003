"""Query catalogue: every operator as a named query over whole tables, with its SQL equivalent."""

from driftline.plans.catalog import (  # noqa: F401
    drift_queries,
    feature_queries,
    ingest_queries,
    metric_queries,
    model_queries,
    registry_queries,
    split_queries,
    stream_queries,
    telemetry_queries,
)
from driftline.plans.catalog.base import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
