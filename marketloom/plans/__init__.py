"""Feed specifications and the pipeline that runs them."""

from marketloom.plans.catalog import catalog
from marketloom.plans.pipeline import output_schema, rejected_values, run, run_all, unify
from marketloom.plans.spec import FeedSpec, FxRule, Output, Sink

__all__ = [
    "FeedSpec",
    "FxRule",
    "Output",
    "Sink",
    "catalog",
    "output_schema",
    "rejected_values",
    "run",
    "run_all",
    "unify",
]
