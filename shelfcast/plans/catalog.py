"""All registered queries."""

from shelfcast.plans import (  # noqa: F401
    feature_queries, fit_queries, grid_queries, model_queries, score_queries, store_queries,
)
from shelfcast.plans.registry import ORACLES, QUERIES  # noqa: F401
