"""All registered queries and their SQL twins."""

from __future__ import annotations

from featurepipe.plans import clean_queries, feature_queries, heldout_queries, model_queries, profile_queries  # noqa: F401
from featurepipe.plans.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
