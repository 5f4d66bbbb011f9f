"""All registered queries, in the order of their modules."""

from canopy.plans import (  # noqa: F401
    q_features, q_models, q_relational, q_sources, q_spatial, q_streams, q_views)
from canopy.plans.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
