"""All registered queries.  Importing a module registers its keys."""

from tidewater.plans import (  # noqa: F401
    aggregates,
    bayesian,
    charting,
    clustering,
    evaluation,
    expressions,
    inputs,
    joins,
    linkage,
    modelling,
    ordering,
    streams,
    texts,
)
from tidewater.plans.registry import PLANS, TWINS

__all__ = ["PLANS", "TWINS"]
