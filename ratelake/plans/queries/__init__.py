"""All registered queries."""

from ratelake.plans.queries import (  # noqa: F401
    cleaning, exploring, featuring, recommending, serving, sourcing, validating, storing,
)
from ratelake.plans.registry import ORACLES, QUERIES

__all__ = ["QUERIES", "ORACLES"]
