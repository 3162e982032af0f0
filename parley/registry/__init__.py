"""All registered queries."""

from parley.registry import clusters, models, monitoring, records, texts  # noqa: F401
from parley.registry.base import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
