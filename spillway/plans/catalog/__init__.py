"""One query per operator over the given tables."""

from spillway.plans.catalog import backlog, delivery, incidents, masking, packing, records, settings, streams  # noqa: F401
from spillway.plans.catalog.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
