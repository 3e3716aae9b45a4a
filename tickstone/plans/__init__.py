"""Named queries over the test tables, each with the SQL that must give the same result."""

from tickstone.plans import market, records, rules, tables, timewindows  # isort: skip
from tickstone.plans import streams  # isort: skip  # compares itself with the batch queries
from tickstone.plans.registry import REGISTRY

__all__ = ["REGISTRY", "market", "records", "rules", "streams", "tables", "timewindows"]
