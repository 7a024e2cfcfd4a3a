"""Every operator as a registered query over the driver's tables."""

from premisa.catalog import data, matching, scoring, search  # noqa: F401
from premisa.catalog.registry import QUERIES, SQL

__all__ = ["QUERIES", "SQL"]
