"""Query catalogue and DuckDB oracles."""

from tideline.plans import catalog, live, oracle
from tideline.plans.catalog import flagship

QUERIES = {**catalog.QUERIES, **live.QUERIES}
ORACLES = {**oracle.ORACLES, **live.ORACLES}

__all__ = ["ORACLES", "QUERIES", "flagship"]
