"""The registered queries: each with its SQL over the same tables where SQL can say it."""

from seasonlab.catalog.registry import ORACLES, QUERIES
from seasonlab.catalog import drilldown, lineups, models, primitives, profiles, seasons, stored  # noqa: F401  (registers)

__all__ = ["ORACLES", "QUERIES"]
