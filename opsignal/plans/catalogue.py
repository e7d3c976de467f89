"""All registered queries: importing a plan module registers its queries."""

from opsignal.plans import correlation, models, rows, streams, texts  # noqa: F401
from opsignal.plans.registry import QUERIES, SQL

__all__ = ["QUERIES", "SQL"]
