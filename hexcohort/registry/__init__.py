"""All runnable queries by name, with checking SQL where SQL can express them."""

from hexcohort.registry import clustering, events, features, geo, quality, recommend, segments  # noqa: F401
from hexcohort.registry.core import QUERIES, SQL

__all__ = ["QUERIES", "SQL"]
