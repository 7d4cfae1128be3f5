"""Registered queries. Importing this package fills the registry."""

from tidemark.queries import (  # noqa: F401
    cleaning, evaluation, files, gold, lookups, panels, privacy, profiles, training)
from tidemark.queries.registry import QUERIES, SQL

__all__ = ["QUERIES", "SQL"]
