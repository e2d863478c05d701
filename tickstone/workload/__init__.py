"""The engine's operators bound to the shared test tables, with matching SQL."""

from . import files, gold, serving, signals, silver, versions  # noqa: F401
from .registry import QUERIES, SQL

__all__ = ["QUERIES", "SQL"]
