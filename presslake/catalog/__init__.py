"""Registered queries over the driver tables, each next to its SQL twin where one exists."""

from presslake.catalog import articles, configs, health, matching, pages, scalars, storage  # noqa: F401
from presslake.catalog.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
