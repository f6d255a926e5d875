"""All registered queries."""

from campusweave.catalog import datasets, frontier, text  # noqa: F401
from campusweave.catalog.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
