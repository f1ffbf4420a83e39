"""Every runnable query, with the SQL it is checked against."""

from lectern.registry import changes, columns, flows, grouped, warehouse  # noqa: F401  (registration)
from lectern.registry.core import CHECKS, QUERIES

__all__ = ["CHECKS", "QUERIES"]
