"""Every checked query, by name, with its SQL counterpart where one exists."""

from bidscope.catalog import (  # noqa: F401
    archives,
    insights,
    lookup,
    pages,
    streams,
    texts,
    vectors,
    writes,
)
from bidscope.catalog.base import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
