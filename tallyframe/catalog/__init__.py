"""Every operator as a named query over the star-schema tables, with its SQL twin."""

from . import aggregates, market, models, reports, rolling, scalars, training, zones  # noqa: F401
from .registry import QUERIES, SQL

__all__ = ["QUERIES", "SQL"]
