"""Every operator as a query over the test tables, next to the SQL that checks it."""

from postlake.plans.catalog import exports, increments, load, streams, tables, texts, views  # noqa: F401
from postlake.plans.catalog.registry import CATALOG

__all__ = ["CATALOG"]
