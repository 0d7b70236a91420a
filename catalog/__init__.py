"""Named queries over the given tables, one per inventory item or a few of them."""

from catalog import chart_tables, insight_queries, preparing, scalars, sheets, summaries, testing  # noqa: F401
from catalog.base import REGISTRY

__all__ = ["REGISTRY"]
