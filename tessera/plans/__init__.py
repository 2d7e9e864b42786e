"""Query bindings over the driver's tables (used by ``__spark_entry__``)."""

from . import (graph_queries, io_queries, misc_queries, ml_queries, profile_queries, stream_queries,  # noqa: F401
               text_queries, ts_queries)
from .common import REGISTRY, Query, register

__all__ = ["REGISTRY", "Query", "register"]
