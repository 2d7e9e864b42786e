"""Shared pieces of the query bindings: the registry and output formatting.

Each registered query is a pair: a Spark builder ``(spark, sf_dir) ->
DataFrame`` over the driver's tables, and (where SQL can express it on whole
tables) an independent DuckDB SQL text producing the same columns.  Doubles
are rounded to 6 digits and maps/arrays are rendered as sorted text so both
sides hash the same way.
"""

from __future__ import annotations

import contextlib
import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import checkpoint_dir
from ..sources.sinks import remove_path
from ..sources.tables import Tables


@dataclass
class Query:
    name: str
    build: Callable[[SparkSession, str], DataFrame]
    sql: str | None
    note: str = ""


REGISTRY: dict[str, Query] = {}


def register(name: str, sql: str | None = None, note: str = ""):
    def deco(fn: Callable[[Tables], DataFrame]):
        def build(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(Tables(spark, sf_dir))
        build.__name__ = f"q_{name}"
        build.__doc__ = fn.__doc__
        if name in REGISTRY:
            raise KeyError(f"duplicate query {name}")
        REGISTRY[name] = Query(name, build, sql.strip() if sql else None, note)
        return fn
    return deco


def r6(c) -> Column:
    """Round a double to 6 digits (both sides of the comparison do this)."""
    c = F.col(c) if isinstance(c, str) else c
    return F.round(c.cast("double"), 6)


def map_text(m) -> Column:
    """map -> ``k=v,k=v`` sorted by key; NULL map stays NULL."""
    m = F.col(m) if isinstance(m, str) else m
    entries = F.array_sort(F.map_entries(m))
    return F.array_join(F.transform(entries, lambda e: F.concat(e["key"].cast("string"), F.lit("="),
                                                                e["value"].cast("string"))), ",")


def array_text(a, sep: str = ",") -> Column:
    """array -> sorted text; NULL array stays NULL."""
    a = F.col(a) if isinstance(a, str) else a
    return F.array_join(F.transform(F.array_sort(a), lambda x: x.cast("string")), sep)


@contextlib.contextmanager
def scratch(spark: SparkSession):
    """A path in the shared checkpoint folder, removed at the end of the block:
    what is read from it must have been checkpointed by then."""
    path = f"{checkpoint_dir(spark).rstrip('/')}/scratch-{uuid.uuid4().hex}"
    try:
        yield path
    finally:
        remove_path(spark, path)


@contextlib.contextmanager
def scratch_table(spark: SparkSession, ddl: str, partition: str, create=None):
    """A new partitioned table of the warehouse, dropped at the end of the block."""
    name = f"scratch_{uuid.uuid4().hex}"
    if create:
        create(spark, name)
    else:
        spark.sql(f"CREATE TABLE {name} ({ddl}) USING parquet PARTITIONED BY ({partition})")
    try:
        yield name
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")
