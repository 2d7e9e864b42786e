"""Frame-shaping helpers: renames, re-indexing, null splits, bounded value
lists and provider <-> storage formats of price bars (PRJ-03 .. PRJ-05,
FLT-02, DAT-02/04)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scalar import date_to_int, int_to_date

# Provider column names -> storage column names of the bars
# table, and the date column on each side.
PROVIDER_TO_STORAGE = {
    "Open": "open_pr",
    "High": "high_pr",
    "Low": "low_pr",
    "Close": "close_pr",
    "Adj Close": "adj_close_pr",
    "Volume": "volume",
}
PROVIDER_DATE = "Date"
STORAGE_DATE = "t_date"


def to_storage(df: DataFrame) -> DataFrame:
    """PRJ-03 + DAT-02: provider bars (``Date`` as a date) -> storage names
    with ``t_date`` as a yyyyMMdd int."""
    out = df.withColumnsRenamed({k: v for k, v in PROVIDER_TO_STORAGE.items() if k in df.columns})
    if PROVIDER_DATE in out.columns:
        out = out.withColumn(STORAGE_DATE, date_to_int(F.col(PROVIDER_DATE))).drop(PROVIDER_DATE)
    return out


def from_storage(df: DataFrame) -> DataFrame:
    """PRJ-03 inverse: storage names -> provider names, ``t_date`` int ->
    ``Date`` date."""
    inv = {v: k for k, v in PROVIDER_TO_STORAGE.items()}
    out = df.withColumnsRenamed({k: v for k, v in inv.items() if k in df.columns})
    if STORAGE_DATE in out.columns:
        out = out.withColumn(PROVIDER_DATE, int_to_date(F.col(STORAGE_DATE))).drop(STORAGE_DATE)
    return out


def conform(df: DataFrame, cols: Sequence[str], types: dict[str, str] | None = None) -> DataFrame:
    """PRJ-04: select ``cols`` in that order; missing ones become typed NULLs."""
    types = types or {}
    return df.select(*[F.col(c) if c in df.columns else F.lit(None).cast(types.get(c, "string")).alias(c)
                       for c in cols])


def column_values(df: DataFrame, col: str, limit: int, order_by: Sequence[str] | None = None) -> list:
    """PRJ-05: a column as a Python list -- bounded: at most ``limit`` values
    reach the driver (ordered when an order is given)."""
    d = df.select(col)
    if order_by:
        d = df.orderBy(*order_by).select(col)
    return [r[0] for r in d.limit(limit).collect()]


def split_on_null(df: DataFrame, col: str) -> tuple[DataFrame, DataFrame]:
    """FLT-02: (rows where ``col`` IS NULL, rows where it is not).  Persist
    the input first when both branches are used and the input is costly."""
    return df.where(F.col(col).isNull()), df.where(F.col(col).isNotNull())


def months_before(as_of, months: int):
    """DAT-04: the date ``months`` months before ``as_of`` (explicit, never now())."""
    d = F.lit(as_of).cast("date") if isinstance(as_of, str) else as_of
    return F.add_months(d, -months)
