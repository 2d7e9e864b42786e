"""Readers (SRC-01 .. SRC-14).

Every reader declares its schema (inference only where asked for), keeps
column predicates as Column expressions so they reach the scan, and turns
positional text into named, typed columns right at the edge.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.scalar import clean_sentinel

# Positional layout of the WiFi connection log (FX-01/FX-02).
WIFI_LOG_FIELDS = [("uid", "bigint"), ("wifi_name", "string"), ("geohash", "string"),
                   ("ip", "string"), ("day_num", "int"), ("bssid", "string")]
# Header-less app metadata TSV, 0-based column index -> name (SRC-03).
APP_META_COLUMNS = {2: "app_name", 3: "app_pkg", 5: "category", 7: "sub_category", 10: "tags"}

OPEN_EVENT_SCHEMA = T.StructType([
    T.StructField("guid", T.StringType()),
    T.StructField("app_name", T.StringType()),
    T.StructField("open_time_and_ip", T.ArrayType(T.StructType([
        T.StructField("open_time", T.StringType()), T.StructField("ip", T.StringType())]))),
])
INSTALL_EVENT_SCHEMA = T.StructType([
    T.StructField("guid", T.StringType()),
    T.StructField("installed_applist", T.ArrayType(T.StringType())),
])


def read_wifi_log(spark: SparkSession, path: str | Sequence[str], sep: str = "\\s",
                  with_row_id: bool = False, has_bssid: bool | None = None) -> DataFrame:
    """SRC-01/02: delimited WiFi log -> typed rows.

    Fields are split by the regex ``sep``, trimmed, sentinel-cleaned and cast
    with ``try_cast`` (a bad number becomes NULL instead of failing the job).
    ``with_row_id`` adds a unique ``vid`` (WIN-08, not consecutive).
    """
    lines = spark.read.text(path)
    parts = F.split(F.col("value"), sep, -1)
    n_fields = len(WIFI_LOG_FIELDS) if has_bssid in (None, True) else len(WIFI_LOG_FIELDS) - 1
    cols = []
    for i, (name, typ) in enumerate(WIFI_LOG_FIELDS[:n_fields]):
        raw = F.trim(F.get(parts, i))
        if typ == "string":
            cols.append(clean_sentinel(raw).alias(name))
        else:
            cols.append(raw.try_cast(typ).alias(name))
    if n_fields < len(WIFI_LOG_FIELDS):
        cols.append(F.lit(None).cast("string").alias("bssid"))
    df = lines.where(F.length(F.trim("value")) > 0).select(*cols)
    if with_row_id:
        df = df.withColumn("vid", F.monotonically_increasing_id())
    return df


def read_app_meta(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """SRC-03: header-less TSV; keep columns 2,3,5,7,10 as named metadata."""
    raw = spark.read.option("sep", "\t").option("header", "false").csv(path)
    return raw.select(*[F.col(f"_c{i}").alias(name) for i, name in APP_META_COLUMNS.items()])


def read_app_events(spark: SparkSession, paths: str | Sequence[str], schema: T.StructType | None = None,
                    key: str = "guid") -> DataFrame:
    """SRC-04 + FLT-01: multi-path JSON scan, rows without a key dropped."""
    r = spark.read
    if schema is not None:
        r = r.schema(schema)
    return r.json(list(paths) if not isinstance(paths, str) else paths).where(F.col(key).isNotNull())


def partitioned_paths(spark: SparkSession, template: str, dates: Iterable[str], keys: Iterable[str],
                      types: Iterable[str]) -> list[str]:
    """SRC-05: expand ``template`` (placeholders ``{date}``, ``{key}``,
    ``{type}``) and keep the paths that exist; a path with wildcards stays if it
    matches anything.

    Prefer a partitioned dataset read with a ``date_p IN (...)`` filter (the
    scan then prunes partitions itself); this is the fallback for layouts that
    are not ``k=v``.  The existence probe is one Hadoop FileSystem call per
    candidate on the driver -- the number of candidates is dates x keys x
    types, a handful, not data-sized.
    """
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    out = []
    for d in dates:
        for k in keys:
            for t in types:
                p = template.format(date=d, key=k, type=t)
                path = jvm.org.apache.hadoop.fs.Path(p)
                if path.getFileSystem(conf).globStatus(path):
                    out.append(p)
    return out


def read_dated(spark: SparkSession, base: str, dates: Iterable[str], fmt: str = "parquet",
               schema: T.StructType | str | None = None, column: str = "date_p") -> DataFrame:
    """SRC-05 (preferred form): a ``<base>/<column>=<date>/...`` dataset read
    with ``column IN (dates)``; partition discovery turns the filter into
    partition pruning, so only the listed directories are scanned (no
    driver-side existence probing)."""
    r = spark.read.format(fmt).option("basePath", base)
    if schema is not None:
        r = r.schema(schema)
    return r.load(base).where(F.col(column).cast("string").isin([str(d) for d in dates]))


def read_partition(spark: SparkSession, table: str, date_p, column: str = "date_p") -> DataFrame:
    """SRC-06: one partition of a catalog table (typed partition filter, pruned)."""
    return spark.table(table).where(F.col(column) == F.lit(str(date_p)))


def read_delimited(spark: SparkSession, path: str | Sequence[str], schema: T.StructType | str,
                   sep: str = "\t", null_marker: str = "NULL") -> DataFrame:
    """SRC-07: typed delimited rows; the null marker and unparsable numbers
    become NULL (PERMISSIVE mode)."""
    return (spark.read.schema(schema).option("sep", sep).option("nullValue", null_marker)
            .option("mode", "PERMISSIVE").csv(path))


def write_delimited(df: DataFrame, path: str, sep: str = "\t", null_marker: str = "NULL",
                    mode: str = "overwrite") -> None:
    """SRC-07 (write side): delimited text with the NULL marker, no quoting
    of plain values."""
    (df.write.mode(mode).option("sep", sep).option("nullValue", null_marker).option("emptyValue", "")
       .option("quoteAll", "false").csv(path))


def read_csv(spark: SparkSession, path: str | Sequence[str], schema: T.StructType | str | None = None) -> DataFrame:
    """SRC-08: CSV with a header; inferred only when no schema is given."""
    r = spark.read.option("header", "true")
    r = r.schema(schema) if schema is not None else r.option("inferSchema", "true")
    return r.csv(path)


def read_tag_distribution(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """SRC-09: ``tagid=distr`` lines."""
    return spark.read.schema("tagid string, distr string").option("sep", "=").csv(path)


def read_listings(spark: SparkSession, path: str | Sequence[str], schema: T.StructType | str | None = None) -> DataFrame:
    """SRC-10: JSON listings."""
    r = spark.read
    if schema is not None:
        r = r.schema(schema)
    return r.option("multiLine", "false").json(path)


def read_libsvm(spark: SparkSession, path: str, num_features: int | None = None) -> DataFrame:
    """SRC-11: LibSVM sparse file -> (label, features)."""
    r = spark.read.format("libsvm")
    if num_features:
        r = r.option("numFeatures", str(num_features))
    return r.load(path)


def from_rows(spark: SparkSession, rows: Sequence, schema: T.StructType | str) -> DataFrame:
    """SRC-12: literal rows with an explicit schema (fixtures only)."""
    return spark.createDataFrame(list(rows), schema)


def parse_follow_pairs(lines: DataFrame, col: str = "value") -> tuple[DataFrame, DataFrame]:
    """SRC-13: ``((name,id),(name,id))`` text -> (vertices(id, name), edges(src, dst)).

    First pair = followee, second = follower; the edge goes followee ->
    follower.  Vertices are the union of both sides, one row per id.
    """
    parts = F.split(F.regexp_replace(F.col(col), "[()]", ""), ",")
    p = lines.select(F.get(parts, 0).alias("n1"), F.get(parts, 1).try_cast("bigint").alias("i1"),
                     F.get(parts, 2).alias("n2"), F.get(parts, 3).try_cast("bigint").alias("i2"))
    edges = p.select(F.col("i1").alias("src"), F.col("i2").alias("dst"))
    verts = (p.select(F.col("i1").alias("id"), F.col("n1").alias("name"))
             .unionByName(p.select(F.col("i2").alias("id"), F.col("n2").alias("name")))
             .groupBy("id").agg(F.min("name").alias("name")))
    return verts, edges


def stream_lines(spark: SparkSession, fmt: str = "text", path: str | None = None, **options) -> DataFrame:
    """SRC-14: streaming line source (``text`` files, ``rate``, or ``socket``
    given host/port options).  Tests use the file source."""
    r = spark.readStream.format(fmt)
    for k, v in options.items():
        r = r.option(k, v)
    return r.load(path) if path else r.load()
