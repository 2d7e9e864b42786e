"""Command-line jobs (spark-submit entry points) with argument validation.

    spark-submit -m tessera.jobs app-profile --meta M.tsv --open-events 'open/{date}/*.json' \
        --install-events 'install/{date}/*.json' --date 20181210 --days 30 --table db.app_profile
    spark-submit -m tessera.jobs wifi-recognize --date-p 20181210 --source-table db.wifi_log \
        --target-table db.wifi_ids --max-iter 30
    spark-submit -m tessera.jobs word-count-stream --source /in/lines --window "3 seconds" --out /out/wc
    spark-submit -m tessera.jobs signal-report --bars-table db.bars --as-of 2024-01-31 --days 30

Each job reads its inputs, runs the operators of this package and writes to a
table or path; the session comes from spark-submit (``--master`` etc.).
"""

from __future__ import annotations

import argparse
import datetime
import re
import sys

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions.scalar import clean_sentinel
from .operators import graph as G
from .operators import profile as P
from .operators import timeseries as TS
from .session import build_session, cut_lineage
from .sources import files, sinks
from .streaming import wordcount as W

_DATE = re.compile(r"^\d{8}$")


def _yyyymmdd(s: str) -> str:
    if not _DATE.match(s):
        raise argparse.ArgumentTypeError(f"expected a yyyyMMdd date, got {s!r}")
    try:
        datetime.datetime.strptime(s, "%Y%m%d")
    except ValueError as e:
        raise argparse.ArgumentTypeError(str(e)) from e
    return s


def _non_negative(s: str) -> int:
    v = int(s)
    if v < 0:
        raise argparse.ArgumentTypeError("must be >= 0")
    return v


def _positive(s: str) -> int:
    v = int(s)
    if v < 1:
        raise argparse.ArgumentTypeError("must be >= 1")
    return v


def day_list(date: str, days: int) -> list[str]:
    """GEN-09 on the driver (a list of ``days + 1`` dates, for path lists)."""
    d = datetime.datetime.strptime(date, "%Y%m%d")
    return [(d - datetime.timedelta(days=i)).strftime("%Y%m%d") for i in range(days + 1)]


def _expand(spark: SparkSession, template: str, dates: list[str], keys: list[str], types: list[str]) -> list[str]:
    """The paths of a template that exist, wildcards included."""
    if not any(x in template for x in ("{date}", "{key}", "{type}")):
        return [template]
    return files.partitioned_paths(spark, template, dates, keys, types)


def run_app_profile(spark: SparkSession, a: argparse.Namespace) -> DataFrame:
    dates = day_list(a.date, a.days)
    meta = files.read_app_meta(spark, a.meta)
    open_paths = _expand(spark, a.open_events, dates, a.keys, a.types)
    install_paths = _expand(spark, a.install_events, dates, a.keys, a.types)
    if not open_paths or not install_paths:
        raise SystemExit("no input paths exist for the requested dates")
    opens = P.open_actions_from_events(files.read_app_events(spark, open_paths, files.OPEN_EVENT_SCHEMA))
    installs = P.installs_from_events(files.read_app_events(spark, install_paths, files.INSTALL_EVENT_SCHEMA))
    profile = P.app_profile(installs, opens, meta, a.date, a.tag_sep, a.dedupe_meta)
    if a.table:
        sinks.append_partition(profile, a.table, "date_p", a.fail_if_partition_exists)
    return profile


def run_wifi_recognize(spark: SparkSession, a: argparse.Namespace) -> DataFrame:
    if a.source_table:
        src = files.read_partition(spark, a.source_table, a.date_p)
        src = src.select("uid", *[clean_sentinel(c).alias(c) for c in ("wifi_name", "geohash", "ip")],
                         "day_num", clean_sentinel("bssid").alias("bssid"))
        actions = src.withColumn("vid", F.monotonically_increasing_id())
    else:
        actions = files.read_wifi_log(spark, a.source_path, "\t", with_row_id=True)
    actions = cut_lineage(actions)  # several branches read the row ids: fixed once
    out = G.recognize_wifi(actions, a.date_p, a.max_iter)
    if a.target_table:
        sinks.overwrite_partitions(out, a.target_table)
    return out


def run_word_count_stream(spark: SparkSession, a: argparse.Namespace):
    lines = files.stream_lines(spark, "text", a.source)
    stamped = W.with_processing_time(lines) if a.time == "processing" else lines
    counts = W.tumbling_word_count(W.words(stamped, "value", "\\s"), "ts", a.window, a.lateness,
                                   keep_window=not a.drop_window)
    w = (counts.writeStream.outputMode("append").format(a.format)
         .option("checkpointLocation", a.checkpoint or f"{a.out}/_checkpoint"))
    if a.format != "console":
        w = w.option("path", a.out)
    q = w.trigger(availableNow=True).start() if a.available_now else w.start()
    q.awaitTermination()
    return q


def run_signal_report(spark: SparkSession, a: argparse.Namespace) -> DataFrame:
    # indicators warm up inside the range; the bounds are compared with the stored column
    start = datetime.date.fromisoformat(a.as_of) - datetime.timedelta(days=a.warmup_days)
    if "t_date" in spark.table(a.bars_table).columns:
        bars = sinks.read_bars(spark, a.bars_table, int(start.strftime("%Y%m%d")), int(a.as_of.replace("-", "")))
        bars = bars.withColumn("t", F.to_timestamp(F.col("t_date").cast("string"), "yyyyMMdd"))
    else:
        bars = spark.table(a.bars_table).where(F.col("t") >= F.lit(start.isoformat()).cast("timestamp"))
    return TS.signal_report(TS.signals(bars), f"{a.as_of} 00:00:00", a.days, a.points)


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="tessera.jobs")
    sub = p.add_subparsers(dest="job", required=True)

    ap = sub.add_parser("app-profile", help="per-user install/open feature table")
    ap.add_argument("--meta", required=True, help="app metadata TSV (columns 2,3,5,7,10 used)")
    ap.add_argument("--open-events", required=True, help="path or template with {date}, {key}, {type}")
    ap.add_argument("--install-events", required=True, help="path or template with {date}, {key}, {type}")
    ap.add_argument("--keys", nargs="*", default=[""], help="values of {key}")
    ap.add_argument("--types", nargs="*", default=[""], help="values of {type}")
    ap.add_argument("--date", required=True, type=_yyyymmdd)
    ap.add_argument("--days", type=_non_negative, default=0, help="also read the N days before --date")
    ap.add_argument("--table", help="target partitioned table (else only shown)")
    ap.add_argument("--tag-sep", default=",")
    ap.add_argument("--dedupe-meta", action="store_true")
    ap.add_argument("--fail-if-partition-exists", action="store_true")

    wr = sub.add_parser("wifi-recognize", help="cluster WiFi access points of one day")
    wr.add_argument("--date-p", required=True, type=_yyyymmdd)
    src = wr.add_mutually_exclusive_group(required=True)
    src.add_argument("--source-table")
    src.add_argument("--source-path", help="TAB-separated log (uid, wifi, geohash, ip, day, bssid)")
    wr.add_argument("--target-table")
    wr.add_argument("--max-iter", type=_positive, default=6)

    wc = sub.add_parser("word-count-stream", help="tumbling-window word count of a line stream")
    wc.add_argument("--source", required=True, help="directory receiving text files")
    wc.add_argument("--window", default="3 seconds")
    wc.add_argument("--lateness", default="10 seconds", help="rows older than the newest by more are dropped")
    wc.add_argument("--time", choices=["processing"], default="processing")
    wc.add_argument("--out", required=True)
    wc.add_argument("--checkpoint")
    wc.add_argument("--format", choices=["parquet", "console"], default="parquet")
    wc.add_argument("--drop-window", action="store_true", help="emit word and count only")
    wc.add_argument("--available-now", action="store_true", help="process what is there, then stop")

    sr = sub.add_parser("signal-report", help="recent panic-sell / reversal signals per symbol")
    sr.add_argument("--bars-table", required=True)
    sr.add_argument("--as-of", required=True, type=lambda s: datetime.date.fromisoformat(s).isoformat())
    sr.add_argument("--days", type=_positive, default=30)
    sr.add_argument("--points", type=_positive, default=2)
    sr.add_argument("--warmup-days", type=_positive, default=150)
    return p


def main(argv: list[str] | None = None) -> int:
    a = parser().parse_args(argv)
    spark = build_session()
    if a.job == "app-profile":
        out = run_app_profile(spark, a)
        if not a.table:
            out.show(50, False)
    elif a.job == "wifi-recognize":
        out = run_wifi_recognize(spark, a)
        if not a.target_table:
            out.show(20, False)
    elif a.job == "word-count-stream":
        run_word_count_stream(spark, a)
    else:
        run_signal_report(spark, a).show(truncate=False)
    return 0


if __name__ == "__main__":
    sys.exit(main())
