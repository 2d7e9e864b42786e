"""Benchmark: run the headline queries on ``$BENCH_SF_DIR`` (default
/root/testdata/sf0.1) on ``local[$BENCH_CPUS]`` and print one JSON line.

Every query is executed in full with the ``noop`` sink (the whole plan runs,
nothing is collected to the driver), under the package's own settings; the
shuffle width is one partition per local core.  A generated range is summed
and joined first, so that the JVM's start is not charged to the first query; no
table and no registered query takes part in that warm-up.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tessera.plans import REGISTRY  # noqa: E402
from tessera.session import build_session  # noqa: E402

HEADLINE = [
    "app_profile", "app_open_days_times", "open_by_tag", "install_by_category", "tag_distribution",
    "components", "components_bounded", "id_sets", "cooccurrence_edges", "influence", "neighbor_mean",
    "wifi_recognize", "wifi_id_mapping",
    "bar_indicators", "signal_report", "insert_ignore",
    "word_count", "inverted_index", "phrase_search",
    "describe", "five_number", "histogram", "sorted_prices", "value_counts",
    "geohash_points", "geohash_cells", "kafka_records", "name_id",
    "tumbling_word_count", "ml_features", "rf_logloss",
    "stored_index", "price_bands", "bar_indicators_long", "event_file_profile",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE
    parts = int(os.environ.get("BENCH_SHUFFLE_PARTITIONS", cpus))  # one shuffle partition per local core
    spark = build_session(f"local[{cpus}]", parts,
                          extra={"spark.driver.memory": os.environ.get("BENCH_DRIVER_MEMORY", "16g"),
                                 "spark.checkpoint.dir": tempfile.mkdtemp(prefix="bench-")})
    spark.sparkContext.setLogLevel("ERROR")
    ids = spark.range(1_000_000).selectExpr("id", "id % 1000 AS k")
    ids.join(ids.groupBy("k").count(), "k").selectExpr("sum(id + count)").collect()  # not timed
    times: dict[str, float] = {}
    for name in names:
        t0 = time.time()
        df = REGISTRY[name].build(spark, sf_dir)
        df.write.format("noop").mode("overwrite").save()
        times[name] = round(time.time() - t0, 3)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "total_query_seconds", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": sf}))
    spark.stop()


if __name__ == "__main__":
    main()
