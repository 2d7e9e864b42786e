"""Session defaults and lineage checkpointing.

Every operator in the package is a function DataFrame -> DataFrame and takes
its session from its input; nothing here keeps a global session.  The helpers
below only set what the operators rely on (UTC, AQE with skew-join splitting)
and locate the shared checkpoint folder used by the iterative graph jobs.
"""

from __future__ import annotations

import os
import re
import tempfile

from pyspark.sql import DataFrame, SparkSession

# Settings the operators rely on.  Shuffle width is left to the caller: on a
# cluster it is sized from the input (about 128-256 MB per partition after the
# first shuffle) and AQE coalesces small partitions at run time.
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.ansi.enabled": "true",
}


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "tessera", extra: dict | None = None) -> SparkSession:
    """Create (or reuse) a session with the package defaults.

    ``master`` is only for tests and the bench; on a cluster it comes from
    spark-submit.  The Spark UI stays off: nothing here needs it.
    """
    b = SparkSession.builder.appName(app_name)
    if master:
        b = b.master(master)
    conf = dict(DEFAULT_CONF)
    # Static settings (only when this function creates the context): the
    # per-round checkpoints of the iterative jobs are deleted once their
    # DataFrames are garbage collected, so a long loop does not fill the
    # shared folder; the UI is off.
    conf["spark.cleaner.referenceTracking.cleanCheckpoints"] = "true"
    conf["spark.ui.enabled"] = "false"
    conf["spark.ui.showConsoleProgress"] = "false"
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    for k, v in DEFAULT_CONF.items():
        try:
            spark.conf.set(k, v)
        except Exception:  # static conf on an existing session
            pass
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, setting it only where it is unset.

    On a cluster the folder comes from ``spark.checkpoint.dir`` (a shared file
    system every executor can read).  Only a local-mode session without that
    setting (tests, the bench) gets a fresh folder under the local temp dir.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        try:
            configured = spark.conf.get("spark.checkpoint.dir")
        except Exception:
            configured = None
    if configured:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir() or configured
    if not re.fullmatch(r"local(\[.*\])?", sc.master or ""):
        raise RuntimeError(
            "spark.checkpoint.dir is not set; iterative jobs need a shared "
            "folder (HDFS/S3/...) visible to every executor")
    local = tempfile.mkdtemp(prefix="tessera-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    sc.setCheckpointDir(local)
    return sc.getCheckpointDir() or local


def cut_lineage(df: DataFrame) -> DataFrame:
    """Materialise ``df`` to the shared checkpoint folder (reliable, survives
    executor loss) and return a DataFrame that reads it back."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)
