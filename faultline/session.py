"""Session helpers: a configured SparkSession and the shared checkpoint folder."""
from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Defaults every job relies on: adaptive execution (runtime broadcast of
# small sides, partition coalescing, skew-join splitting), UTC so that
# timestamp truncation never depends on the machine, and no web UI.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    "spark.ui.showConsoleProgress": "false",
}


def get_spark(master: str | None = None, app: str = "faultline",
              shuffle_partitions: int | None = None,
              extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with the library defaults."""
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def pin_utc(spark: SparkSession) -> None:
    """Calendar keys (day/week/month) are computed in UTC."""
    if spark.conf.get("spark.sql.session.timeZone", None) != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def short_methods(spark: SparkSession) -> None:
    """HotSpot runs methods above 8,000 bytes of bytecode interpreted.  Where
    a stage would get one, Spark then generates it in parts, as its docs
    advise for HotSpot, unless the session has a limit of its own."""
    name = "spark.sql.codegen.hugeMethodLimit"
    if spark.conf.get(name, "65535") == "65535":
        spark.conf.set(name, "8000")


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for checkpoints and materialised intermediates.

    On a cluster this is ``spark.checkpoint.dir`` (a shared file system
    every executor can reach); without it a cluster is refused, since each
    executor would write to its own disk.  Only in local mode -- as in tests
    -- a scratch folder is created and registered when it is unset.
    """
    sc = spark.sparkContext
    d = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        if not sc.master.split("[")[0] == "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        d = tempfile.mkdtemp(prefix="faultline-ckpt-")
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(d)
    return sc.getCheckpointDir() or d


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions", "200"))


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path under the shared checkpoint folder for written intermediates."""
    base = checkpoint_dir(spark)
    return os.path.join(base, name) if "://" not in base else base.rstrip("/") + "/" + name
