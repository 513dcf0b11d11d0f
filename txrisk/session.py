"""Spark session defaults and lineage cutting.

The engine never creates executors or schedules work itself: it only
chooses session settings that let Catalyst/AQE do the physical planning
(adaptive coalescing, skew-join splitting, runtime broadcast decisions
bounded by ``autoBroadcastJoinThreshold``).
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings every session of the engine wants.  AQE re-plans joins at run
# time from real sizes (so a broadcast only happens below the threshold),
# splits skewed shuffle partitions and coalesces tiny ones.  The JVM never
# compiles methods of more than 8000 bytes of code, and a projection of some
# forty columns in one generated method is longer (interpreted, three times
# slower); with the limit Spark evaluates it by split methods instead.
ENGINE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.codegen.hugeMethodLimit": "8000",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str = "local[*]", shuffle_partitions: int = 8,
                  app_name: str = "txrisk", extra: dict | None = None) -> SparkSession:
    """Create (or reuse) a session with the engine defaults."""
    builder = SparkSession.builder.master(master).appName(app_name)
    conf = dict(ENGINE_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.setdefault("spark.driver.memory", "8g")
    conf.update(extra or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    configure(spark)
    return spark


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime-settable engine defaults to an existing session."""
    for key, value in ENGINE_CONF.items():
        if spark.conf.isModifiable(key):  # a static setting of a shared session stays
            spark.conf.set(key, value)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder named by the cluster.

    Read from the session (``spark.checkpoint.dir`` / SparkContext); only
    when it is unset, and only on a local master (tests), a fresh folder is made.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local[") and sc.master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        configured = tempfile.mkdtemp(prefix="txrisk-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir()


def cut_lineage(df: DataFrame) -> DataFrame:
    """The frame as a Parquet table in the shared checkpoint folder.

    Used where one intermediate feeds both a global statistic and the row
    stream, so the expensive upstream (shuffle + window) runs once, a lost
    executor re-reads the table instead of recomputing, and a statistic
    reads its columns alone.
    """
    path = table_path(df.sparkSession, "cut")
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def table_path(spark: SparkSession, name: str) -> str:
    """A new folder for a stored table beside the checkpoints."""
    return f"{checkpoint_dir(spark).rstrip('/')}/txrisk-tables/{name}-{uuid.uuid4().hex}"
