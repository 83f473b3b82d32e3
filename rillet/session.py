"""Session helpers: a sane local/cluster session and the shared scratch folder."""

from __future__ import annotations

import os
import re
import uuid

from pyspark.sql import SparkSession

# Settings that matter at scale.  AQE re-plans joins by their measured size
# (broadcast only below the threshold, sort-merge beyond), splits skewed
# partitions and coalesces small ones.  The session time zone is pinned so
# that formatting is deterministic; the library itself never depends on it.
SCALE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.localShuffleReader.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    # commit a changelog per batch instead of uploading state snapshots
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "rillet", extra_conf: dict | None = None) -> SparkSession:
    """A session with ``SCALE_CONF`` where the submit (or its defaults file) says nothing else.

    ``shuffle_partitions`` is for tests and the benchmark; without it the submitted setting stays.
    """
    builder = SparkSession.builder.appName(app_name)
    for k, v in (extra_conf or {}).items():
        builder = builder.config(k, v)
    if master:
        builder = builder.master(master)
    builder = builder.config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
    if shuffle_partitions is not None:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = builder.getOrCreate()
    submitted = spark.sparkContext.getConf()
    for k, v in SCALE_CONF.items():
        if not submitted.contains(k):
            spark.conf.set(k, v)
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster this setting names a shared file system folder and is read,
    never overridden; without it there we fail rather than write where other
    machines can't read.  Only a local master (tests, a laptop) gets a folder
    of its own.
    """
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        d = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if not d and not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share "
                         f"(master {spark.sparkContext.master})")
    if not d:
        d = os.path.join(os.environ.get("TMPDIR", "/tmp"), "rillet-checkpoints")
        spark.conf.set("spark.checkpoint.dir", d)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(d)
    return d


def scratch_path(spark: SparkSession, kind: str) -> str:
    """A fresh folder under the shared checkpoint dir for staged data or sinks."""
    return f"{_scratch_root(spark)}/{kind}/{uuid.uuid4().hex}"


def _scratch_root(spark: SparkSession) -> str:
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/rillet/{spark.sparkContext.applicationId}"


def clear_scratch(spark: SparkSession) -> None:
    """Remove this application's staged data and intermediates (when its results are written)."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(_scratch_root(spark))
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def materialize(df, kind: str):
    """Write ``df`` once as Parquet under the shared checkpoint folder and read it back.

    For an intermediate that several branches of one plan consume: it is
    computed once instead of once per branch, and its lineage is cut, so a
    lost executor costs a re-read, not a recomputation from the sources.
    This runs a job now (the caller's function becomes eager).
    """
    spark = df.sparkSession
    path = scratch_path(spark, kind)
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)
