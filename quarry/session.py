"""Session construction and the shared scratch folder.

Everything that has to outlive a task (lineage cuts, round-trip files, stream
checkpoints) goes under ``spark.checkpoint.dir``: on a cluster that setting names a
shared file system folder.  We only fill it in when the session has none (tests,
local runs); a cluster's own value always wins.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "quarry", driver_memory: str | None = None) -> SparkSession:
    """Session with the settings every query here assumes.

    * UTC session time zone (zone-less timestamps are read as wall-clock UTC);
    * AQE on, with partition coalescing and skew-join splitting, so partition
      counts and broadcast decisions are taken from runtime sizes;
    * Arrow for the few pandas-backed steps;
    * no UI server.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.ui.enabled": "false",
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
        "spark.ui.showConsoleProgress": "false",
    }
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    if driver_memory:  # only effective before the JVM starts (local mode)
        conf["spark.driver.memory"] = driver_memory
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the session's checkpoint folder, creating a local one only when unset."""
    current = spark.conf.get(CHECKPOINT_CONF, None) or spark.sparkContext.getConf().get(CHECKPOINT_CONF)
    if not current:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        current = tempfile.mkdtemp(prefix="quarry-ckpt-")
        spark.conf.set(CHECKPOINT_CONF, current)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(current)
    return current


#: Folders handed out by ``scratch_path`` and not deleted yet.
_scratch: list[str] = []


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh, unique folder name under the shared checkpoint folder."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    _scratch.append(f"{base}/quarry-{label}-{uuid.uuid4().hex[:12]}")
    return _scratch[-1]


def delete_path(spark: SparkSession, path: str) -> None:
    """Delete a folder on whatever file system its path names."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def clean_scratch(spark: SparkSession) -> int:
    """Delete the scratch folders of this process; call it when the results that read them are
    no longer needed.  Returns their number."""
    n = len(_scratch)
    while _scratch:
        delete_path(spark, _scratch.pop())
    return n

