"""Session settings the library expects, and the shared working folder."""

from __future__ import annotations

import tempfile
import uuid
from functools import cache

from pyspark.sql import DataFrame, SparkSession

# What a cluster session should carry; everything else is left to the operator of the cluster.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # stream state on disk and in the checkpoint folder instead of on the executors' heap
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
}


def local_session(cores: int | str = "*", name: str = "transferlens", **extra: str) -> SparkSession:
    """Single-machine session for tests and the bench."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName(name)
    local = {
        "spark.ui.enabled": "false",
        "spark.driver.memory": "8g",
        "spark.driver.bindAddress": "127.0.0.1",
        "spark.driver.host": "127.0.0.1",
        "spark.sql.shuffle.partitions": "8",
    }
    for key, value in {**SETTINGS, **local, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def work_folder(spark: SparkSession, name: str) -> str:
    """A fresh folder under the cluster's shared ``spark.checkpoint.dir``; it goes when the application ends.

    Only a session on one machine (``local[...]``, as in tests) may do without that setting: it gets a temporary folder. On a
    cluster each executor would write its own disk, so a missing setting is an error there.
    """
    context = spark.sparkContext
    shared = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not shared:
        if not (context.master or "").startswith("local[") and context.master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        shared = _local_folder()
    path = f"{shared.rstrip('/')}/{name}-{uuid.uuid4().hex}"
    _delete_at_end(spark, path)
    return path


@cache
def _local_folder() -> str:
    return tempfile.mkdtemp(prefix="transferlens-")


def _delete_at_end(spark: SparkSession, path: str) -> None:
    """Results are lazy, so a working folder is needed until its readers are done; the file system drops it at the end."""
    jvm = spark.sparkContext._jvm
    folder = jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(folder)


def drop_folder(spark: SparkSession, path: str) -> None:
    """Removes a working folder whose readers are done."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared working folder and read back.

    Cuts the lineage of a frame that several branches of a plan need: they read the table
    instead of recomputing it, also after an executor is lost.
    """
    path = work_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
