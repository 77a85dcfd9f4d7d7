"""Session settings and the shared working folder."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Run-time SQL settings every job relies on. They can be set on a session that
# somebody else built, so library code never has to own the session.
RUNTIME_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    # folders are listed many to a task, not one
    "spark.sql.sources.parallelPartitionDiscovery.parallelism": "256",
    # top-k per group is cut down in each task first, also for a large k
    "spark.sql.optimizer.windowGroupLimitThreshold": "100000",
    # state of the trade stream may outgrow the executors' memory
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    # rows handed to Python at once; they may hold long texts
    "spark.sql.execution.arrow.maxRecordsPerBatch": "2000",
    # numeric-looking ids in partition folders must stay strings
    "spark.sql.sources.partitionColumnTypeInference.enabled": "false",
}

# Settings only a new session can take. Building a plan in Python is several
# times faster when no call sites are recorded.
START_SETTINGS = {"spark.python.sql.dataFrameDebugging.enabled": "false"}

_folders: dict[str, str] = {}


def prepare(spark: SparkSession) -> SparkSession:
    """Apply the settings to an existing session and return it."""
    for key, value in RUNTIME_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def build_session(
    app_name: str = "marketlake", master: str | None = None, **conf: str
) -> SparkSession:
    """Create (or get) a session with the settings above plus ``conf``."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**RUNTIME_SETTINGS, **START_SETTINGS, **conf}.items():
        builder = builder.config(key.replace("__", "."), value)
    return prepare(builder.getOrCreate())


def _working_folder(spark: SparkSession) -> str:
    """The folder of this application below the shared one; gone when the application ends."""
    context = spark.sparkContext
    known = _folders.get(context.applicationId)
    if known:
        return known
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not re.fullmatch(r"local(\[[^\]]*\])?", context.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        base = tempfile.mkdtemp(prefix="marketlake-", dir="/tmp")
    folder = f"{base.rstrip('/')}/marketlake-{context.applicationId}"
    path = context._jvm.org.apache.hadoop.fs.Path(folder)
    files = path.getFileSystem(context._jsc.hadoopConfiguration())
    files.mkdirs(path)
    files.deleteOnExit(path)
    _folders[context.applicationId] = folder
    return folder


def shared_folder(spark: SparkSession, name: str) -> str:
    """A fresh path under the folder that all executors share.

    The cluster names that folder in ``spark.checkpoint.dir``. Only a local
    session, whose single machine is the whole cluster, may fall back to a
    temporary folder of its own. What is still there when the application
    ends is deleted then.
    """
    return f"{_working_folder(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read again: computed once, for plans that need it more than once."""
    folder = shared_folder(df.sparkSession, name)
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def remove_folder(spark: SparkSession, folder: str) -> None:
    """Delete a table staged in ``shared_folder`` before the application ends."""
    if not folder.startswith(_working_folder(spark)):
        raise ValueError(f"{folder} is not a staged table")
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
