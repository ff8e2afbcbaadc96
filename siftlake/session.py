"""Session settings and the shared scratch folder."""

from __future__ import annotations

import io
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

RUNTIME_SETTINGS = {
    # Instants are stored in UTC; message texts and partition dates rely on it.
    "spark.sql.session.timeZone": "UTC",
    # A repeated JSON key keeps its last value instead of spoiling the document.
    "spark.sql.variant.allowDuplicateKeys": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
}

STREAM_SETTINGS = {
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the settings every operator relies on to an existing session."""
    for key, value in RUNTIME_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def build_session(app_name: str = "siftlake", master: str | None = None, **settings: str) -> SparkSession:
    """A configured session; keyword settings use ``__`` for the dots."""
    builder = SparkSession.builder.appName(app_name)
    if master is not None:
        builder = builder.master(master)
    options = {
        "spark.ui.enabled": "false",
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
        "spark.python.unix.domain.socket.enabled": "true",
        # Recording the Python call site of every expression doubles the time to build a plan.
        "spark.python.sql.dataFrameDebugging.enabled": "false",
        **RUNTIME_SETTINGS,
        **STREAM_SETTINGS,
        **{key.replace("__", "."): value for key, value in settings.items()},
    }
    for key, value in options.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors can reach, named by ``spark.checkpoint.dir``.

    Only a local session may fall back on a folder of its own machine.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    context = spark.sparkContext
    if configured:
        if context.getCheckpointDir() is None:
            context.setCheckpointDir(configured)
        return configured
    if context.getCheckpointDir() is None:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="siftlake-"))
    return context.getCheckpointDir()


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path under the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/siftlake-{label}-{uuid.uuid4().hex}"


def checkpointed(df: DataFrame) -> DataFrame:
    """``df`` written to the shared folder, its lineage cut."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def remove_path(spark: SparkSession, path: str) -> None:
    """Delete a folder this library wrote, on whatever file system it lies."""
    files, target = _hadoop_path(spark, path)
    files.delete(target, True)


def path_exists(spark: SparkSession, path: str) -> bool:
    files, target = _hadoop_path(spark, path)
    return files.exists(target)


def list_folders(spark: SparkSession, path: str) -> list[str]:
    """The folders directly under ``path``; none if it does not exist."""
    files, target = _hadoop_path(spark, path)
    if not files.exists(target):
        return []
    return [entry.getPath().toString() for entry in files.listStatus(target) if entry.isDirectory()]


def _hadoop_path(spark: SparkSession, path: str):
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), target


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Put this package on the path of the session's Python workers, once per application.

    Python tasks refer to its modules by name, and an executor knows those only
    if they are installed there. The archive lies in the shared folder, so an
    executor that joins later, or replaces a lost one, fetches it as well.
    """
    context = spark.sparkContext
    if context.applicationId in _SHIPPED:
        return
    root = Path(__file__).resolve().parent
    sources = sorted(root.rglob("*.py"))
    if sources:  # none if the package itself was imported from an archive, which the executors have then
        packed = io.BytesIO()
        with zipfile.ZipFile(packed, "w", zipfile.ZIP_DEFLATED) as archive:
            for source in sources:
                archive.write(source, str(source.relative_to(root.parent)))
        path = f"{scratch_path(spark, 'code')}/siftlake.zip"
        files, target = _hadoop_path(spark, path)
        stream = files.create(target)
        try:
            stream.write(bytearray(packed.getvalue()))
        finally:
            stream.close()
        context.addPyFile(path)
    _SHIPPED.add(context.applicationId)
