"""Session defaults and the shared working folder."""

from __future__ import annotations

import tempfile
import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Runtime SQL settings every plan of this package relies on.
SQL_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.streaming.schemaInference": "false",
    "spark.sql.mapKeyDedupPolicy": "LAST_WIN",
    # Thousands of folders are listed by so many tasks, not by one task each.
    "spark.sql.sources.parallelPartitionDiscovery.parallelism": "64",
    # Ranks up to this limit are cut before the shuffle (top-k per group, latest per key).
    "spark.sql.optimizer.windowGroupLimitThreshold": "100000",
}


def build_session(app_name: str = "vulnlake", master: str | None = None, **conf: str) -> SparkSession:
    """Get or create a session; `master` stays unset on a cluster, where spark-submit names it."""
    builder = SparkSession.builder.appName(app_name)
    if master is not None:
        builder = builder.master(master)
    for key, value in {**SQL_DEFAULTS, **conf}.items():
        builder = builder.config(key, value)
    return configure(builder.getOrCreate())


def configure(spark: SparkSession) -> SparkSession:
    """Apply the SQL defaults to a session that somebody else created."""
    for key, value in SQL_DEFAULTS.items():
        spark.conf.set(key, value)
    return spark


# Temporary folders of local sessions without a shared folder, by application.
_LOCAL_FOLDERS: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors can reach, as the cluster names it in spark.checkpoint.dir.

    Only a local session without that setting (tests) falls back to a temporary folder.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a shared folder on a cluster")
    if context.applicationId not in _LOCAL_FOLDERS:
        _LOCAL_FOLDERS[context.applicationId] = tempfile.mkdtemp(prefix="vulnlake-")
    return _LOCAL_FOLDERS[context.applicationId]


def rename_files(spark: SparkSession, path: str, ending: str, new_ending: str) -> None:
    """Give the files of a folder that end so another ending."""
    system, place = _place(spark, path)
    for status in system.listStatus(place):
        name = status.getPath().getName()
        if name.endswith(ending):
            system.rename(status.getPath(), spark._jvm.org.apache.hadoop.fs.Path(place, name.removesuffix(ending) + new_ending))


# The folder of the job that runs in this thread, if it has one.
_SCRATCH = threading.local()


@contextmanager
def scratch(spark: SparkSession, name: str) -> Iterator[None]:
    """Intermediate tables of a job whose result is written inside the block: their folder is deleted at its end."""
    outer = getattr(_SCRATCH, "folder", None)
    _SCRATCH.folder = f"{shared_dir(spark)}/vulnlake/{name}-{uuid.uuid4().hex}"
    try:
        yield
    finally:
        delete_dir(spark, _SCRATCH.folder)
        _SCRATCH.folder = outer


def _place(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def delete_dir(spark: SparkSession, path: str) -> None:
    """Delete a folder through Spark's file systems; none is fine."""
    system, place = _place(spark, path)
    system.delete(place, True)


def make_dir(spark: SparkSession, path: str) -> None:
    """A folder that may stay empty, so that it can be read."""
    system, place = _place(spark, path)
    system.mkdirs(place)


def new_dir(spark: SparkSession, name: str) -> str:
    """A path for one run inside the shared folder, or inside the job's scratch folder; never reused."""
    folder = getattr(_SCRATCH, "folder", None) or f"{shared_dir(spark)}/vulnlake"
    return f"{folder}/{name}-{uuid.uuid4().hex}"


def cut_lineage(df, name: str):
    """Write `df` once to the shared folder and read it back.

    The result is stable under executor loss, and every later action reads the same rows.
    """
    path = new_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
