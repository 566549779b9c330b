"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import SparkSession

ENGINE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.streaming.metricsEnabled": "true",
    # Window state lives off heap and on disk, so it may outgrow executor memory.
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def s3a_conf(
    endpoint: str,
    access_key: str,
    secret_key: str,
    *,
    path_style: bool = True,
    ssl: bool = False,
    max_attempts: int = 3,
    max_connections: int = 200,
) -> dict[str, str]:
    """Object-store settings; pass the result to ``build_session``."""
    prefix = "spark.hadoop.fs.s3a."
    return {
        prefix + "endpoint": endpoint,
        prefix + "access.key": access_key,
        prefix + "secret.key": secret_key,
        prefix + "path.style.access": str(path_style).lower(),
        prefix + "connection.ssl.enabled": str(ssl).lower(),
        prefix + "attempts.maximum": str(max_attempts),
        prefix + "connection.maximum": str(max_connections),
        prefix + "impl": "org.apache.hadoop.fs.s3a.S3AFileSystem",
    }


def build_session(
    app_name: str = "sensorweave",
    master: str | None = None,
    extra: Mapping[str, str] | None = None,
) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**ENGINE_CONF, **(extra or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


_local_folders: dict[str, str] = {}


def shared_folder(spark: SparkSession) -> str:
    """The folder the cluster names for checkpoints and written tables.

    A local session without one (tests) gets its own temporary folder; a
    cluster must name one, because executors do not share local disks.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    application = spark.sparkContext.applicationId
    if application not in _local_folders:
        _local_folders[application] = tempfile.mkdtemp(prefix="sensorweave-")
    return _local_folders[application]


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new path below the shared folder, used by one run only."""
    return f"{application_folder(spark)}/{label}-{uuid.uuid4().hex}"


def application_folder(spark: SparkSession) -> str:
    return f"{shared_folder(spark)}/sensorweave/{spark.sparkContext.applicationId}"


def release_scratch(spark: SparkSession) -> None:
    """Deletes this application's scratch tables; results read from them end with it."""
    delete_path(spark, application_folder(spark))


def path_exists(spark: SparkSession, path: str) -> bool:
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(hadoop)


def delete_path(spark: SparkSession, path: str) -> None:
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(hadoop, True)


def delete_paths(spark: SparkSession, paths: Sequence[str]) -> None:
    """Deletes many folders, several at a time."""
    if paths:
        with ThreadPoolExecutor(min(16, len(paths))) as pool:
            list(pool.map(lambda path: delete_path(spark, path), paths))


def run_together(spark: SparkSession, tasks: Sequence[Callable[[], object]]) -> None:
    """Runs actions that do not depend on each other at the same time. All end before the first error is raised."""
    if tasks:
        with ThreadPoolExecutor(min(8, len(tasks))) as pool:
            running = [pool.submit(inheritable_thread_target(spark)(task)) for task in tasks]
        for task in running:
            task.result()


def list_folders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders directly below ``path``."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    entries = hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).listStatus(hadoop)
    return [entry.getPath().getName() for entry in entries if entry.isDirectory()]


def match_paths(spark: SparkSession, pattern: str) -> list[str]:
    """Paths that match a pattern with ``*`` for any part of a name."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(pattern)
    found = hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(hadoop)
    return [status.getPath().toString() for status in found or []]
