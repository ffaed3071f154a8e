"""Session settings and tables written between stages."""

from __future__ import annotations

import atexit
import re
import time
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_SETTING = "spark.checkpoint.dir"

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
}


def build_session(app_name: str, **extra: str) -> SparkSession:
    """A session with the library's defaults; master and sizes come from spark-submit."""
    builder = SparkSession.builder.appName(app_name)
    for key, value in {**DEFAULTS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def use_utc(spark: SparkSession) -> None:
    """Read zone-less event times as UTC, whatever the session was started with."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder the cluster names; without one, a folder in the warehouse.

    A warehouse in a folder of one machine will do only where there is no other machine.
    """
    root = spark.conf.get(CHECKPOINT_SETTING, None)
    if not root:
        warehouse = spark.conf.get("spark.sql.warehouse.dir")
        alone = re.match(r"local($|\[)", spark.sparkContext.master)
        if not alone and (warehouse.startswith("file:") or "://" not in warehouse):
            raise RuntimeError(f"{CHECKPOINT_SETTING} must name a folder that all machines share")
        root = f"{warehouse.rstrip('/')}/scratch"
    return root


def written(df: DataFrame, label: str, **options: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back. ``options`` go to the writer.

    Later plans start from the stored files, so they neither repeat the work above nor
    depend on executors staying alive. The table lasts until ``discard`` or the end of the
    application.
    """
    spark = df.sparkSession
    path = f"{_own_folder(spark)}/{label}-{uuid.uuid4().hex}"
    df.write.options(**options).parquet(path)
    for log in _logs:
        log.append(path)
    table = spark.read.schema(df.schema).parquet(path)
    table._stored_at = path
    return table


def discard(*tables: DataFrame) -> None:
    """Delete tables made by ``written`` that nothing will read any more."""
    for table in tables:
        path = getattr(table, "_stored_at", None)
        if path:
            _delete(table.sparkSession, path)


def free_shuffles(spark: SparkSession) -> None:
    """Lets Spark delete the shuffle files of finished work, which it does once the driver's heap is collected."""
    spark.sparkContext._jvm.System.gc()


@contextmanager
def recorded() -> Iterator[list[str]]:
    """The paths of all tables written meanwhile."""
    log: list[str] = []
    _logs.append(log)
    try:
        yield log
    finally:
        _logs.remove(log)


def delete_tables(spark: SparkSession, paths: list[str]) -> None:
    for path in paths:
        _delete(spark, path)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Deletes all tables written meanwhile; for work whose results are stored elsewhere at the end."""
    with recorded() as paths:
        try:
            yield
        finally:
            delete_tables(spark, paths)


_logs: list[list[str]] = []
_folders: set[str] = set()


def _own_folder(spark: SparkSession) -> str:
    """This application's part of the shared folder, which goes when the application ends."""
    folder = f"{checkpoint_root(spark).rstrip('/')}/tidewheel-{spark.sparkContext.applicationId}"
    if folder not in _folders:
        _folders.add(folder)
        atexit.register(_at_end, spark, folder)
    return folder


def _delete(spark: SparkSession, path: str) -> None:
    jvm = spark.sparkContext._jvm
    place = jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)


def delete_left_over(spark: SparkSession, hours: float = 24 * 7) -> int:
    """Deletes the folders of other applications in which nothing has been written for so long.

    An application deletes its own at the end, unless its session was stopped before or it was killed.
    Returns how many there were.
    """
    root = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(checkpoint_root(spark))
    files = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    own, before, gone = _own_folder(spark).rsplit("/", 1)[-1], (time.time() - hours * 3600) * 1000, 0
    for status in files.listStatus(root) if files.exists(root) else []:
        folder = status.getPath()
        # A table that is added or deleted changes the folder's time.
        if folder.getName().startswith("tidewheel-") and folder.getName() != own and status.getModificationTime() < before:
            files.delete(folder, True)
            gone += 1
    return gone


def _at_end(spark: SparkSession, folder: str) -> None:
    # A session that was stopped has left its tables to ``delete_left_over``.
    if spark.sparkContext._jsc is not None:
        _delete(spark, folder)
