"""Session helpers: settings, shipping the package, shared work folder."""

from __future__ import annotations

import os
import shutil
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

# Settings a cluster session should have; partition counts are left to AQE.
RECOMMENDED_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Call-site capture costs several driver round trips per Column.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def local_session(cpus: int | str = "*", app: str = "tripweave", **conf: str) -> SparkSession:
    """Local session for tests and benchmarks."""
    builder = SparkSession.builder.master(f"local[{cpus}]").appName(app)
    settings = {
        **RECOMMENDED_CONF,
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.sql.shuffle.partitions": "8",
        "spark.driver.memory": "8g",
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    session = builder.getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    ship_package(session)
    return session


_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make this package importable in Python workers (like ``--py-files``).

    Spark copies the archive to every executor.
    """
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    package = os.path.dirname(os.path.abspath(__file__))
    folder = tempfile.mkdtemp(prefix="tripweave-")
    archive = shutil.make_archive(
        os.path.join(folder, "tripweave_pkg"),
        "zip",
        root_dir=os.path.dirname(package),
        base_dir=os.path.basename(package),
    )
    spark.sparkContext.addPyFile(archive)
    _shipped.add(app)


def work_root(spark: SparkSession) -> str:
    """This application's folder below the shared ``spark.checkpoint.dir``; where unset, below the warehouse."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    base = base or spark.conf.get("spark.sql.warehouse.dir")
    return f"{base.rstrip('/')}/tripweave-{spark.sparkContext.applicationId}"


_scope: ContextVar[str] = ContextVar("work scope", default="")


def work_folder(spark: SparkSession, purpose: str) -> str:
    """Path of a new folder that all executors share."""
    return f"{work_root(spark)}/{_scope.get()}{purpose}-{uuid.uuid4().hex[:12]}"


@contextmanager
def work_scope(spark: SparkSession, purpose: str) -> Iterator[None]:
    """Steps saved inside, by this thread, are deleted at the end; what is to stay is written elsewhere before."""
    outer = _scope.get()
    own = f"{outer}{purpose}-{uuid.uuid4().hex[:12]}/"
    token = _scope.set(own)
    try:
        yield
    finally:
        _scope.reset(token)
        delete_folder(spark, f"{work_root(spark)}/{own}")


def saved(rows: DataFrame, purpose: str) -> DataFrame:
    """Rows written once to the shared work folder and read back.

    Used after expensive steps, so that neither a second action nor a lost
    executor repeats them.
    """
    path = work_folder(rows.sparkSession, purpose)
    rows.write.parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


def delete_folder(spark: SparkSession, folder: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def clear_work(spark: SparkSession) -> None:
    """Deletes what this application saved below ``work_root``; call it when no result is read any more."""
    delete_folder(spark, work_root(spark))
