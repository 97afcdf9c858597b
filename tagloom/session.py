"""Session defaults and durable staging of intermediate tables."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

_shipped: set[str] = set()


def build_session(
    app_name: str = "tagloom",
    master: str = "local[8]",
    staging: str | None = None,
    **conf: str,
) -> SparkSession:
    """A session for one machine; on a cluster use the session spark-submit gives.

    ``staging`` becomes ``spark.checkpoint.dir``.
    """
    builder = SparkSession.builder.master(master).appName(app_name)
    defaults = {
        "spark.driver.bindAddress": "127.0.0.1",
        "spark.driver.host": "127.0.0.1",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.sql.shuffle.partitions": "8",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.driver.memory": "8g",
    }
    if staging:
        defaults["spark.checkpoint.dir"] = staging
    for key, value in {**defaults, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def ship_package(spark: SparkSession) -> None:
    """Give the executors this package, once per application.

    Jobs started with ``--py-files`` do not need it.
    """
    app_id = spark.sparkContext.applicationId
    if app_id in _shipped:
        return
    package = Path(__file__).parent
    archive = os.path.join(tempfile.mkdtemp(prefix="run-tagloom-", dir="/tmp"), "tagloom.zip")
    with zipfile.ZipFile(archive, "w") as out:
        for source in sorted(package.rglob("*.py")):
            out.write(source, source.relative_to(package.parent))
    spark.sparkContext.addPyFile(archive)
    _shipped.add(app_id)


def staging_root(spark: SparkSession) -> str:
    """Shared folder for staged tables: ``spark.checkpoint.dir`` of the session.

    With a local master the setting may be missing; the session then gets a fresh folder, once.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("Set spark.checkpoint.dir to a folder that all executors share.")
    spark.conf.set("spark.checkpoint.dir", tempfile.mkdtemp(prefix="run-tagloom-", dir="/tmp"))
    return staging_root(spark)


def _application_root(spark: SparkSession) -> str:
    return f"{staging_root(spark)}/tagloom/{spark.sparkContext.applicationId}"


def staging_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the staging root."""
    return f"{_application_root(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def remove_staged(spark: SparkSession) -> None:
    """Delete what this application has staged, when its results have been written."""
    path = spark._jvm.org.apache.hadoop.fs.Path(_application_root(spark))
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def stage(df: DataFrame, name: str = "stage", partition_by: tuple[str, ...] = ()) -> DataFrame:
    """Write ``df`` as Parquet to the shared folder, in folders by ``partition_by``, and read it back.

    Cuts the lineage in a way that outlives lost executors, and lets every later
    pass read only the columns it needs.
    """
    path = staging_path(df.sparkSession, name)
    df.write.partitionBy(*partition_by).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
