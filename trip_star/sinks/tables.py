"""Warehouse sink: full-refresh loads, the numbers observed by them, and the load report."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trip_star.sinks import versions
from trip_star.sinks.versions import Staged
from trip_star.sources.tables import Pin, pin, qualified, read_table

METRICS = "load_metrics"
FILES = "loaded_files"  # the input files of a version, not one of its tables
METRICS_SCHEMA = "table_name string, metric string, value long"


def ensure_database(spark: SparkSession, database: str | None) -> None:
    if database:
        versions.catalog(spark, f"CREATE DATABASE IF NOT EXISTS {database}")


def write_table(
    df: DataFrame,
    name: str,
    database: str | None = None,
    fmt: str = "parquet",
    partition_by: Sequence[str] = (),
) -> str:
    """Create if missing, else truncate and replace (``WRITE_TRUNCATE``) one table that stands alone.

    The write action blocks until the load is committed, so no separate wait.
    Tables live at ``<database folder>/<name>`` with that path given
    explicitly, so the overwrite replaces whatever is there, including files an
    earlier session with a non-persistent catalog left behind.
    """
    spark = df.sparkSession
    target = qualified(name, database)
    db = database or spark.catalog.currentDatabase()
    root = spark.catalog.getDatabase(db).locationUri.rstrip("/")
    writer = df.write.mode("overwrite").format(fmt).option("path", f"{root}/{name.lower()}")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.saveAsTable(target)
    return target


def publish(
    spark: SparkSession,
    staged: Sequence[Staged],
    database: str | None,
    version: str,
    part: int = 0,
    extra: Mapping[str, Mapping[str, int]] | None = None,
    grace: timedelta = versions.GRACE,
) -> None:
    """Commit the staged tables as one version, with the numbers observed while
    they were written (and ``extra`` ones, by table) as its table ``load_metrics``."""
    numbers = {**{t.name: t.metrics for t in staged}, **(extra or {})}
    rows = [(name, metric, int(value)) for name, metrics in numbers.items() for metric, value in metrics.items()]
    metrics = versions.stage(spark.createDataFrame(rows, METRICS_SCHEMA).coalesce(1), METRICS, database, version, part)
    tables = [*staged, metrics]
    versions.register(spark, tables, database, version, part)
    versions.commit(spark, database, version, part, grace)
    versions.expire(spark, database, [t.name for t in tables], grace)


def load_metrics(spark: SparkSession, database: str | None = None, at: Pin | None = None) -> DataFrame:
    """(table_name, metric, value) of a version: parts add up, columns do not."""
    parts = read_table(spark, METRICS, database, at or pin(spark, database))
    value = F.when(F.col("metric") == "n_cols", F.max("value")).otherwise(F.sum("value"))
    return parts.groupBy("table_name", "metric").agg(value.alias("value"))


def load_report(spark: SparkSession, database: str | None = None, at: Pin | None = None) -> DataFrame:
    """One row per table: rows and columns loaded, as observed by the writes."""
    metrics = load_metrics(spark, database, at)
    pick = lambda name: F.max(F.when(F.col("metric") == name, F.col("value")))
    rows = metrics.groupBy("table_name").agg(pick("n_rows").alias("n_rows"), pick("n_cols").cast("int").alias("n_cols"))
    return rows.filter(F.col("n_cols").isNotNull() & (F.col("table_name") != FILES))
