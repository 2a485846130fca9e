"""Row counts and non-null counts from Parquet footers.

Spark can push ``count(*)`` and ``count(column)`` into its Parquet scan, which then
reads the row-group statistics of the footers, file by file on the executors, and no
column data. It does so only for its second reader and behind an option, so the
count runs in a session of its own, which shares the cluster and leaves the caller's
settings alone. The plan is checked for the pushed counts. Where they can't be had
(nested columns, files without null counts, a Spark without the option) the caller
scans the column instead, with the same result.

What footers can't tell: a NaN is a value to Parquet. ``trip_files_profile`` takes NaN
for missing, as the builders do, so its float columns are scanned, and only those.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Sequence

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trip_star.schemas import TRIPS
from trip_star.sources.parquet import LISTING, conform, files_by_schema, prepare_trips, plain_paths

PROFILE = "position int, column_name string, data_type string, non_null_count long"
_ALL = "__all"
_V1 = "spark.sql.sources.useV1SourceList"


def footer_counts(spark: SparkSession, files: Sequence[str], columns: Sequence[str]) -> tuple[int, dict[str, int]] | None:
    """(rows, non-null count per column) of Parquet files of one schema, or None where
    the footers don't tell."""
    beside = spark.newSession()
    v1 = [s for s in beside.conf.get(_V1).split(",") if s.strip() and s.strip() != "parquet"]
    beside.conf.set(_V1, ",".join(v1))
    beside.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    try:
        df = beside.read.options(**LISTING).parquet(*files)
        counted = df.agg(F.count(F.lit(1)).alias(_ALL), *[F.count(F.col(f"`{c}`")).alias(f"c{i}") for i, c in enumerate(columns)])
        if "PushedAggregation: [COUNT(" not in counted._jdf.queryExecution().executedPlan().toString():
            return None
        row = counted.first()
    except (PySparkException, Py4JJavaError):  # no null counts in some footer; a path or schema the reader refuses
        return None
    return row[_ALL] or 0, {c: row[f"c{i}"] or 0 for i, c in enumerate(columns)}  # the sum over no footer is null


def _frame(spark: SparkSession, fields: Sequence[tuple[str, str]], counts: dict[str, int]) -> DataFrame:
    rows = [(i, name, kind, counts.get(name, 0)) for i, (name, kind) in enumerate(fields)]
    return spark.createDataFrame(rows, PROFILE)


def file_profile(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """``column_profile`` of Parquet files of one schema: position, name, type and non-null
    count (NaN is a value), from the footers where they tell, else by a scan."""
    files = [path] if isinstance(path, str) else list(path)
    raw = spark.read.options(**LISTING).parquet(*files)
    flat = [f.name for f in raw.schema.fields if not isinstance(f.dataType, (T.StructType, T.ArrayType, T.MapType, T.VariantType))]
    known = footer_counts(spark, files, flat)
    counts = dict(known[1]) if known else {}
    counts |= _scanned(raw, [c for c in raw.columns if c not in counts])
    return _frame(spark, [(f.name, f.dataType.simpleString()) for f in raw.schema.fields], counts)


def _scanned(df: DataFrame, columns: Sequence[str]) -> dict[str, int]:
    if not columns:
        return {}
    row = df.agg(*[F.count(F.col(f"`{c}`")).alias(f"c{i}") for i, c in enumerate(columns)]).first()
    return {c: row[f"c{i}"] for i, c in enumerate(columns)}


def _counts_alike(source: T.DataType, target: T.DataType) -> bool:
    """Whether a stored value is missing exactly if the typed value is."""
    if isinstance(source, (T.FloatType, T.DoubleType)):
        return False  # NaN
    kinds = (T.IntegralType, (T.DateType, T.TimestampType, T.TimestampNTZType))
    return source == target or any(isinstance(source, kind) and isinstance(target, kind) for kind in kinds)


def trip_files_profile(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """``trips_profile`` of month files: each declared column with its type and how
    many trips have a value (NaN is none; a month without the column has none).

    Files may differ in types: every group of one schema is asked on its own
    (``files_by_schema``). Float columns, and columns whose cast could change what is
    missing, are scanned, nothing else."""
    paths = [path] if isinstance(path, str) else list(path)
    raw = spark.read.options(**LISTING).parquet(*paths)
    groups, merge = files_by_schema(spark, sorted(raw.inputFiles()))
    totals: Counter[str] = Counter()
    for group in groups:
        part = spark.read.option("mergeSchema", merge).parquet(*plain_paths(group))
        stored = {f.name.lower(): f for f in part.schema.fields}
        present = [f for f in TRIPS.fields if f.name.lower() in stored]
        alike = [f.name for f in present if _counts_alike(stored[f.name.lower()].dataType, f.dataType)]
        known = None if merge else footer_counts(spark, plain_paths(group), [stored[n.lower()].name for n in alike])
        counts = {n: known[1][stored[n.lower()].name] for n in alike} if known else {}
        counts |= _scanned(prepare_trips(conform(part)), [f.name for f in present if f.name not in counts])
        totals.update(counts)
    return _frame(spark, [(f.name, f.dataType.simpleString()) for f in TRIPS.fields], totals)


def file_row_count(spark: SparkSession, path: str | Sequence[str]) -> int:
    """Rows of Parquet files, from the footers where they tell."""
    files = [path] if isinstance(path, str) else list(path)
    known = footer_counts(spark, files, [])
    return known[0] if known else spark.read.options(**LISTING).parquet(*files).count()
