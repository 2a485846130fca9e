"""Parquet sources: the trips scan, the row position and the positional head slice."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from urllib.parse import unquote

import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trip_star.functions.casts import cast_timestamps_if_present, nan_to_null, normalise_float_keys
from trip_star.schemas import FLOAT_COLUMNS, ROW_POS, TIMESTAMP_COLUMNS, TRIPS

# Rows of a head slice that one task may hand on.
EARLY_STOP_ROWS = 1_000_000

# One listing rule for batch reads and for the stream that waits for files.
LISTING = {"recursiveFileLookup": "true", "pathGlobFilter": "*.parquet"}


def file_offsets(df: DataFrame) -> dict[str, int]:
    """Input position of the first row of every file, in path order.

    One job over metadata only (no column is read); the result has a row per
    file, as the driver's own listing has."""
    per_file = df.select(F.col("_metadata.file_path").alias("f")).groupBy("f").agg(F.count(F.lit(1)).alias("n"))
    offsets, total = {}, 0
    for path, n in sorted(tuple(r) for r in per_file.collect()):
        offsets[path] = total
        total += n
    return offsets


def with_row_pos(df: DataFrame, col: str = ROW_POS, offsets: dict[str, int] | None = None) -> DataFrame:
    """Add the 0-based input position of every row.

    ``df`` must be a file scan straight from ``spark.read`` (the hidden
    ``_metadata`` column is needed). Position = the row's index inside its file
    plus the row count of all files whose path sorts before it. Several files
    take their offset from a broadcast of 16 bytes per file (hash of the path,
    offset), so rows are never shuffled; one file needs none.
    """
    row_index = F.col("_metadata.row_index")
    if offsets is None:
        offsets = file_offsets(df) if len(df.inputFiles()) > 1 else {}
    if len(offsets) <= 1 and not any(offsets.values()):
        return df.withColumn(col, row_index)
    spark = df.sparkSession
    table = spark.createDataFrame(list(offsets.items()), "f string, __offset long").select(
        F.xxhash64("f").alias("__file"), "__offset"
    )
    if table.select("__file").distinct().count() < len(offsets):
        raise ValueError("two file paths have the same hash")
    tagged = df.withColumns({"__file": F.xxhash64(F.col("_metadata.file_path")), "__index": row_index})
    return (
        tagged.join(F.broadcast(table), "__file", "left")
        .withColumn(col, (F.col("__offset") + F.col("__index")).cast("long"))
        .drop("__file", "__index", "__offset")
    )


def _cast(name: str, source: T.DataType, target: T.DataType, alias: str) -> Column:
    col = F.col(name)
    if isinstance(source, (T.FloatType, T.DoubleType)) and isinstance(target, T.IntegralType):
        col = nan_to_null(col)  # some months store counts as doubles with NaN
        wrong = F.raise_error(F.concat(F.lit(f"{name} holds a fraction: "), col.cast("string")))
        col = F.when(col != F.floor(col), wrong).otherwise(col)
    return col.cast(target).alias(alias)


def conform(df: DataFrame, schema=TRIPS, keep: tuple[str, ...] = (ROW_POS,)) -> DataFrame:
    """Select the declared columns that are present, by name (in any case), cast to
    their types. A count stored as a fraction is an error, not a rounded value."""
    found = {f.name.lower(): f for f in df.schema.fields}
    cols = [F.col(k) for k in keep if k in df.columns]
    for f in schema.fields:
        if source := found.get(f.name.lower()):
            cols.append(_cast(source.name, source.dataType, f.dataType, f.name))
    return df.select(*cols)


def prepare_trips(df: DataFrame) -> DataFrame:
    """Trips as the builders consume them: timestamps parsed (only if present),
    NaN folded into null in the float columns."""
    df = cast_timestamps_if_present(df, TIMESTAMP_COLUMNS)
    return normalise_float_keys(df, FLOAT_COLUMNS)


def _footer_reader():
    """(path) -> (path, schema text) from the file's footer; null where a task can't open the path."""

    def schema(path: str) -> str | None:
        try:
            uri = path.replace("s3a://", "s3://", 1)
            if uri.startswith(("file:", "/")):
                source, name = fs.LocalFileSystem(), "/" + uri.removeprefix("file:").lstrip("/")
            else:
                source, name = fs.FileSystem.from_uri(uri)
            with source.open_input_file(unquote(name)) as f:
                return pq.read_schema(f).remove_metadata().to_string(show_field_metadata=False, show_schema_metadata=False)
        except (OSError, ValueError, ImportError):
            return None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = pa.array([schema(p) for p in batch.column(0).to_pylist()], pa.string())
            yield pa.RecordBatch.from_arrays([batch.column(0), found], names=["path", "schema"])

    return run


def plain_paths(files: list[str]) -> list[str]:
    """Paths as readers take them; the listing gives them as URIs."""
    return [unquote(f) for f in files]


def _groups_by_merging(spark: SparkSession, files: list[str]) -> list[list[str]]:
    """Groups of files whose schemas Spark can merge. Each try is one job over all
    footers of a run of files; a run that can't be merged is halved, so files in
    path order that change types now and then take a few tries each time."""
    try:
        spark.read.option("mergeSchema", True).parquet(*plain_paths(files))
        return [files]
    except (PySparkException, Py4JJavaError) as e:
        if len(files) == 1 or "CANNOT_MERGE" not in str(e):
            raise
    half = len(files) // 2
    return _groups_by_merging(spark, files[:half]) + _groups_by_merging(spark, files[half:])


def files_by_schema(spark: SparkSession, files: list[str]) -> tuple[list[list[str]], bool]:
    """The files grouped by their own schema (months differ in physical types), and
    whether the files of a group may still lack columns of one another.

    One job: the paths are a table, dealt over the cluster, and each task reads the
    footers of its files. Where the tasks can't open the paths (a store that only
    Spark's readers know), Spark merges schemas instead (``_groups_by_merging``).
    """
    table = spark.createDataFrame([(f,) for f in files], "path string")  # dealt over the default parallelism
    found = dict(map(tuple, table.mapInArrow(_footer_reader(), "path string, schema string").collect()))  # a row per file, as the listing
    if None in found.values():
        return _groups_by_merging(spark, files), True
    groups: dict[str, list[str]] = {}
    for f in files:
        groups.setdefault(found[f], []).append(f)
    return list(groups.values()), False


def read_trips(
    spark: SparkSession, path: str | list[str], position: bool = True, head_rows: int | None = None, first_pos: int = 0
) -> DataFrame:
    """Scan trip parquet files (also in subfolders): declared columns, typed, with
    ``row_pos``. Files whose physical types differ are read as groups of one
    schema each, found by one job (``files_by_schema``). Positions start at
    ``first_pos``. With ``head_rows`` only the leading files that hold the first
    rows in input order are scanned."""
    paths = [path] if isinstance(path, str) else list(path)
    raw = spark.read.options(**LISTING).parquet(*paths)
    files = sorted(raw.inputFiles())
    if len(files) <= 1:
        out = prepare_trips(conform(with_row_pos(raw) if position or head_rows is not None else raw))
    else:
        offsets = file_offsets(raw) if position or head_rows is not None else {}
        if head_rows is not None:
            leading = {p for p, first in offsets.items() if first < head_rows}
            files = sorted(leading)
        parts = []
        groups, merge = files_by_schema(spark, files)
        for group in groups:
            part = spark.read.option("mergeSchema", merge).parquet(*plain_paths(group))
            parts.append(prepare_trips(conform(with_row_pos(part, offsets=offsets) if offsets else part)))
        out = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    if head_rows is not None:
        out = head_slice(out, head_rows)
    if first_pos and ROW_POS in out.columns:
        out = out.withColumn(ROW_POS, F.col(ROW_POS) + F.lit(first_pos))
    return out if position else out.drop(ROW_POS)


def head_slice(df: DataFrame, n: int, pos_col: str = ROW_POS) -> DataFrame:
    """The first ``n`` rows in input order (``iloc[:n]``): a position filter,
    deterministic, unlike ``limit(n)`` alone.

    Up to ``EARLY_STOP_ROWS`` rows, the filter is followed by a limit that can't cut
    any of its rows (positions are unique), but lets a task stop reading its split
    at the n-th of them: a file of one split is read up to there. The rows pass
    through one task then, which is why more rows are only filtered.
    """
    head = df.filter(F.col(pos_col) < F.lit(n))
    return head.limit(n) if 0 <= n <= EARLY_STOP_ROWS else head


def preview(df: DataFrame, n: int = 5, pos_col: str = ROW_POS) -> DataFrame:
    """``head()``: the first rows in input order."""
    return head_slice(df, n, pos_col).orderBy(pos_col)
