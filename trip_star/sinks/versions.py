"""Whole-star versions behind one pointer.

All tables of a build are written to folders of a new version; nothing that
readers see points there yet. Per table the catalog has

* ``_all_<table>``: every version that is kept, partitioned by version and part;
* ``<table>``: a view on it, whose text never changes: the rows of the version
  (and its parts up to the last one) that the pointer names.

The pointer is a view of one literal row, ``_current``, and a commit is a single
catalog call that alters it. All tables switch in that call: a failure before it
leaves every reader on the old version, after it on the new one. Spark folds the
pointer's row into the views as a literal, so only the current version's folders
are listed and read. ``pin`` reads the pointer once for a reader of several tables.

An append writes one more part of the current version and moves the pointer's
part. Versions that were replaced stay readable for a grace period; after
that, and for leftovers of failed builds, partitions and folders are removed.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from datetime import UTC, datetime, timedelta

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.utils import AnalysisException

from trip_star.sources.tables import CURRENT, PART, VERSION, Pin, every_version, pin, qualified

GRACE = timedelta(days=1)
_TIME = "%Y%m%dT%H%M%S%f"


@dataclass(frozen=True)
class Staged:
    """A table written to its new folder, with the numbers observed while it was written."""

    name: str
    path: str
    schema: T.StructType
    metrics: Mapping[str, int] = field(default_factory=dict)


def catalog(spark: SparkSession, statement: str) -> DataFrame:
    """Every change of the catalog goes through here."""
    return spark.sql(statement)


def new_version() -> str:
    return f"{datetime.now(UTC).strftime(_TIME)}_{uuid.uuid4().hex[:8]}"


def _root(spark: SparkSession, database: str | None) -> str:
    return spark.catalog.getDatabase(database or spark.catalog.currentDatabase()).locationUri.rstrip("/")


def stage(df: DataFrame, name: str, database: str | None, version: str, part: int = 0, **metrics: Column) -> Staged:
    """Write a table's folder for ``version``; rows, columns and ``metrics``
    (aggregates) are observed by the write itself, so nothing is read again."""
    path = f"{_root(df.sparkSession, database)}/_versions/{version}/{name.lower()}/{part:06d}-{uuid.uuid4().hex[:8]}"
    seen = Observation()
    watched = df.observe(seen, F.count(F.lit(1)).alias("n_rows"), *[c.alias(n) for n, c in metrics.items()])
    watched.write.parquet(path)
    return Staged(name, path, df.schema, {**{k: v or 0 for k, v in seen.get.items()}, "n_cols": len(df.columns)})


def _ddl(schema: T.StructType) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)


def _types(schema: T.StructType) -> list[tuple[str, str]]:
    return [(f.name, f.dataType.simpleString()) for f in schema.fields if f.name not in (VERSION, PART)]


def register(spark: SparkSession, staged: Sequence[Staged], database: str | None, version: str, part: int = 0) -> None:
    """Make the staged folders known to the catalog; readers still see the pointer's version."""
    pointer = qualified(CURRENT, database)
    if not spark.catalog.tableExists(pointer):
        catalog(spark, f"CREATE VIEW {pointer} AS {_pointer_row(None, -1, [])}")
    for table in staged:
        name, view = qualified(every_version(table.name), database), qualified(table.name, database)
        if not spark.catalog.tableExists(name):
            catalog(spark, f"CREATE TABLE {name} ({_ddl(table.schema)}, {VERSION} STRING, {PART} INT) USING parquet PARTITIONED BY ({VERSION}, {PART})")
        elif (known := _types(spark.table(name).schema)) != _types(table.schema):
            raise ValueError(f"{view} has the columns {known}, the new version {_types(table.schema)}: build into another database")
        where = f"PARTITION ({VERSION} = '{version}', {PART} = {part})"
        location = table.path.replace("'", "\\'")
        catalog(spark, f"ALTER TABLE {name} DROP IF EXISTS {where}")  # left by an append that failed
        catalog(spark, f"ALTER TABLE {name} ADD {where} LOCATION '{location}'")
        if not spark.catalog.tableExists(view):
            columns = ", ".join(f"`{f.name}`" for f in table.schema.fields)
            current = f"{VERSION} = (SELECT version FROM {pointer}) AND {PART} <= (SELECT part FROM {pointer})"
            catalog(spark, f"CREATE VIEW {view} AS SELECT {columns} FROM {name} WHERE {current}")
        elif _is_plain_table(spark, view):
            raise ValueError(f"{view} is a table of its own, not a view on versions: build into another database")


def _is_plain_table(spark: SparkSession, name: str) -> bool:
    return spark.catalog.getTable(name).tableType != "VIEW"


def _pointer_row(version: str | None, part: int, retired: Sequence[tuple[str, str]]) -> str:
    name = f"'{version}'" if version else "CAST(NULL AS STRING)"
    rows = ", ".join(f"named_struct('version', '{v}', 'since', '{t}')" for v, t in retired)
    past = f"array({rows})" if rows else "CAST(array() AS ARRAY<STRUCT<version: STRING, since: STRING>>)"
    return f"SELECT {name} AS version, {part} AS part, {past} AS retired"


def commit(spark: SparkSession, database: str | None, version: str, part: int = 0, grace: timedelta = GRACE) -> list[str]:
    """Point every reader at ``version`` by one catalog call. Returns the versions
    whose grace is over; they are no longer in the pointer's record."""
    before = spark.table(qualified(CURRENT, database)).first()
    now = datetime.now(UTC)
    retired = [(r["version"], r["since"]) for r in before["retired"]]
    if before["version"] and before["version"] != version:
        retired.append((before["version"], now.strftime(_TIME)))
    kept = [(v, t) for v, t in retired if v != version and now - _when(t) < grace]
    catalog(spark, f"ALTER VIEW {qualified(CURRENT, database)} AS {_pointer_row(version, part, kept)}")
    return [v for v, _ in retired if v not in {k for k, _ in kept} and v != version]


def _when(text: str) -> datetime:
    return datetime.strptime(text[: text.index("_")] if "_" in text else text, _TIME).replace(tzinfo=UTC)


def expire(spark: SparkSession, database: str | None, tables: Sequence[str], grace: timedelta = GRACE) -> list[str]:
    """Remove versions that no pointer names and whose grace is over: replaced ones
    and those of builds that failed. A reader of a kept version never notices."""
    row = spark.table(qualified(CURRENT, database)).first()
    named = {row["version"], *(r["version"] for r in row["retired"])}
    now, gone = datetime.now(UTC), set()
    for table in tables:
        name = qualified(every_version(table), database)
        if not spark.catalog.tableExists(name):
            continue
        versions = {p[0].split("/")[0].split("=", 1)[1] for p in spark.sql(f"SHOW PARTITIONS {name}").collect()}  # a row per kept version and part
        for version in sorted(versions - named):
            if now - _when(version) >= grace:
                catalog(spark, f"ALTER TABLE {name} DROP IF EXISTS PARTITION ({VERSION} = '{version}')")
                gone.add(version)
    for version in gone:
        remove_folder(spark, f"{_root(spark, database)}/_versions/{version}")
    return sorted(gone)


def remove_folder(spark: SparkSession, location: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(location)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def has_version(spark: SparkSession, database: str | None) -> bool:
    try:
        return pin(spark, database) is not None
    except (ValueError, AnalysisException):
        return False


__all__ = ["GRACE", "Pin", "Staged", "catalog", "commit", "expire", "has_version", "new_version", "pin", "register", "remove_folder", "stage"]
