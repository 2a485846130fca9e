"""Table read-back from the catalog: by name (the current version) or pinned."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

CURRENT = "_current"
VERSION, PART = "_version", "_part"


@dataclass(frozen=True)
class Pin:
    """The version of a database that a reader holds on to."""

    version: str
    part: int


def qualified(name: str, database: str | None) -> str:
    return f"{database}.{name}" if database else name


def every_version(name: str) -> str:
    return f"_all_{name}"


def pin(spark: SparkSession, database: str | None = None) -> Pin:
    """The current version, read once; tables read with it belong together
    whatever is committed meanwhile (until its grace is over)."""
    row = spark.table(qualified(CURRENT, database)).select("version", "part").first()
    if row["version"] is None:
        raise ValueError(f"{database or 'the current database'} has no committed version yet")
    return Pin(row["version"], row["part"])


def read_table(spark: SparkSession, name: str, database: str | None = None, at: Pin | None = None) -> DataFrame:
    """A table of the star: of the version ``at``, else of the one that is current when the plan is made."""
    if at is None:
        return spark.table(qualified(name, database))
    every = spark.table(qualified(every_version(name), database))
    return every.filter((F.col(VERSION) == at.version) & (F.col(PART) <= at.part)).drop(VERSION, PART)
