"""CSV source for the zone lookup."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from trip_star.schemas import ZONES

# fixed values: texts that count as missing in a CSV cell
MISSING = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)


def _value(name: str) -> Column:
    return F.when(F.col(name).isin(*MISSING), None).otherwise(F.col(name))


def read_zones_csv(spark: SparkSession, path: str | list[str], columns=ZONES) -> DataFrame:
    """Read header CSV files and keep only the named columns, cast by name.

    A quote inside a quoted field is doubled, quoted fields may hold commas and
    line ends, and the usual missing markers become null. No schema is given to
    the reader: a three-column schema would be applied by position and silently
    misread a wider file. Several files (a lookup has few) are read one by one,
    each by its own header.
    """
    paths = [path] if isinstance(path, str) else list(path)

    def read(files: str | list[str]) -> DataFrame:
        return (
            spark.read.option("header", True).option("quote", '"').option("escape", '"').option("multiLine", True).csv(files)
        )

    def chosen(raw: DataFrame) -> DataFrame:
        missing = [f.name for f in columns.fields if f.name not in raw.columns]
        if missing:
            raise ValueError(f"zone lookup lacks columns {missing}; has {raw.columns}")
        return raw.select(*[_value(f.name).cast(f.dataType).alias(f.name) for f in columns.fields])

    files = read(paths).inputFiles()
    if len(files) <= 1:
        return chosen(read(paths))
    return reduce(DataFrame.unionByName, [chosen(read(f)) for f in sorted(files)])
