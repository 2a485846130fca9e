from __future__ import annotations

import random

import pytest
from pyspark.sql.types import LongType, StringType, StructField, StructType

WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau upsilon".split()


def prose(seed: int, n: int, vocabulary: int = 400) -> str:
    rng = random.Random(seed)
    return " ".join(rng.choice(WORDS) + str(rng.randrange(vocabulary)) for _ in range(n))


def messy_rows() -> list[tuple]:
    """(doc_id, text): nulls, empty and blank texts, ties, repeats, copies, near
    copies, shared passages and lines, a very long text."""
    shared = prose(1, 60)
    base = prose(2, 120)
    line = "This is a boilerplate line that very many documents hold at the end."
    rows = [(0, None), (1, ""), (2, " \n\t "), (3, "one"), (4, base), (5, base), (5, base), (6, base + " tail"), (7, "x " + base)]
    rows += [(10 + i, f"{prose(20 + i, 50)}\n{line}\n{shared} {prose(50 + i, 30)}\n  {line.upper()}  ") for i in range(8)]
    rows += [(30, prose(90, 30_000, 100_000) + "\n" + line + " " + shared), (31, "again " * 500), (32, "ÄÖÜ éèà — 日本語 \U0001f600 " * 30)]
    rows += [(None, base), (None, None), (None, prose(91, 80)), (40, "   " + prose(92, 25) + "\n\n"), (41, prose(92, 25)), (-5, shared)]
    return rows


@pytest.fixture(scope="session")
def messy(spark):
    """The messy rows with further columns, some named like internal and result columns."""
    rows = messy_rows()
    schema = StructType(
        [
            StructField("doc_id", LongType()),
            StructField("text", StringType()),
            *(StructField(c, StringType()) for c in ("id", "key", "fp", "n_words", "count", "pos", "score", "length", "part")),
        ]
    )
    return spark.createDataFrame([(*r, *["clash"] * 9) for r in rows], schema).repartition(5)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], "doc_id long, text string")
