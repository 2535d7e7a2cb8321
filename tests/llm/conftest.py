from __future__ import annotations

import random

import pytest

#: Names that the operators use inside, as extra columns of the input.
CLASHES = ["block", "part", "_n", "_weights", "_taken", "size", "rank", "band", "key", "rep", "a", "b", "codes", "id", "label", "quality_"]


@pytest.fixture
def documents(spark):
    """A documents table of (doc_id, text[, source]) rows, with extra columns whose names clash."""

    def build(rows, extra=True):
        schema = "doc_id long, text string, lang string, source string, n_chars long"
        data = [(r[0], r[1], "en", r[2] if len(r) > 2 else "s", None if r[1] is None else len(r[1])) for r in rows]
        frame = spark.createDataFrame(data, schema)
        if extra:
            from pyspark.sql import functions as F

            frame = frame.withColumns({c: F.lit("x") for c in CLASHES})
        return frame

    return build


def words(random_: random.Random, n: int, vocabulary: int = 400) -> list[str]:
    return [f"w{random_.randrange(vocabulary)}" for _ in range(n)]


@pytest.fixture
def prose():
    return words
