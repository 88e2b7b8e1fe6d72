from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from costmart.llm.frames import ship_package


@pytest.fixture(autouse=True)
def shipped(spark):
    ship_package(spark)


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls, empty and blank texts, repeated rows, ties, a long text and columns with clashing names."""
    rows = [
        (1, "A tidy sentence of words.\nA second line of it.", "en"),
        (1, "A tidy sentence of words.\nA second line of it.", "en"),
        (2, None, None),
        (3, "", "en"),
        (4, " \t\n\x0b", "fr"),
        (None, "no id at all", "en"),
        (None, None, None),
        (5, "word " * 30_000, "en"),
        (6, "Ünïcode straße 字   🎉 Σς", "de"),
        (7, "one", "xx"),
    ]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    clash = {c: F.lit(9) for c in ("code", "root", "score", "kept", "m", "_code", "_key", "_at", "shard", "length", "KEPT_")}
    return df.withColumns(clash)


@pytest.fixture(scope="session")
def none(odd):
    return odd.limit(0)
