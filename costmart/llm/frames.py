"""Helpers the operators share: reading tables, working column names, gapless numbering."""

from __future__ import annotations

import os
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from costmart.session import stage_table


# Rows in an Arrow batch: whole texts are long, and two batches are held at a time.
BATCH_ROWS = 1000


def ship_package(spark: SparkSession) -> None:
    """Send this package to the executors unless their Python finds it by the path they inherit.

    Arrow batches are made smaller where the session leaves their size at Spark's default.
    """
    if spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch") == "10000":
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    root = Path(__file__).resolve().parents[2]
    known = [os.getcwd(), *os.environ.get("PYTHONPATH", "").split(os.pathsep)]
    if str(root) in {os.path.realpath(p) for p in known if p} or getattr(spark, "_costmart_shipped", False):
        return
    target = Path(tempfile.mkdtemp(prefix="costmart-code-")) / "costmart.zip"
    with zipfile.ZipFile(target, "w") as packed:
        for file in sorted((root / "costmart").rglob("*.py")):
            packed.write(file, file.relative_to(root))
    spark.sparkContext.addPyFile(str(target))
    spark._costmart_shipped = True


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spare(df: DataFrame, *names: str) -> list[str]:
    """Working column names that no column of df has, whatever its case."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def text_or_empty(name: str = "text") -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def numbered(rows: DataFrame, group: str, order: list[str], name: str) -> DataFrame:
    """Add a gapless number from 0 within each group, in the given order, rows of a hot group included.

    Rows are dealt by range over (group, order, row), so a group of any size is spread over as many tasks
    as it needs and equal rows can be dealt apart. The sorted rows are stored with their place; one
    small row per (partition, group) then carries the offset. `rows` must be narrow and stored, and
    `group` must not be NULL: it is read twice, once for the sample of the ranges.
    """
    at, first, before = spare(rows, "_at", "_first", "_before")
    keys = [group, *order, at]
    dealt = (
        rows.withColumn(at, F.monotonically_increasing_id())
        .repartitionByRange(*keys)
        .sortWithinPartitions(*keys)
        .withColumn(at, F.monotonically_increasing_id())
    )
    dealt = stage_table(dealt, "numbered")
    part = F.shiftright(F.col(at), 33)
    spans = dealt.groupBy(F.col(group), part.alias("_part")).agg(F.min(at).alias(first), F.count("*").alias("_rows"))
    earlier = Window.partitionBy(group).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    spans = spans.select(
        F.col(group).alias("_group"),
        "_part",
        first,
        F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias(before),
    )
    return (
        dealt.join(spans, (dealt[group] == spans["_group"]) & (F.shiftright(dealt[at], 33) == spans["_part"]))
        .withColumn(name, F.col(before) + F.col(at) - F.col(first))
        .drop(at, first, before, "_group", "_part")
    )
