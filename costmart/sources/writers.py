"""Sinks. Large tables are laid out by date; the shuffle before the write is a rebalance, which
merges small partitions and splits a date that is much larger than the rest."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from costmart.sources.files import save_schema

INSIGHT_COLUMNS = (
    "scope",
    "name",
    "window_spend_usd",
    "idle_usd_month_est",
    "idle_share_pct",
    "suggested_action",
    "vs_budget_pct",
)


def laid_out(df: DataFrame, partition_by: str | None, sort_by: str | None = None) -> DataFrame:
    """Rows balanced over tasks by date, sorted inside each file where the table is clustered."""
    if not partition_by:
        return df
    if not sort_by:
        return df.hint("rebalance", partition_by)
    return df.hint("rebalance", partition_by, sort_by).sortWithinPartitions(partition_by, sort_by)


def write_table(df: DataFrame, path: str, partition_by: str | None = None, sort_by: str | None = None) -> DataFrame:
    """Full refresh of a mart; returns the stored table."""
    writer = laid_out(df, partition_by, sort_by).write.mode("overwrite")
    (writer.partitionBy(partition_by) if partition_by else writer).parquet(path)
    save_schema(df.sparkSession, path, df.schema)
    return read_table(df.sparkSession, path, df.schema)


def write_clustered(
    df: DataFrame, path: str, partition_by: str = "usage_date", sort_by: str = "warehouse_name"
) -> DataFrame:
    """Date directories, rows sorted inside each file so row-group statistics prune on `sort_by`."""
    return write_table(df, path, partition_by, sort_by)


def read_table(spark: SparkSession, path: str, schema) -> DataFrame:
    return spark.read.schema(schema).parquet(path).select(*[F.col(f.name) for f in schema.fields])


def write_insights_csv(df: DataFrame, path: str) -> None:
    df.select(*INSIGHT_COLUMNS).write.mode("overwrite").option("header", True).csv(path)


# ---- interleaved clustering ---------------------------------------------------------------------

# Ranges per column of an interleaved key, 2 to this power; a date then has 2 to twice the power cells.
RANGE_BITS = 5


def range_starts(df: DataFrame, column: str, ranges: int = 1 << RANGE_BITS) -> list:
    """Where the ranges of a column's different values begin: Spark's own range sampling, `ranges` values at most."""
    values = df.select(column).where(F.col(column).isNotNull()).distinct()
    dealt = values.repartitionByRange(ranges, column).groupBy(F.spark_partition_id().alias("_p")).agg(F.min(column).alias("start"))
    return sorted(r["start"] for r in dealt.collect())[1:]


def interleaved_key(df: DataFrame, first: str, second: str) -> Column:
    """A number whose bits are taken in turn from the ranges of two columns, so that sorting by it keeps both close.

    A file sorted by one column has narrow minima and maxima for that column only; sorted by this key,
    each row group covers a small rectangle of both.
    """
    key = F.lit(0)
    for shift, column in enumerate((second, first)):
        starts = range_starts(df, column)
        literal = F.array(*[F.lit(s) for s in starts]).cast(f"array<{df.schema[column].dataType.simpleString()}>")
        place = F.coalesce(F.size(F.filter(literal, lambda s: s <= F.col(column))), F.lit(0))
        for bit in range(RANGE_BITS):
            key = key.bitwiseOR(F.shiftleft(F.shiftright(place, bit).bitwiseAND(F.lit(1)), 2 * bit + shift))
    return key


def interleaved(df: DataFrame, first: str, second: str, partition_by: str = "usage_date") -> DataFrame:
    """Rows dealt and sorted by date and interleaved key. Rows of a crowded cell are told apart, so it can be split."""
    keyed = df.withColumns({"_cell": interleaved_key(df, first, second), "_tie": F.monotonically_increasing_id()})
    order = [partition_by, "_cell", "_tie"]
    return keyed.repartitionByRange(*order).sortWithinPartitions(*order).drop("_cell", "_tie")


def write_interleaved(
    df: DataFrame, path: str, first: str = "warehouse_name", second: str = "user_name", partition_by: str = "usage_date", row_group_bytes: int | None = None
) -> DataFrame:
    """Date directories whose row groups prune on either of two columns."""
    writer = interleaved(df, first, second, partition_by).write.mode("overwrite")
    if row_group_bytes:
        writer = writer.option("parquet.block.size", row_group_bytes)
    writer.partitionBy(partition_by).parquet(path)
    save_schema(df.sparkSession, path, df.schema)
    return read_table(df.sparkSession, path, df.schema)


def row_groups(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    """(file, row_group, n_rows, column, low, high) from the footers under `path`, one task per file.

    For measuring a layout: a filter `column = x` reads the row groups with low <= x <= high. Spark hands over
    files whole, so give it a date's folder rather than a table of years.
    """

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, content in zip(batch.column(0).to_pylist(), batch.column(1)):
                footer = pq.ParquetFile(pa.BufferReader(content.as_buffer())).metadata
                rows = []
                for n in range(footer.num_row_groups):
                    group = footer.row_group(n)
                    for c in (group.column(i) for i in range(group.num_columns)):
                        if c.path_in_schema in columns and c.statistics is not None and c.statistics.has_min_max:
                            rows.append((name, n, group.num_rows, c.path_in_schema, str(c.statistics.min), str(c.statistics.max)))
                yield pa.RecordBatch.from_pylist([dict(zip(_GROUP_COLUMNS, r)) for r in rows], schema=_GROUPS)

    found = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").option("recursiveFileLookup", "true").load(path)
    return found.select("path", "content").mapInArrow(read, "file string, row_group int, n_rows long, column string, low string, high string")


_GROUP_COLUMNS = ["file", "row_group", "n_rows", "column", "low", "high"]
_GROUPS = pa.schema([("file", pa.string()), ("row_group", pa.int32()), ("n_rows", pa.int64()), ("column", pa.string()), ("low", pa.string()), ("high", pa.string())])


def read_share(groups: DataFrame, column: str, value: str) -> DataFrame:
    """Row groups, and those that a filter `column = value` reads."""
    hit = (F.col("low") <= value) & (F.col("high") >= value)
    return groups.where(F.col("column") == column).agg(F.count(F.lit(1)).alias("row_groups"), F.count(F.when(hit, 1)).alias("read"))
