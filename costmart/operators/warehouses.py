"""Warehouse dimension from metering and the query log."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from costmart.functions import exprs as X

# Attributes the telemetry does not carry; typed so that the dimension's schema is stable.
PLACEHOLDERS = {
    "auto_suspend_seconds": "decimal(38,0)",
    "auto_resume": "boolean",
    "min_cluster_count": "decimal(38,0)",
    "max_cluster_count": "decimal(38,0)",
    "is_multi_cluster": "boolean",
    "scaling_policy": "string",
    "owner_role": "string",
    "created_on": "timestamp_ntz",
    "dropped_on": "timestamp_ntz",
}


def last_metered(staged_metering: DataFrame) -> DataFrame:
    return staged_metering.groupBy("warehouse_id", "warehouse_name").agg(
        F.max("usage_hour_ntz").alias("last_metered_at")
    )


def size_uses(staged_queries: DataFrame, *by: str) -> DataFrame:
    """Last use of each size of a warehouse, by date if asked to."""
    return (
        staged_queries.where(F.col("warehouse_size").isNotNull())
        .groupBy(*by, "warehouse_name", X.size_label(F.col("warehouse_size")).alias("warehouse_size"))
        .agg(F.max("end_time").alias("last_use"))
    )


def meter_hours(staged_metering: DataFrame) -> DataFrame:
    """Last metered hour of each warehouse and date."""
    return staged_metering.groupBy("usage_date", "warehouse_id", "warehouse_name").agg(F.max("usage_hour_ntz").alias("usage_hour_ntz"))


def latest_size(staged_queries: DataFrame) -> DataFrame:
    """Size seen last per warehouse: latest hour, then latest end time, then label.

    The log is first reduced to the last use of each (warehouse, size) by a hash aggregation; the
    window then ranks a handful of sizes per warehouse instead of sorting its statements.
    """
    return newest_size(size_uses(staged_queries))


def newest_size(uses: DataFrame) -> DataFrame:
    newest = W.partitionBy("warehouse_name").orderBy(F.desc("last_use"), F.asc("warehouse_size"))
    return (
        uses.withColumn("_n", F.row_number().over(newest))
        .where(F.col("_n") == 1)
        .select("warehouse_name", "warehouse_size")
    )


def dim_warehouse(staged_metering: DataFrame, staged_queries: DataFrame) -> DataFrame:
    return _dimension(last_metered(staged_metering), latest_size(staged_queries))


def dim_from_state(hours_by_date: DataFrame, uses_by_date: DataFrame) -> DataFrame:
    """The dimension from stored maxima per date (`meter_hours`, `size_uses`): no log is read.

    Maxima are kept by date, so that a date whose rows were replaced gives its own anew; a maximum over all
    history could not take back what a merge has removed.
    """
    uses = uses_by_date.groupBy("warehouse_name", "warehouse_size").agg(F.max("last_use").alias("last_use"))
    return _dimension(last_metered(hours_by_date), newest_size(uses))


def _dimension(metered: DataFrame, sizes: DataFrame) -> DataFrame:
    known = metered.join(sizes, "warehouse_name", "left")
    return known.select(
        "warehouse_id",
        "warehouse_name",
        F.lit("STANDARD").alias("warehouse_type"),
        "warehouse_size",
        X.size_credits(F.col("warehouse_size")).alias("warehouse_size_credits_per_hour"),
        *[F.lit(None).cast(t).alias(c) for c, t in PLACEHOLDERS.items()],
        F.lit(True).alias("is_active"),
        "last_metered_at",
    )
