"""Warehouse × hour costs: metering joined with query activity, idle detection, unit economics."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from costmart.config import Config
from costmart.functions import exprs as X
from costmart.operators.staging import BYTES_PER_GB

HOUR_KEY = ["warehouse_name", "usage_hour_ntz"]
MS_PER_HOUR = 3_600_000


def query_activity(staged_queries: DataFrame) -> DataFrame:
    """Per warehouse and hour: statements, runtime, volume, distinct users.

    The only step that reads the whole query log. Counts and sums combine before the shuffle; the
    distinct count is planned as (warehouse, hour, user) first, so a busy hour is spread by user.
    Milliseconds and bytes are summed as integers and converted once.
    """
    return (
        staged_queries.groupBy(*HOUR_KEY)
        .agg(
            F.count(F.lit(1)).alias("query_count"),
            F.sum("total_elapsed_ms").alias("_ms"),
            F.sum("bytes_scanned").alias("_bytes"),
            F.countDistinct("user_name").alias("unique_users"),
        )
        .select(
            *HOUR_KEY,
            "query_count",
            seconds(F.col("_ms")).alias("total_runtime_seconds"),
            (F.col("_bytes") / F.lit(float(BYTES_PER_GB))).alias("total_gb_scanned"),
            "unique_users",
        )
    )


# Registers of a distinct sketch, 2 to this power; relative error 1.04 / sqrt(registers), 1.6 %.
SKETCH_LOG = 12
SKETCH_ERROR = 1.04 / 2 ** (SKETCH_LOG / 2)


def activity_sketches(staged_queries: DataFrame) -> DataFrame:
    """Per date, warehouse and hour: statements and a sketch of their users, which merges into any coarser grain."""
    return staged_queries.groupBy("usage_date", *HOUR_KEY).agg(
        F.count(F.lit(1)).alias("query_count"), F.hll_sketch_agg("user_name", SKETCH_LOG).alias("users_sketch")
    )


def activity_from_sketches(sketches: DataFrame, *by: str | Column) -> DataFrame:
    """Statements and estimated distinct users of a coarser grain, by the union of its sketches."""
    return sketches.groupBy(*by).agg(
        F.sum("query_count").alias("query_count"),
        F.hll_sketch_estimate(F.hll_union_agg("users_sketch")).alias("approx_users"),
    )


def within_error(approx: Column, exact: Column, error: float = SKETCH_ERROR) -> Column:
    """Whether an estimate lies within three standard errors, or one, of the exact count."""
    return F.abs(approx - exact) <= F.greatest(F.lit(1.0), exact * F.lit(3 * error))


def seconds(ms: Column) -> Column:
    return (ms.cast("decimal(20,0)") * F.lit(Decimal("0.001"))).cast("decimal(20,3)")


def idle_signal(df: DataFrame) -> DataFrame:
    """Credits burnt in an hour without any statement."""
    idle = (F.coalesce(F.col("queries_executed"), F.lit(0)) == 0) & (F.col("total_credits_used") > 0)
    return df.withColumn("is_potentially_idle", F.coalesce(idle, F.lit(False))).withColumn(
        "idle_cost_usd",
        F.when(F.col("is_potentially_idle"), F.col("compute_cost_usd")).otherwise(F.lit(0).cast(X.MONEY)),
    )


def hourly_efficiency(df: DataFrame) -> DataFrame:
    """Cost per statement and per runtime hour; NULL in hours without activity."""
    runtime_ms = (F.col("total_runtime_seconds") * 1000).cast("decimal(20,0)")
    return df.withColumn(
        "avg_cost_per_query",
        F.when(
            F.col("queries_executed") > 0,
            X.exact_div(F.col("total_cost_usd"), X.whole(F.col("queries_executed")), 6),
        ),
    ).withColumn(
        "cost_per_runtime_hour",
        F.when(
            F.col("total_runtime_seconds") > 0,
            X.exact_div(F.col("total_cost_usd") * F.lit(Decimal(MS_PER_HOUR)), runtime_ms, 6),
        ),
    )


def hourly_costs(staged_metering: DataFrame, staged_queries: DataFrame, cfg: Config) -> DataFrame:
    """Activity is reduced to one row per warehouse-hour before it meets metering of the same grain."""
    activity = query_activity(staged_queries)
    none = F.lit(0)
    joined = staged_metering.drop("idle_cost_usd", "usage_date", "_loaded_at").join(activity, HOUR_KEY, "left")
    base = joined.select(
        "usage_hour_ntz",
        "hour_start",
        "hour_end",
        X.day_of(F.col("usage_hour_ntz")).alias("usage_date"),
        "warehouse_id",
        "warehouse_name",
        "total_credits_used",
        "total_cost_usd",
        "compute_cost_usd",
        "cloud_services_cost_usd",
        F.coalesce("query_count", none).alias("queries_executed"),
        F.coalesce("total_runtime_seconds", none.cast("decimal(20,3)")).alias("total_runtime_seconds"),
        F.coalesce("total_gb_scanned", none.cast("double")).alias("gb_scanned"),
        F.coalesce("unique_users", none).alias("unique_users"),
    )
    return idle_signal(hourly_efficiency(base)).select(
        "*",
        X.surrogate_key(F.col("warehouse_id"), F.col("usage_hour_ntz")).alias("cost_hour_key"),
        X.load_stamp(cfg).alias("_loaded_at"),
    )
