"""Staging: rename, bucket, price. All narrow projections over the raw inputs."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from costmart.config import Config
from costmart.functions import exprs as X

BYTES_PER_TB = 2**40
BYTES_PER_GB = 2**30


def stage_metering(df: DataFrame, cfg: Config) -> DataFrame:
    booked = F.col("end_time" if cfg.meter_bucket == "end" else "start_time")
    hour = X.bucket(booked)
    price = F.lit(cfg.cost_per_credit)
    total = X.money(F.col("credits_used") * price)
    return df.select(
        hour.alias("usage_hour_ntz"),
        X.bucket(F.col("start_time")).alias("hour_start"),
        X.bucket(F.col("end_time")).alias("hour_end"),
        X.day_of(booked).alias("usage_date"),
        "warehouse_id",
        "warehouse_name",
        F.col("credits_used").alias("total_credits_used"),
        "credits_used_compute",
        "credits_used_cloud_services",
        X.money(F.col("credits_used_compute") * price).alias("compute_cost_usd"),
        X.money(F.col("credits_used_cloud_services") * price).alias("cloud_services_cost_usd"),
        # Idle cost is unknown before query activity is joined; the column is zero at this layer.
        X.money(total - total).alias("idle_cost_usd"),
        total.alias("total_cost_usd"),
        X.meter_key(F.col("warehouse_id"), hour).alias("metering_id"),
        X.load_stamp(cfg).alias("_loaded_at"),
    )


def filter_compute_queries(df: DataFrame) -> DataFrame:
    """Successful statements that ran on a warehouse."""
    return df.where((F.col("execution_status") == "SUCCESS") & F.col("warehouse_name").isNotNull())


def stage_queries(df: DataFrame, cfg: Config) -> DataFrame:
    kept = filter_compute_queries(df)
    return kept.select(
        "query_id",
        X.bucket(F.col("end_time")).alias("usage_hour_ntz"),
        X.bucket(F.col("start_time")).alias("hour_start_ntz"),
        X.bucket(F.col("end_time")).alias("hour_end_ntz"),
        X.day_of(F.col("end_time")).alias("usage_date"),
        "start_time",
        "end_time",
        "user_name",
        "role_name",
        "warehouse_name",
        "warehouse_size",
        "query_type",
        "database_name",
        "schema_name",
        "execution_status",
        "bytes_scanned",
        "rows_produced",
        F.col("total_elapsed_time").alias("total_elapsed_ms"),
        F.col("execution_time").alias("execution_ms"),
        (F.col("bytes_scanned") / F.lit(float(BYTES_PER_GB))).alias("gb_scanned"),
        (F.col("total_elapsed_time").cast("decimal(18,0)") * F.lit(Decimal("0.001")))
        .cast("decimal(18,3)")
        .alias("total_elapsed_seconds"),
        X.runtime_category(F.col("total_elapsed_time")).alias("runtime_category"),
        X.load_stamp(cfg).alias("_loaded_at"),
    )


def storage_terabytes(num_bytes, k: int):
    return X.exact_div(num_bytes, F.lit(Decimal(BYTES_PER_TB)), k)


def storage_cost(num_bytes, cfg: Config, k: int, days=None):
    """Daily cost of `num_bytes` at the monthly rate per TB, rounded once to k decimals.

    With `days`, the average over that many days of a byte total.
    """
    rate, month = cfg.storage_cost_per_tb_per_month, cfg.days_per_month
    unit = Decimal(10) ** max(-rate.as_tuple().exponent, -month.as_tuple().exponent, 0)
    divisor = F.lit((BYTES_PER_TB * month * unit).quantize(Decimal(1)))
    return X.exact_div(
        num_bytes * F.lit((rate * unit).quantize(Decimal(1))), divisor if days is None else divisor * days, k
    )


def stage_storage(df: DataFrame, cfg: Config) -> DataFrame:
    active = F.col("average_database_bytes")
    failsafe = F.col("average_failsafe_bytes")
    stage = F.lit(0).cast("decimal(38,0)")
    total = (active + failsafe).cast("decimal(38,0)")
    return df.select(
        X.surrogate_key(
            F.coalesce(F.col("database_id").cast("string"), F.col("database_name")), F.col("usage_date")
        ).alias("storage_snapshot_id"),
        F.col("usage_date").cast("date").alias("usage_date"),
        "database_id",
        "database_name",
        active.alias("avg_database_bytes"),
        failsafe.alias("avg_failsafe_bytes"),
        stage.alias("avg_stage_bytes"),
        storage_terabytes(active, 9).alias("avg_database_tb"),
        storage_terabytes(failsafe, 9).alias("avg_failsafe_tb"),
        storage_terabytes(stage, 9).alias("avg_stage_tb"),
        storage_terabytes(total, 9).alias("total_storage_tb"),
        storage_cost(active, cfg, 9).alias("estimated_active_cost_usd"),
        storage_cost(failsafe, cfg, 9).alias("estimated_failsafe_cost_usd"),
        storage_cost(stage, cfg, 9).alias("estimated_stage_cost_usd"),
        storage_cost(total, cfg, 9).alias("estimated_storage_cost_usd"),
    )
