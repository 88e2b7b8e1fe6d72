"""Inputs: horizon scans, type conformance, mode switch, read-back helpers.

Horizon filters compare a stored column with a literal, so they reach the parquet scan, and on tables
laid out by date they skip whole directories.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from costmart.config import Config
from costmart.functions import exprs as X
from costmart.functions.types import cast_to
from costmart.operators.ranking import dense_index
from costmart.sources import schemas


def load(spark: SparkSession, location: str, schema: StructType, fmt: str = "parquet") -> DataFrame:
    """Read files (`parquet`, `orc`, `csv` with header, `json`) or a catalog `table`."""
    if fmt == "table":
        return cast_to(spark.table(location), schema)
    reader = spark.read.schema(schema)
    if fmt == "csv":
        reader = reader.option("header", True).option("mode", "FAILFAST")
    return reader.format(fmt).load(location)


# ---- horizon scans ------------------------------------------------------------------------------

def _midnight(cfg: Config, days: int):
    start = datetime.combine(cfg.days_ago(days), datetime.min.time())
    return F.lit(start).cast("timestamp_ntz")


def read_metering(src: DataFrame, cfg: Config) -> DataFrame:
    return src.where(F.col("start_time") >= _midnight(cfg, cfg.metering_history_days))


def read_queries(src: DataFrame, cfg: Config) -> DataFrame:
    return src.where(F.col("start_time") >= _midnight(cfg, cfg.query_history_days))


def read_storage(src: DataFrame, cfg: Config, full: bool = True) -> DataFrame:
    """Only the columns the model needs; the horizon applies to a full build only."""
    rows = src.select(
        "usage_date",
        "database_id",
        "database_name",
        F.col("average_database_bytes").cast("decimal(38,0)").alias("average_database_bytes"),
        F.col("average_failsafe_bytes").cast("decimal(38,0)").alias("average_failsafe_bytes"),
    )
    if full:
        rows = rows.where(F.col("usage_date") >= F.lit(cfg.days_ago(cfg.storage_history_days)))
    return rows


def read_department_map(spark: SparkSession, path: str) -> DataFrame:
    return load(spark, path, schemas.DEPARTMENT_MAP, "csv")


def read_budget(spark: SparkSession, path: str) -> DataFrame:
    return load(spark, path, schemas.BUDGET, "csv")


# ---- conformance of untyped inputs --------------------------------------------------------------

def conform_storage(df: DataFrame) -> DataFrame:
    """Text to typed storage rows; the account-level stage column is not per database, so it goes."""
    return df.select(
        F.col("usage_date").try_cast("date").alias("usage_date"),
        F.col("database_id").cast("bigint").alias("database_id"),
        F.col("database_name").cast("string").alias("database_name"),
        F.col("average_database_bytes").cast("decimal(38,0)").alias("average_database_bytes"),
        F.col("average_failsafe_bytes").cast("decimal(38,0)").alias("average_failsafe_bytes"),
    )


def conform_queries(df: DataFrame) -> DataFrame:
    timestamps = {"start_time", "end_time"}
    return df.select(
        *[
            (X.to_ntz(F.col(f.name)) if f.name in timestamps else F.col(f.name).cast(f.dataType))
            .alias(f.name)
            for f in schemas.QUERIES.fields
        ]
    )


def conform_metering(df: DataFrame, compute_share: str = "0.95") -> DataFrame:
    """Raw meter rows to typed rows: an id per warehouse name and credits split compute / services.

    The id is the name's position among all names in sort order. It is worked out on the distinct
    names, range-partitioned, so no task ever holds the meter rows of the whole account.
    """
    share = F.lit(compute_share).cast("decimal(4,2)")
    rest = F.lit(1).cast("decimal(4,2)") - share
    ids = dense_index(df, "warehouse_name", "warehouse_id")
    typed = df.join(ids, "warehouse_name", "left")
    return typed.select(
        X.to_ntz(F.col("start_time")).alias("start_time"),
        X.to_ntz(F.col("end_time")).alias("end_time"),
        "warehouse_id",
        "warehouse_name",
        F.col("total_credits_used").cast("decimal(18,3)").alias("credits_used"),
        F.round(F.col("total_credits_used") * share, 3).cast("decimal(18,3)").alias("credits_used_compute"),
        F.round(F.col("total_credits_used") * rest, 3)
        .cast("decimal(18,3)")
        .alias("credits_used_cloud_services"),
        F.col("total_cost_usd").cast("decimal(18,2)").alias("total_cost"),
    )


# ---- input selection ----------------------------------------------------------------------------

def load_inputs(spark: SparkSession, mode: str, paths: dict[str, str], fmt: str = "parquet") -> dict[str, DataFrame]:
    """The three telemetry inputs: `live` reads typed tables, `demo` conforms raw text files."""
    if mode == "live":
        return {
            "metering": load(spark, paths["metering"], schemas.METERING, fmt),
            "queries": load(spark, paths["queries"], schemas.QUERIES, fmt),
            "storage": load(spark, paths["storage"], schemas.STORAGE, fmt),
        }
    if mode == "demo":
        return {
            "metering": conform_metering(load(spark, paths["metering"], schemas.RAW_METERING, "csv")),
            "queries": conform_queries(load(spark, paths["queries"], schemas.RAW_QUERIES, "csv")),
            "storage": conform_storage(load(spark, paths["storage"], schemas.RAW_STORAGE, "csv")),
        }
    raise ValueError(f"mode must be 'live' or 'demo', not {mode!r}")


def optional_inputs(
    spark: SparkSession, attribution: str | None = None, clustering: str | None = None, fmt: str = "parquet"
) -> dict[str, DataFrame | None]:
    """Per-query cost estimates and auto-clustering usage; absent inputs stay None."""
    return {
        "attribution": load(spark, attribution, schemas.ATTRIBUTION, fmt) if attribution else None,
        "clustering": load(spark, clustering, schemas.CLUSTERING, fmt) if clustering else None,
    }


def conform_budget(df: DataFrame) -> DataFrame:
    by_name = {c.lower(): c for c in df.columns}
    return df.select(
        F.col(by_name["date"]).try_cast("date").alias("date"),
        F.trim(F.col(by_name["department"])).alias("department"),
        F.coalesce(F.col(by_name["budget_usd"]).try_cast("decimal(18,2)"), F.lit(0).cast("decimal(18,2)"))
        .alias("budget_usd"),
    )


def load_budget(primary: DataFrame | None, fallback: Callable[[], DataFrame]) -> DataFrame:
    """The budget table when it has rows, else the fallback reader."""
    source = primary if primary is not None and not primary.isEmpty() else fallback()
    return conform_budget(source)


def warehouse_settings(df: DataFrame) -> DataFrame:
    """Current settings per warehouse, whatever the case or spelling of the columns."""
    by_name = {c.lower(): c for c in df.columns}
    size = by_name.get("size") or by_name.get("warehouse_size")
    suspend = by_name.get("auto_suspend")
    if suspend is None:
        raise ValueError("settings need an auto_suspend column")
    return df.select(
        F.upper(F.col(by_name["name"])).alias("name"),
        F.col(suspend).try_cast("int").alias("auto_suspend"),
        (F.upper(F.col(size)) if size else F.lit(None).cast("string")).alias("size"),
    )


# ---- read-back ----------------------------------------------------------------------------------

def recent(df: DataFrame, cfg: Config, days: int, column: str = "usage_date") -> DataFrame:
    """The last max(2·days + 7, 14) days: the window, the one before it, and a week of slack."""
    return df.where(F.col(column) >= F.lit(cfg.days_ago(max(days * 2 + 7, 14))))


def normalize(df: DataFrame, numeric: Iterable[str]) -> DataFrame:
    """Lower-case column names; listed columns become double, unreadable values NULL."""
    wanted = {c.lower() for c in numeric}
    return df.select(
        *[
            (F.col(c).try_cast("double") if c.lower() in wanted else F.col(c)).alias(c.lower())
            for c in df.columns
        ]
    )


def has_rows(df: DataFrame) -> bool:
    return not df.isEmpty()


def table_exists(spark: SparkSession, name: str) -> bool:
    return spark.catalog.tableExists(name)
