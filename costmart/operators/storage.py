"""Daily storage cost per database."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from costmart.config import Config
from costmart.functions import exprs as X
from costmart.functions.types import schema_of
from costmart.operators.daily import enforce_contract
from costmart.operators.staging import storage_cost, storage_terabytes

STORAGE_CONTRACT = schema_of(
    daily_storage_key="string",
    usage_date="date",
    database_id="decimal(38,0)",
    database_name="string",
    active_storage_tb="decimal(38,6)",
    failsafe_storage_tb="decimal(38,6)",
    stage_storage_tb="decimal(38,6)",
    total_storage_tb="decimal(38,6)",
    estimated_active_cost_usd="decimal(38,9)",
    estimated_failsafe_cost_usd="decimal(38,9)",
    estimated_stage_cost_usd="decimal(38,9)",
    estimated_storage_cost_usd="decimal(38,9)",
    month_to_date_storage_cost="decimal(38,9)",
    storage_cost_30day_avg="decimal(38,9)",
)

def storage_rows(staged: DataFrame) -> DataFrame:
    """Staged rows with their bytes in all."""
    active, failsafe, stage = (F.col(f"avg_{p}_bytes") for p in ("database", "failsafe", "stage"))
    return staged.withColumn("_total", (active + failsafe + stage).cast("decimal(38,0)"))


def storage_trends(rows: DataFrame, cfg: Config) -> DataFrame:
    """Volumes, cost parts, month-to-date cost and 30-row average.

    Running figures add up bytes and price the sum, so nine decimals carry one rounding only.
    """
    active, failsafe, stage = (F.col(f"avg_{p}_bytes") for p in ("database", "failsafe", "stage"))
    total = F.col("_total")
    carried = "_carried" in rows.columns
    # One row per database and calendar day; the month window reuses the database's exchange.
    last_30 = W.partitionBy("database_name").orderBy("usage_date").rowsBetween(-29, 0)
    month = (
        W.partitionBy("database_name", X.month_of(F.col("usage_date")))
        .orderBy("usage_date")
        .rowsBetween(W.unboundedPreceding, 0)
    )
    trends = (
        rows.withColumn("_avg_bytes", F.sum("_total").over(last_30))
        .withColumn("_avg_days", X.whole(F.count("_total").over(last_30)))
        .withColumn("_mtd_bytes", F.sum("_month_value" if carried else "_total").over(month))
        .where(~F.col("_carried") if carried else F.lit(True))
        .select(
            X.surrogate_key(F.col("database_name"), F.col("usage_date")).alias("daily_storage_key"),
            "usage_date",
            "database_id",
            "database_name",
            storage_terabytes(active, 6).alias("active_storage_tb"),
            storage_terabytes(failsafe, 6).alias("failsafe_storage_tb"),
            storage_terabytes(stage, 6).alias("stage_storage_tb"),
            storage_terabytes(total, 6).alias("total_storage_tb"),
            storage_cost(active, cfg, 9).alias("estimated_active_cost_usd"),
            storage_cost(failsafe, cfg, 9).alias("estimated_failsafe_cost_usd"),
            storage_cost(stage, cfg, 9).alias("estimated_stage_cost_usd"),
            storage_cost(total, cfg, 9).alias("estimated_storage_cost_usd"),
            storage_cost(F.col("_mtd_bytes"), cfg, 9).alias("month_to_date_storage_cost"),
            storage_cost(F.col("_avg_bytes"), cfg, 9, days=F.col("_avg_days")).alias("storage_cost_30day_avg"),
        )
    )
    return enforce_contract(trends, STORAGE_CONTRACT)


def daily_storage_costs(staged: DataFrame, cfg: Config) -> DataFrame:
    return storage_trends(storage_rows(staged), cfg)
