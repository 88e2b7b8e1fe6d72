"""Daily cost per warehouse with running and moving figures."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.types import StructType
from pyspark.sql.window import WindowSpec

from costmart.config import Config
from costmart.functions import exprs as X
from costmart.functions.types import cast_to, schema_of

DAILY_CONTRACT = schema_of(
    usage_date="date",
    warehouse_name="string",
    compute_credits="decimal(38,3)",
    compute_cost="decimal(38,6)",
    cloud_services_cost="decimal(38,6)",
    total_cost="decimal(38,6)",
    idle_cost="decimal(38,6)",
    productive_cost="decimal(38,6)",
    total_queries="decimal(38,0)",
    avg_concurrent_users="decimal(38,2)",
    cost_per_query="decimal(38,6)",
    efficiency_score="decimal(5,2)",
    month_to_date_cost="decimal(38,6)",
    cost_7day_avg="decimal(38,6)",
    day_over_day_change="decimal(38,6)",
    week_over_week_change="decimal(38,6)",
    daily_cost_key="string",
    _loaded_at="timestamp_ntz",
)


def enforce_contract(df: DataFrame, schema: StructType) -> DataFrame:
    """Exactly the contract's columns, in its order and types; a value that does not fit raises."""
    missing = {f.name for f in schema.fields} - set(df.columns)
    if missing:
        raise ValueError(f"contract columns missing: {sorted(missing)}")
    return cast_to(df, schema)


def daily_rollup(hourly: DataFrame) -> DataFrame:
    """Sums per day and warehouse, and the mean of the hourly distinct user counts."""
    return (
        hourly.groupBy("usage_date", "warehouse_name")
        .agg(
            F.sum("total_credits_used").alias("compute_credits"),
            X.money(F.sum("compute_cost_usd")).alias("compute_cost"),
            X.money(F.sum("cloud_services_cost_usd")).alias("cloud_services_cost"),
            X.money(F.sum("total_cost_usd")).alias("total_cost"),
            X.money(F.sum("idle_cost_usd")).alias("idle_cost"),
            F.sum("queries_executed").alias("total_queries"),
            F.sum("unique_users").alias("_users"),
            F.count("unique_users").alias("_hours"),
        )
        .withColumn("avg_concurrent_users", X.exact_div(X.whole(F.col("_users")), X.whole(F.col("_hours")), 2))
        .drop("_users", "_hours")
    )


def daily_efficiency(df: DataFrame) -> DataFrame:
    """Idle capped at compute, productive remainder, cost per statement, 0–100 efficiency score."""
    compute, idle = F.col("compute_cost"), F.col("idle_cost")
    capped = X.strict_least(idle, compute)
    score = X.exact_div((compute - capped) * F.lit(Decimal(100)), compute, 2)
    full = F.lit(Decimal("100.00"))
    return df.select(
        "usage_date",
        "warehouse_name",
        "compute_credits",
        "compute_cost",
        "cloud_services_cost",
        "total_cost",
        X.money(capped).alias("idle_cost"),
        X.money(X.strict_greatest(compute - idle, F.lit(0).cast(X.MONEY))).alias("productive_cost"),
        "total_queries",
        "avg_concurrent_users",
        F.when(F.col("total_queries") > 0, X.exact_div(compute, X.whole(F.col("total_queries")), 6)).alias(
            "cost_per_query"
        ),
        F.when(compute > 0, X.clip(score, Decimal("0.00"), Decimal("100.00")))
        .otherwise(full)
        .cast("decimal(5,2)")
        .alias("efficiency_score"),
    )


# Windows over one warehouse hold one row per calendar day. The month window partitions by the
# warehouse first, so all four run on a single exchange.
def _by_day() -> WindowSpec:
    return W.partitionBy("warehouse_name").orderBy("usage_date")


def month_to_date(cost: Column) -> Column:
    """Running sum in the default range frame: equal dates share the total."""
    month = W.partitionBy("warehouse_name", X.month_of(F.col("usage_date"))).orderBy("usage_date")
    return F.sum(cost).over(month)


def moving_average_7(cost: Column) -> Column:
    """Mean of the last seven rows, not calendar days."""
    last_7 = _by_day().rowsBetween(-6, 0)
    return X.exact_div(X.money(F.sum(cost).over(last_7)), X.whole(F.count(cost).over(last_7)), 6)


def change_from(cost: Column, rows: int) -> Column:
    """Difference to the value `rows` rows earlier; NULL before that."""
    return cost - F.lag(cost, rows).over(_by_day())


def daily_rows(hourly: DataFrame) -> DataFrame:
    return daily_efficiency(daily_rollup(hourly))


def daily_trends(rows: DataFrame, cfg: Config) -> DataFrame:
    """Running and moving figures over one row per warehouse and day, some of which may only be carried."""
    cost = F.col("total_cost")
    carried = "_carried" in rows.columns
    trends = (
        rows.withColumn("cost_7day_avg", moving_average_7(cost))
        .withColumn("day_over_day_change", change_from(cost, 1))
        .withColumn("week_over_week_change", change_from(cost, 7))
        .withColumn("month_to_date_cost", month_to_date(F.col("_month_value") if carried else cost))
        .withColumn("daily_cost_key", X.surrogate_key(F.col("usage_date"), F.col("warehouse_name")))
        .withColumn("_loaded_at", X.load_stamp(cfg))
    )
    return enforce_contract(trends.where("NOT _carried") if carried else trends, DAILY_CONTRACT)


def daily_costs(hourly: DataFrame, cfg: Config) -> DataFrame:
    return daily_trends(daily_rows(hourly), cfg)
