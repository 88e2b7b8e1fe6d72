"""Total spend per cost category and day."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from costmart.config import Config
from costmart.functions import exprs as X

CREDITS = "decimal(38,4)"
COST = "decimal(38,9)"

def _category(df: DataFrame, name: str, credits, cost) -> DataFrame:
    return (
        df.groupBy("usage_date")
        .agg(credits.cast(CREDITS).alias("credits_used"), cost.cast(COST).alias("cost_usd"))
        .select("usage_date", F.lit(name).alias("cost_category"), "credits_used", "cost_usd")
    )


def category_compute(daily: DataFrame) -> DataFrame:
    return _category(daily, "COMPUTE", F.sum("compute_credits"), F.sum("total_cost"))


def category_storage(storage_daily: DataFrame) -> DataFrame:
    return _category(storage_daily, "STORAGE", F.lit(None), F.sum("estimated_storage_cost_usd"))


def category_clustering(usage: DataFrame, cfg: Config) -> DataFrame:
    by_day = usage.select(X.day_of(F.col("usage_hour")).alias("usage_date"), "credits_used")
    used = F.sum("credits_used")
    return _category(by_day, "AUTO_CLUSTERING", used, used * F.lit(cfg.cost_per_credit))


def positive_costs(df: DataFrame) -> DataFrame:
    """Drop unknown, zero and negative category costs before shares are taken."""
    return df.where(F.col("cost_usd") > 0)


def with_shares(costs: DataFrame) -> DataFrame:
    """Share of the day (one row per category) and month-to-date cost (one row per day)."""
    cost = F.col("cost_usd")
    day = W.partitionBy("usage_date")
    month = (
        W.partitionBy("cost_category", X.month_of(F.col("usage_date")))
        .orderBy("usage_date")
        .rowsBetween(W.unboundedPreceding, 0)
    )
    return costs.select(
        X.surrogate_key(F.col("cost_category"), F.col("usage_date")).alias("total_cost_summary_id"),
        "usage_date",
        "cost_category",
        "credits_used",
        "cost_usd",
        X.exact_div(_nano(cost) * 100, _nano(F.sum(cost).over(day)), 2).alias("pct_of_daily_total"),
        F.sum(cost).over(month).alias("mtd_cost_usd"),
    )


def _nano(cost):
    return (cost * F.lit(10**9).cast("decimal(10,0)")).cast("decimal(28,0)")


def total_cost_summary(daily: DataFrame, storage_daily: DataFrame, cfg: Config, clustering: DataFrame | None = None) -> DataFrame:
    costs = category_compute(daily).unionByName(category_storage(storage_daily))
    if clustering is not None:
        costs = costs.unionByName(category_clustering(clustering, cfg))
    return with_shares(positive_costs(costs))
