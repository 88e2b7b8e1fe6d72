"""Forecast per warehouse: mean + trend, day-of-week seasonality, widening band."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from costmart.config import Config
from costmart.functions import exprs as X

MIN_OBSERVATION_DAYS = 7
METHOD = "rolling_avg_linear_trend"


def _mean(value: Column, condition: Column | None = None) -> Column:
    """Mean from an exact sum, so it does not depend on the order of addition."""
    chosen = value if condition is None else F.when(condition, value)
    return F.try_divide(F.sum(chosen).cast("double"), F.count(chosen).cast("double"))


def _profile(daily: DataFrame, cfg: Config) -> DataFrame:
    """Everything the forecast needs from the actuals in one pass and one shuffle of partial sums:
    baseline statistics plus the mean per day of week as an array indexed by `dow`."""
    day, cost = F.col("usage_date"), F.col("total_cost")
    recent = day >= F.lit(cfg.days_ago(7))
    before = day.between(F.lit(cfg.days_ago(14)), F.lit(cfg.days_ago(8)))
    return (
        daily.where(day >= F.lit(cfg.days_ago(cfg.forecast_lookback_days)))
        .groupBy("warehouse_name")
        .agg(
            _mean(cost).alias("avg_daily_cost"),
            F.stddev_samp(cost.cast("double")).alias("stddev_daily_cost"),
            F.count(F.lit(1)).alias("observation_days"),
            _mean(cost, recent).alias("last_7d_avg"),
            _mean(cost, before).alias("prev_7d_avg"),
            F.array(*[_mean(cost, X.dow(day) == n) for n in range(1, 8)]).alias("_dow_avg"),
        )
        .where(F.col("observation_days") >= MIN_OBSERVATION_DAYS)
        .withColumn("trend_slope_per_day", (F.col("last_7d_avg") - F.col("prev_7d_avg")) / F.lit(7.0))
    )


# ---- mergeable moments --------------------------------------------------------------------------
# Integers of a millionth of a dollar, so that sums of squares are exact and merge in any order.

def cost_moments(daily: DataFrame) -> DataFrame:
    """Per date and warehouse: number, sum and sum of squares of costs, in millionths."""
    micros = (F.col("total_cost") * F.lit(1_000_000)).cast("decimal(19,0)")
    return daily.groupBy("usage_date", "warehouse_name").agg(
        F.count(F.lit(1)).alias("days"),
        F.count("total_cost").alias("n"),
        F.sum(micros).cast("decimal(38,0)").alias("s"),
        F.sum(micros * micros).cast("decimal(38,0)").alias("s2"),
    )


def profile_from_moments(moments: DataFrame, cfg: Config) -> DataFrame:
    """What `_profile` gives, by adding up moments; the deviation is taken once, of exact sums."""
    day = F.col("usage_date")
    recent = day >= F.lit(cfg.days_ago(7))
    before = day.between(F.lit(cfg.days_ago(14)), F.lit(cfg.days_ago(8)))

    def mean(condition: Column | None = None) -> Column:
        s, n = (F.col(c) if condition is None else F.when(condition, F.col(c)) for c in ("s", "n"))
        return F.try_divide(F.sum(s).cast("double") / F.lit(1e6), F.sum(n).cast("double"))

    n, s = F.sum("n").cast("decimal(10,0)"), F.sum("s").cast("decimal(28,0)")
    spread = (n * F.sum("s2").cast("decimal(38,0)")).cast("decimal(38,0)") - (s * s).cast("decimal(38,0)")
    pairs = (n * (n - F.lit(1))).cast("double")
    return (
        moments.where(day >= F.lit(cfg.days_ago(cfg.forecast_lookback_days)))
        .groupBy("warehouse_name")
        .agg(
            mean().alias("avg_daily_cost"),
            (F.sqrt(F.try_divide(spread.cast("double"), pairs)) / F.lit(1e6)).alias("stddev_daily_cost"),
            F.sum("days").alias("observation_days"),
            mean(recent).alias("last_7d_avg"),
            mean(before).alias("prev_7d_avg"),
            F.array(*[mean(X.dow(day) == k) for k in range(1, 8)]).alias("_dow_avg"),
        )
        .where(F.col("observation_days") >= MIN_OBSERVATION_DAYS)
        .withColumn("trend_slope_per_day", (F.col("last_7d_avg") - F.col("prev_7d_avg")) / F.lit(7.0))
    )


def forecast_baseline(daily: DataFrame, cfg: Config) -> DataFrame:
    """Warehouses with at least seven observed days, and their statistics."""
    return _profile(daily, cfg).drop("_dow_avg")


def _factor(dow_avg: Column) -> Column:
    return F.try_divide(dow_avg, F.nullif(F.col("avg_daily_cost"), F.lit(0.0)))


def dow_factors(daily: DataFrame, cfg: Config) -> DataFrame:
    """Mean on a day of week over the overall mean, for days of week that were observed."""
    return (
        _profile(daily, cfg)
        .select("warehouse_name", "avg_daily_cost", F.posexplode("_dow_avg").alias("_i", "_avg"))
        .where(F.col("_avg").isNotNull())
        .select("warehouse_name", (F.col("_i") + 1).alias("day_of_week"), _factor(F.col("_avg")).alias("dow_factor"))
    )


def forecast_spine(df: DataFrame, cfg: Config) -> DataFrame:
    """One row per input row and future day; generated in place, so there is no cross join."""
    return df.withColumn("days_ahead", F.explode(F.sequence(F.lit(1), F.lit(cfg.forecast_horizon_days)))).withColumn(
        "forecast_date", F.date_add(F.lit(cfg.as_of), F.col("days_ahead"))
    )


def cost_forecast(daily: DataFrame, cfg: Config) -> DataFrame:
    """Seasonality is looked up in the warehouse's own array, so no join follows the aggregation."""
    return _forecast(_profile(daily, cfg), cfg)


def forecast_from_moments(moments: DataFrame, cfg: Config) -> DataFrame:
    """The same from stored moments per date: no daily table is read."""
    return _forecast(profile_from_moments(moments, cfg), cfg)


def _forecast(profile: DataFrame, cfg: Config) -> DataFrame:
    ahead = F.col("days_ahead").cast("double")
    trend = F.col("avg_daily_cost") + ahead * F.coalesce("trend_slope_per_day", F.lit(0.0))
    season = F.coalesce(_factor(F.get("_dow_avg", X.dow(F.col("forecast_date")) - 1)), F.lit(1.0))
    point = trend * season
    band = F.coalesce("stddev_daily_cost", F.lit(0.0)) * F.sqrt(ahead)

    def usd(value: Column) -> Column:
        return X.nudge_round(F.greatest(F.lit(0.0), value), 6).cast("decimal(38,6)")

    return forecast_spine(profile, cfg).select(
        X.surrogate_key(F.col("warehouse_name"), F.col("forecast_date"), F.lit(cfg.as_of)).alias("forecast_id"),
        F.lit(cfg.as_of).alias("forecast_run_date"),
        "forecast_date",
        "days_ahead",
        "warehouse_name",
        usd(point).alias("forecasted_cost_usd"),
        usd(point - band).alias("confidence_band_low"),
        usd(point + band).alias("confidence_band_high"),
        F.lit(METHOD).alias("forecast_method"),
        F.lit(cfg.forecast_lookback_days).alias("lookback_days"),
        F.lit(cfg.as_of).alias("as_of_date"),
    )
