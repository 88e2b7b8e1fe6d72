"""Who spends: query activity per user, ranked per day."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from costmart.functions import exprs as X
from costmart.operators.hourly import seconds
from costmart.operators.ranking import add_rank, descending_ranks, group_text, sortable
from costmart.operators.staging import BYTES_PER_GB
from costmart.session import stage_table

BASE_KEY = ["usage_date", "user_name", "role_name", "database_name", "warehouse_name"]
USER_DAY = ["usage_date", "user_name"]
COST = "decimal(38,6)"


def top_spenders_base(staged_queries: DataFrame, attribution: DataFrame | None = None) -> DataFrame:
    """User × role × database × warehouse × day. With per-query cost estimates each statement is
    joined on its unique id first; without, the cost column is a typed NULL and nothing is joined."""
    rows = staged_queries.select(
        X.day_of(F.col("usage_hour_ntz")).alias("usage_date"),
        "user_name",
        "role_name",
        "database_name",
        "warehouse_name",
        "query_id",
        "total_elapsed_ms",
        "bytes_scanned",
        "rows_produced",
        "runtime_category",
    )
    if attribution is None:
        cost = F.lit(None).cast(COST)
    else:
        rows = rows.join(attribution.select("query_id", "estimated_query_cost_usd"), "query_id", "left")
        cost = F.sum("estimated_query_cost_usd").cast(COST)
    ms = F.sum("total_elapsed_ms")
    return (
        rows.groupBy(*BASE_KEY)
        .agg(
            F.count("query_id").alias("query_count"),
            ms.alias("_ms"),
            F.count("total_elapsed_ms").alias("_timed"),
            F.sum(F.when(F.col("runtime_category") == "long_running", 1).otherwise(0)).alias(
                "long_running_query_count"
            ),
            F.sum("bytes_scanned").alias("_bytes"),
            F.sum("rows_produced").alias("rows_produced"),
            cost.alias("estimated_cost_usd"),
        )
        .select(
            *BASE_KEY,
            "query_count",
            seconds(F.col("_ms")).alias("total_runtime_seconds"),
            X.exact_div(seconds(F.col("_ms")), X.whole(F.col("_timed")), 6).alias("avg_runtime_seconds"),
            "long_running_query_count",
            (F.col("_bytes") / F.lit(float(BYTES_PER_GB))).alias("gb_scanned"),
            "rows_produced",
            "estimated_cost_usd",
            F.lit(attribution is not None).alias("has_cost_estimate"),
        )
    )


def primary_warehouse(base: DataFrame) -> DataFrame:
    """Per user and day, the warehouse of the base row with most statements; name breaks ties."""
    return base.groupBy(*USER_DAY).agg(_busiest_warehouse().alias("primary_warehouse_name"))


def _busiest_warehouse():
    # The smallest (-count, name) is the busiest row; a NULL name sorts after every other.
    order = F.struct(
        (-F.col("query_count")).alias("n"),
        F.col("warehouse_name").isNull().alias("unnamed"),
        F.col("warehouse_name").alias("name"),
    )
    return F.min(order)["name"]


def spenders_daily(base: DataFrame) -> DataFrame:
    """User × day totals and the primary warehouse, in one aggregation instead of a self-join."""
    return base.groupBy(*USER_DAY).agg(
        F.sum("query_count").alias("query_count"),
        F.sum("total_runtime_seconds").cast("decimal(38,3)").alias("total_runtime_seconds"),
        F.sum("long_running_query_count").alias("long_running_query_count"),
        F.sum("gb_scanned").alias("gb_scanned"),
        F.sum("estimated_cost_usd").cast(COST).alias("estimated_cost_usd"),
        F.bool_or("has_cost_estimate").alias("has_cost_estimate"),
        _busiest_warehouse().alias("primary_warehouse_name"),
    )


def top_spenders(base: DataFrame) -> DataFrame:
    return ranked_spenders(stage_table(spenders_daily(base), "spenders"))


def ranked_spenders(rows: DataFrame) -> DataFrame:
    """Ranks within the day, shares of the day and a 7-row rolling cost per user.

    A day may hold any number of users, so nothing sorts or buffers one. The three measures become rows
    (day and measure, value), whose distinct values are counted and ranked together. All ranks come back by
    one join on the value; the first measure's row carries the user's figures, and the three rows of a user
    and day meet where the user's rolling cost is taken, in one shuffle for both. Day totals come from an
    aggregation. Ties and NULLs included, this is exact.

    `rows`, one per user and day, are stored, and so are the ranks: both are read by several branches. Rows
    that are only carried for the rolling cost are neither ranked nor returned.
    """
    carried = "_carried" in rows.columns
    spenders = rows.where("NOT _carried").drop("_carried", "_month_value") if carried else rows
    ranked_by = {
        "rank_by_query_count": sortable(F.col("query_count")),
        "rank_by_runtime": sortable(F.col("total_runtime_seconds"), 3, nulls="first"),
        "rank_by_cost": sortable(F.col("estimated_cost_usd"), 6),
    }

    def measures(*figures):
        """One row per measure: its day and value, and the figures with the first."""
        parts = []
        for place, (alias, value) in enumerate(ranked_by.items()):
            day = F.concat(F.lit(f"{alias}|"), group_text("usage_date"))
            own = [F.when(F.lit(place == 0), f).alias("figures") for f in figures]
            parts.append(F.struct(F.lit(place).alias("place"), day.alias("day"), value.alias("value"), *own))
        return F.explode(F.array(*parts)).alias("m")

    ranks = stage_table(
        descending_ranks(spenders.select(measures()).select("m.day", "m.value"), "day", F.col("value")), "spender-ranks"
    )
    figures = F.struct(*[c for c in spenders.columns if c not in USER_DAY])
    exploded = spenders.select(*USER_DAY, measures(figures)).select(*USER_DAY, "m.*")
    found = add_rank(exploded, ranks, "day", F.col("value"), "rank")
    if carried:
        before = rows.where("_carried").select(*USER_DAY, F.lit(0).alias("place"), figures.alias("figures"))
        found = found.unionByName(before, allowMissingColumns=True)
    # By user: the aggregation and the window below share this shuffle and its sort.
    found = found.repartition("user_name").groupBy("user_name", "usage_date").agg(
        F.first("figures", ignorenulls=True).alias("figures"),
        *[F.max(F.when(F.col("place") == i, F.col("rank"))).alias(alias) for i, alias in enumerate(ranked_by)],
    )
    # One row per user and calendar day.
    last_7 = W.partitionBy("user_name").orderBy("usage_date").rowsBetween(-6, 0)
    rolling = found.select(*USER_DAY, "figures.*", *ranked_by).withColumn(
        "rolling_7d_cost_usd", F.sum("estimated_cost_usd").over(last_7).cast(COST)
    )
    # A carried row has no rank; every other row has one.
    rolling = rolling.where("rank_by_query_count IS NOT NULL") if carried else rolling
    # One row per calendar date; Spark broadcasts it by its measured size.
    totals = spenders.groupBy(F.col("usage_date").alias("_day")).agg(
        F.sum("query_count").alias("_day_queries"), F.sum("estimated_cost_usd").cast(COST).alias("_day_cost")
    )
    ranked = rolling.join(totals, F.col("usage_date").eqNullSafe(F.col("_day")), "left")
    hundred = F.lit(Decimal(100))
    return ranked.select(
        X.surrogate_key(F.col("user_name"), F.col("usage_date")).alias("top_spender_id"),
        "usage_date",
        "user_name",
        "primary_warehouse_name",
        "query_count",
        "total_runtime_seconds",
        "long_running_query_count",
        "gb_scanned",
        "estimated_cost_usd",
        "has_cost_estimate",
        *[F.col(alias).cast("bigint").alias(alias) for alias in ranked_by],
        X.exact_div(X.whole(F.col("query_count")) * hundred, X.whole(F.col("_day_queries")), 2).alias(
            "pct_of_daily_query_total"
        ),
        X.exact_div(X.money(F.col("estimated_cost_usd")) * hundred, X.money(F.col("_day_cost")), 2).alias(
            "pct_of_daily_cost"
        ),
        "rolling_7d_cost_usd",
    )
