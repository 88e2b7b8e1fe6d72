"""Department showback and budget comparison."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from costmart.functions import exprs as X

COST = "decimal(38,6)"


def dim_department(department_map: DataFrame) -> DataFrame:
    return department_map.select(
        X.clean_name(F.col("warehouse_name")).alias("warehouse_name"),
        F.trim("department").alias("department"),
    )


def with_department(daily: DataFrame, department_map: DataFrame) -> DataFrame:
    """Left join on the name regardless of case. Padding counts: ' WH' does not match 'WH'.

    No broadcast hint: the map is a file whose size the planner knows and adaptive execution measures,
    so it is broadcast while it is small and shuffled once it is not.
    """
    names = department_map.select(F.upper("warehouse_name").alias("_name"), F.col("department").alias("_department"))
    return daily.withColumn("_name", F.upper("warehouse_name")).join(names, "_name", "left").drop("_name")


def cost_by_department(daily: DataFrame, department_map: DataFrame) -> DataFrame:
    """Showback. Account-level overhead keeps its own line so departments add up to the total."""
    booked = with_department(daily, department_map).withColumn(
        "department", X.showback_department(F.col("warehouse_name"), F.col("_department"))
    )
    return booked.groupBy("usage_date", "department").agg(
        F.sum("compute_cost").cast(COST).alias("compute_cost_usd"),
        F.sum("idle_cost").cast(COST).alias("idle_cost_usd"),
        F.sum("total_cost").cast(COST).alias("total_cost_usd"),
    )


def department_actuals(daily: DataFrame, department_map: DataFrame) -> DataFrame:
    """Actuals for the budget view, where overhead counts as unassigned."""
    booked = with_department(daily, department_map).withColumn(
        "department", X.department_or_unassigned(F.col("_department"))
    )
    return booked.groupBy("usage_date", "department").agg(F.sum("total_cost").cast(COST).alias("actual_cost_usd"))


def budget_vs_actual(daily: DataFrame, department_map: DataFrame, budget: DataFrame) -> DataFrame:
    planned = budget.select(
        F.col("date").cast("date").alias("usage_date"),
        F.trim("department").alias("department"),
        "budget_usd",
    )
    none = F.lit(0)
    return department_actuals(daily, department_map).join(planned, ["usage_date", "department"], "full").select(
        "usage_date",
        "department",
        F.coalesce("actual_cost_usd", none.cast(COST)).alias("actual_cost_usd"),
        F.coalesce("budget_usd", none.cast("decimal(18,2)")).alias("budget_usd"),
    )


def department_fallback(daily: DataFrame, department_map: DataFrame | None) -> DataFrame:
    """Stand-in for an empty showback mart: compute plus idle per mapped department.

    It counts idle on top of compute, which contains it, so it is higher than the mart by design.
    """
    if department_map is None:
        booked = daily.withColumn("department", F.lit("Unassigned"))
    else:
        booked = with_department(daily, department_map).withColumn(
            "department", F.coalesce("_department", F.lit("Unassigned"))
        )
    cost = F.coalesce("compute_cost", F.lit(0).cast(COST)) + F.coalesce("idle_cost", F.lit(0).cast(COST))
    return booked.groupBy("department", "usage_date").agg(F.sum(cost).cast(COST).alias("total_cost_usd"))
