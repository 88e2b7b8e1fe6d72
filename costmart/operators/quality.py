"""Data-quality checks. Each returns the violating rows; `run_checks` counts them for whole suites."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass, field
from datetime import datetime
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from costmart.functions import exprs as X

WARN_HOURS = 48
ERROR_HOURS = 96


def not_null(df: DataFrame, column: str) -> DataFrame:
    return df.where(F.col(column).isNull())


def unique(df: DataFrame, column: str) -> DataFrame:
    """Values that occur more than once, with their number of rows; NULLs do not count."""
    return unique_combo(df.where(F.col(column).isNotNull()), [column])


def unique_combo(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.groupBy(*columns).agg(F.count(F.lit(1)).alias("row_count")).where(F.col("row_count") > 1)


def _within(column: str, lo, hi) -> Column:
    value = F.col(column)
    ok = F.lit(True)
    if lo is not None:
        ok = ok & (value >= lo)
    if hi is not None:
        ok = ok & (value <= hi)
    return ok


def between(df: DataFrame, column: str, lo=None, hi=None, where: str | None = None) -> DataFrame:
    """Rows outside [lo, hi]; an unknown value violates nothing."""
    rows = df.where(where) if where else df
    return rows.where(~_within(column, lo, hi))


def accepted(df: DataFrame, column: str, values: Iterable, where: str | None = None) -> DataFrame:
    rows = df.where(where) if where else df
    return rows.where(~F.col(column).isin(*values))


def relationship(child: DataFrame, parent: DataFrame, column: str) -> DataFrame:
    """Child rows whose value the parent lacks. The parent is reduced to distinct values first."""
    known = parent.select(column).where(F.col(column).isNotNull()).distinct()
    return child.where(F.col(column).isNotNull()).join(known, column, "left_anti")


def idle_within_compute(daily: DataFrame, share: Decimal = Decimal(1)) -> DataFrame:
    """Rows whose idle cost exceeds its share of compute; run it on figures that nothing has capped."""
    return daily.where(F.col("idle_cost") > F.col("compute_cost") * F.lit(share)).select(
        "usage_date", "warehouse_name", "compute_cost", "idle_cost"
    )


def contract_differences(df: DataFrame, schema: StructType) -> DataFrame:
    """One row per column that is missing, unexpected or of another type."""
    want = {f.name: f.dataType.simpleString() for f in schema.fields}
    have = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    rows = [(c, want.get(c), have.get(c)) for c in {**want, **have} if want.get(c) != have.get(c)]
    return df.sparkSession.createDataFrame(rows, "column string, expected string, actual string")


def contract_misfits(df: DataFrame, schema: StructType) -> DataFrame:
    """Columns that differ from the contract, with the number of stored values that its type can't hold."""
    differing = contract_differences(df, schema)
    shared = [f for f in schema.fields if f.name in df.columns]
    lost = [F.count(F.when(F.col(f.name).isNotNull() & F.col(f.name).try_cast(f.dataType).isNull(), 1)) for f in shared]
    counted = df.agg(*[n.alias(f"c{i}") for i, n in enumerate(lost)])
    pairs = [F.struct(F.lit(f.name).alias("column"), F.col(f"c{i}").alias("misfits")) for i, f in enumerate(shared)]
    return differing.join(counted.select(F.explode(F.array(*pairs)).alias("c")).select("c.*"), "column", "left")


def matches_contract(df: DataFrame, schema: StructType) -> bool:
    return [(f.name, f.dataType) for f in df.schema.fields] == [(f.name, f.dataType) for f in schema.fields]


# ---- freshness ----------------------------------------------------------------------------------

def _status(hours: Column, warn: int, error: int) -> Column:
    return (
        F.when(hours.isNull(), "missing")
        .when(hours > error, "error")
        .when(hours > warn, "warn")
        .otherwise("pass")
    )


def _age(latest: Column, now: datetime) -> Column:
    micros = F.unix_micros(F.lit(now).cast("timestamp_ntz").cast("timestamp")) - F.unix_micros(latest.cast("timestamp"))
    return X.exact_div(X.whole(micros), F.lit(3_600_000_000).cast("decimal(20,0)"), 2)


def source_freshness(df: DataFrame, column: str, now: datetime, warn_h: int = WARN_HOURS, error_h: int = ERROR_HOURS) -> DataFrame:
    """Latest load time, its age and its band. Pass a date column for daily snapshots."""
    latest = df.agg(F.max(F.col(column).cast("timestamp_ntz")).alias("latest"))
    return latest.withColumn("age_hours", _age(F.col("latest"), now)).withColumn(
        "status", _status(F.col("age_hours"), warn_h, error_h)
    )


def mart_freshness(daily: DataFrame, now: datetime) -> DataFrame:
    """As above from the latest usage date; an age below zero counts as zero."""
    fresh = source_freshness(daily, "usage_date", now)
    age = X.strict_greatest(F.col("age_hours"), F.lit(0).cast("decimal(38,2)"))
    return fresh.withColumn("age_hours", age).withColumn("status", _status(F.col("age_hours"), WARN_HOURS, ERROR_HOURS))


def table_diagnostics(tables: dict[str, tuple[DataFrame | None, str]]) -> DataFrame:
    """Status, row count and latest date per table; a table that is None or empty is missing."""
    spark = next(df.sparkSession for df, _ in tables.values() if df is not None)
    parts = []
    for name, (df, column) in tables.items():
        if df is None:
            df = spark.createDataFrame([], f"{column} date")
        counted = df.agg(F.count(F.lit(1)).alias("row_count"), F.max(F.col(column).cast("date")).alias("latest"))
        parts.append(
            counted.select(
                F.lit(name).alias("table_name"),
                F.when(F.col("latest").isNotNull(), "OK").otherwise("Missing").alias("status"),
                "row_count",
                "latest",
            )
        )
    return _union(parts)


def critical_empty(tables: dict[str, DataFrame]) -> DataFrame:
    """Tables that must have rows and do not; each is probed for one row only."""
    probes = [
        df.limit(1)
        .agg(F.count(F.lit(1)).alias("n"))
        .where(F.col("n") == 0)
        .select(F.lit(name).alias("table_name"), F.lit(f"No rows in {name}.").alias("detail"))
        for name, df in tables.items()
    ]
    return _union(probes)


# ---- suites -------------------------------------------------------------------------------------

@dataclass(frozen=True)
class Suite:
    """Declared checks of one table."""

    not_null: tuple[str, ...] = ()
    unique: tuple[str, ...] = ()
    unique_combos: tuple[tuple[str, ...], ...] = ()
    between: tuple[tuple, ...] = ()  # (column, lo, hi)
    accepted: tuple[tuple[str, tuple], ...] = ()
    relationships: tuple[tuple[str, str], ...] = ()  # (column, parent table)
    rules: dict[str, str] = field(default_factory=dict)  # name -> condition that must not hold


# The checks every mart is published with.
SUITES: dict[str, Suite] = {
    "stg_warehouse_metering": Suite(
        not_null=("usage_hour_ntz", "metering_id"),
        unique=("metering_id",),
        between=(("compute_cost_usd", 0, None), ("total_credits_used", 0, None)),
    ),
    "stg_query_history": Suite(
        not_null=("usage_hour_ntz", "query_id"),
        unique=("query_id",),
        between=(("total_elapsed_seconds", 0, None),),
    ),
    "stg_storage_usage": Suite(
        not_null=("storage_snapshot_id", "usage_date", "database_name"),
        unique=("storage_snapshot_id",),
        between=(("total_storage_tb", 0, None), ("estimated_storage_cost_usd", 0, None)),
    ),
    "int_hourly_compute_costs": Suite(not_null=("usage_hour_ntz", "cost_hour_key"), unique=("cost_hour_key",)),
    "int_top_spenders": Suite(
        not_null=("usage_date", "user_name"),
        between=(("query_count", 1, None), ("total_runtime_seconds", 0, None), ("gb_scanned", 0, None)),
    ),
    "fct_daily_costs": Suite(
        not_null=("usage_date",),
        unique=("daily_cost_key",),
        between=(("compute_cost", 0, None), ("idle_cost", 0, None), ("efficiency_score", 0, 100)),
        relationships=(("warehouse_name", "stg_warehouse_metering"),),
        rules={"idle_within_compute": "idle_cost > compute_cost"},
    ),
    "fct_daily_storage_costs": Suite(
        not_null=("usage_date", "database_name"),
        unique=("daily_storage_key",),
        between=(("total_storage_tb", 0, None), ("estimated_storage_cost_usd", 0, None)),
    ),
    "fct_total_cost_summary": Suite(
        not_null=("total_cost_summary_id", "usage_date", "cost_category"),
        unique=("total_cost_summary_id",),
        between=(("cost_usd", 0, None), ("pct_of_daily_total", 0, 100)),
        accepted=(("cost_category", ("COMPUTE", "STORAGE", "AUTO_CLUSTERING", "SERVERLESS", "OTHER")),),
    ),
    "fct_cost_forecast": Suite(
        not_null=("forecast_id", "forecast_date", "warehouse_name", "forecasted_cost_usd"),
        unique=("forecast_id",),
        between=(
            ("forecasted_cost_usd", 0, None),
            ("days_ahead", 1, 30),
            ("confidence_band_low", 0, None),
            ("confidence_band_high", 0, None),
        ),
    ),
    "fct_top_spenders": Suite(
        not_null=("top_spender_id", "usage_date", "user_name"),
        unique=("top_spender_id",),
        between=(("query_count", 1, None), ("pct_of_daily_query_total", 0, 100)),
    ),
    "fct_cost_by_department": Suite(not_null=("usage_date", "department"), between=(("total_cost_usd", 0, None),)),
    "fct_budget_vs_actual": Suite(
        not_null=("usage_date", "department"),
        between=(("budget_usd", 0, None),),
        unique_combos=(("usage_date", "department"),),
    ),
    "dim_warehouse": Suite(not_null=("warehouse_name",), accepted=(("warehouse_size", tuple(X.SIZE_CREDITS)),)),
    "dim_department": Suite(not_null=("warehouse_name", "department"), unique=("warehouse_name",)),
    "budget_daily": Suite(
        not_null=("date", "department", "budget_usd"), unique_combos=(("date", "department"),)
    ),
    "storage_history": Suite(
        not_null=("usage_date", "database_name"), unique_combos=(("usage_date", "database_name"),)
    ),
    "query_history": Suite(not_null=("query_id", "warehouse_name"), unique=("query_id",)),
}


def _row_conditions(suite: Suite) -> dict[str, Column]:
    found = {f"not_null({c})": F.col(c).isNull() for c in suite.not_null}
    found |= {f"between({c})": ~_within(c, lo, hi) for c, lo, hi in suite.between}
    found |= {f"accepted({c})": ~F.col(c).isin(*values) for c, values in suite.accepted}
    found |= {name: F.expr(rule) for name, rule in suite.rules.items()}
    return found


def _union(parts: list[DataFrame]) -> DataFrame:
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part)
    return whole


RESULT = "check_name string, table_name string, value string, known boolean, violations long"


def _parents(suites: dict[str, Suite], tables: Iterable[str]) -> list[tuple[str, str, str]]:
    """(child table, column, parent table) of all declared references between the given tables."""
    return [(n, c, p) for n in tables if n in suites for c, p in suites[n].relationships]


def _findings(name: str, df: DataFrame, suite: Suite, parents: list[tuple[str, str, str]]) -> DataFrame:
    """All that one scan of a table tells: violations of its own checks, and the values on either side of references.

    Every key is a grouping set of one aggregation, whose groups also count the row-level violations; a group
    of the first set stands for its rows once.
    """
    conditions = _row_conditions(suite)
    keys: list[tuple[tuple[str, ...], str, bool]] = [((c,), f"unique({c})", True) for c in suite.unique]
    keys += [(tuple(cs), f"unique({', '.join(cs)})", False) for cs in suite.unique_combos]
    children = [((c,), f"relationship({c})", name, False) for child, c, _ in parents if child == name]
    values = children + [((c,), f"relationship({c})", child, True) for child, c, parent in parents if parent == name]
    sets = list(dict.fromkeys([k for k, *_ in keys] + [v for v, *_ in values]))
    counted = [F.count(F.when(bad, 1)).alias(f"_c{i}") for i, bad in enumerate(conditions.values())]
    if sets:
        columns = list(dict.fromkeys(c for s in sets for c in s))
        groups = df.groupingSets([[F.col(c) for c in s] for s in sets], *[F.col(c) for c in columns]).agg(
            F.grouping_id().alias("_set"), F.count(F.lit(1)).alias("_n"), *counted
        )
    else:
        columns, groups = [], df.agg(F.lit(0).alias("_set"), F.count(F.lit(1)).alias("_n"), *counted)

    def of(columns_of_set: tuple[str, ...]) -> Column:
        bits = [0 if c in columns_of_set else 1 for c in columns]
        return F.col("_set") == F.lit(int("".join(map(str, bits)) or "0", 2))

    def found(condition: Column, check: str, table: str, value: Column, known: bool, n: Column) -> Column:
        row = F.struct(
            F.lit(check).alias("check_name"), F.lit(table).alias("table_name"), value.cast("string").alias("value"),
            F.lit(known).alias("known"), n.cast("long").alias("violations"),
        )
        return F.when(condition, row)

    none, one = F.lit(None), F.lit(1)
    rows = [found(of(sets[0]) & (F.col(f"_c{i}") > 0) if sets else F.lit(True), c, name, none, False, F.col(f"_c{i}")) for i, c in enumerate(conditions)]
    for key, check, skip_null in keys:
        repeated = of(key) & (F.col("_n") > 1)
        rows.append(found(repeated & F.col(key[0]).isNotNull() if skip_null else repeated, check, name, none, False, one))
    for key, check, table, known in values:
        rows.append(found(of(key) & F.col(key[0]).isNotNull(), check, table, F.col(key[0]), known, F.col("_n")))
    return groups.select(F.explode(F.filter(F.array(*rows), lambda r: r.isNotNull())).alias("r")).select("r.*")


def run_checks(tables: dict[str, DataFrame], suites: dict[str, Suite] = SUITES) -> DataFrame:
    """(check_name, table_name, violations) of every declared check; each table is scanned once.

    References are settled by one aggregation over (check, value) pairs of children and parents, in the place
    of an anti join each. A check without findings has zero violations.
    """
    spark = next(iter(tables.values())).sparkSession
    parents = _parents(suites, tables)
    checks, parts = [], []
    for name, df in tables.items():
        suite = suites.get(name, Suite())
        names = [*_row_conditions(suite), *(f"unique({c})" for c in suite.unique)]
        names += [f"unique({', '.join(c)})" for c in suite.unique_combos] + [f"relationship({c})" for c, _ in suite.relationships]
        checks += [(n, name, None, False, 0) for n in names]
        if names or any(parent == name for *_, parent in parents):
            parts.append(_findings(name, df, suite, parents))
    every = _union([spark.createDataFrame(checks, RESULT), *parts])
    of_value = every.groupBy("check_name", "table_name", "value").agg(F.bool_or("known").alias("known"), F.sum("violations").alias("violations"))
    return of_value.groupBy("check_name", "table_name").agg(F.sum(F.when(F.col("known"), 0).otherwise(F.col("violations"))).alias("violations"))
