"""Builds every mart in dependency order: in one go, or incrementally over stored tables."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from costmart.config import Config
from costmart.operators import continued as con
from costmart.operators import departments as dep
from costmart.operators import incremental as inc
from costmart.operators import keyindex
from costmart.operators.daily import daily_costs, daily_rows, daily_trends
from costmart.operators.forecast import cost_forecast
from costmart.operators.hourly import hourly_costs
from costmart.operators.quality import run_checks
from costmart.operators.spenders import ranked_spenders, spenders_daily, top_spenders, top_spenders_base
from costmart.operators.staging import stage_metering, stage_queries, stage_storage
from costmart.operators.storage import daily_storage_costs, storage_rows, storage_trends
from costmart.operators.summary import total_cost_summary
from costmart.operators.warehouses import dim_from_state, dim_warehouse, meter_hours, size_uses
from costmart.session import stage_table
from costmart.sources import readers
from costmart.sources.writers import write_table

# Layout on disk: tables that grow with usage are laid out by date, so windowed reads prune.
PARTITIONED = {
    "stg_warehouse_metering", "stg_query_history", "int_hourly_compute_costs", "int_top_spenders", "fct_top_spenders",
    "fct_daily_costs", "fct_daily_storage_costs",
}
# Rows are sorted inside each file by this column.
CLUSTERED = {"stg_query_history": "warehouse_name"}
# Tables behind the staged ones that note their changed dates, too.
CHANGING = ("fct_daily_costs", "fct_daily_storage_costs", "int_top_spenders", "fct_top_spenders", "int_warehouse_sizes", "int_warehouse_hours")


@dataclass(frozen=True)
class Sources:
    metering: DataFrame
    queries: DataFrame
    storage: DataFrame
    department_map: DataFrame
    budget: DataFrame
    attribution: DataFrame | None = None
    clustering: DataFrame | None = None
    # Statements (query_id) whose estimate came or changed since the last incremental run.
    late_attribution: DataFrame | None = None


Store = Callable[[str, DataFrame], DataFrame]


def store_under(root: str) -> Store:
    """Write each table once and hand back the stored copy, so no mart recomputes its inputs."""

    def store(name: str, df: DataFrame) -> DataFrame:
        path = f"{root.rstrip('/')}/{name}"
        return write_table(df, path, "usage_date" if name in PARTITIONED else None, CLUSTERED.get(name))

    return store


def build(sources: Sources, cfg: Config, store: Store) -> dict[str, DataFrame]:
    """Full refresh of all tables."""
    staged = {
        "stg_warehouse_metering": store(
            "stg_warehouse_metering", stage_metering(readers.read_metering(sources.metering, cfg), cfg)
        ),
        "stg_query_history": store("stg_query_history", stage_queries(readers.read_queries(sources.queries, cfg), cfg)),
        "stg_storage_usage": store("stg_storage_usage", stage_storage(readers.read_storage(sources.storage, cfg), cfg)),
    }
    staged["int_hourly_compute_costs"] = store(
        "int_hourly_compute_costs",
        hourly_costs(staged["stg_warehouse_metering"], staged["stg_query_history"], cfg),
    )
    return build_marts(staged, sources, cfg, store)


def daily_table(cfg: Config) -> con.Windowed:
    return con.Windowed("warehouse_name", "total_cost", 7, daily_rows, lambda rows: daily_trends(rows, cfg))


def storage_table(cfg: Config) -> con.Windowed:
    return con.Windowed("database_name", "_total", 29, storage_rows, lambda rows: storage_trends(rows, cfg))


SPENDERS = con.Windowed("user_name", "estimated_cost_usd", 6, spenders_daily, ranked_spenders)


def build_marts(staged: dict[str, DataFrame], sources: Sources, cfg: Config, store: Store) -> dict[str, DataFrame]:
    """All marts in full from staged tables."""
    t = dict(staged)
    t["fct_daily_costs"] = store("fct_daily_costs", daily_costs(t["int_hourly_compute_costs"], cfg))
    t["fct_daily_storage_costs"] = store("fct_daily_storage_costs", daily_storage_costs(t["stg_storage_usage"], cfg))
    t["int_top_spenders"] = store("int_top_spenders", top_spenders_base(t["stg_query_history"], sources.attribution))
    t["fct_top_spenders"] = store("fct_top_spenders", top_spenders(t["int_top_spenders"]))
    # A view: cheap over staged tables of a full build and always current.
    t["dim_warehouse"] = dim_warehouse(t["stg_warehouse_metering"], t["stg_query_history"])
    return build_small_marts(t, sources, cfg, store)


def build_small_marts(tables: dict[str, DataFrame], sources: Sources, cfg: Config, store: Store) -> dict[str, DataFrame]:
    """Marts over one row per warehouse, department or database and day: built in full in all modes."""
    t = dict(tables)
    daily, storage = t["fct_daily_costs"], t["fct_daily_storage_costs"]
    t["fct_total_cost_summary"] = store("fct_total_cost_summary", total_cost_summary(daily, storage, cfg, sources.clustering))
    t["fct_cost_forecast"] = store("fct_cost_forecast", cost_forecast(daily, cfg))
    t["fct_cost_by_department"] = store("fct_cost_by_department", dep.cost_by_department(daily, sources.department_map))
    t["fct_budget_vs_actual"] = store("fct_budget_vs_actual", dep.budget_vs_actual(daily, sources.department_map, sources.budget))
    t["dim_department"] = dep.dim_department(sources.department_map)
    return t


def load_incremental(spark: SparkSession, root: str, sources: Sources, cfg: Config) -> dict[str, DataFrame]:
    """Merge what arrived since each table's high-water mark into the staged tables and the hourly costs.

    Each table is loaded by itself: one that is missing is built from all its source holds, one that is
    stored is repaired (columns and buckets that older versions lacked) and merged into. A stored table is
    never overwritten from a source that is cut at its horizon. Every merge notes the dates it changed.
    """
    root = root.rstrip("/")
    store = store_under(root)
    t: dict[str, DataFrame] = {}
    # Metering hours are booked on their end or their start; a missing bucket follows the same rule.
    hours = ("end_time", "hour_end", "hour_start") if cfg.meter_bucket == "end" else ("end_time", "hour_start", "hour_end")

    def backfill(df: DataFrame) -> DataFrame:
        return inc.backfill(df, hours)

    def at(name: str) -> str:
        return f"{root}/{name}"

    def is_stored(name: str) -> bool:
        inc.finish_pending(spark, at(name))
        return inc.table_stored(spark, at(name))

    def first_load(name: str, df: DataFrame) -> None:
        t[name] = store(name, df)
        inc.note_changes(spark, at(name), None)

    def changed(name: str) -> list | None:
        return inc.changed_dates(spark, at(name))

    def merge(name: str, batch: DataFrame, key: str, newest: list[str], fixed_date: bool) -> DataFrame:
        return inc.upsert_table(
            spark, at(name), batch, key, newest,
            key_implies_partition=fixed_date, policy=cfg.schema_policy, sort_by=CLUSTERED.get(name),
        )

    def load(name: str, source: DataFrame, stage, marks, key: str, newest: list[str], fixed_date: bool) -> None:
        if not is_stored(name):
            first_load(name, stage(source, cfg))
            return
        inc.repair_table(spark, at(name), backfill, ["usage_hour_ntz"], sort_by=CLUSTERED.get(name))
        new = inc.since_watermark(source, inc.stored_table(spark, at(name)), marks, partition_by="usage_date")
        t[name] = merge(name, stage(new, cfg), key, newest, fixed_date)

    load(
        "stg_warehouse_metering", readers.read_metering(sources.metering, cfg), stage_metering,
        inc.METERING_WATERMARKS, "metering_id", ["_loaded_at", "hour_start"], True,
    )
    load(
        "stg_query_history", readers.read_queries(sources.queries, cfg), stage_queries,
        inc.QUERY_WATERMARKS, "query_id", ["_loaded_at", "end_time"], False,
    )
    metering, queries = t["stg_warehouse_metering"], t["stg_query_history"]
    if sources.late_attribution is not None and changed("stg_query_history") is not None:
        path = at("stg_query_history")
        keyindex.ensure_index(spark, path, queries, "query_id", "usage_date")
        late = keyindex.dates_of_keys(spark, path, queries, sources.late_attribution, "query_id", "usage_date")
        inc.note_changes(spark, path, [r[0] for r in late.distinct().collect()])  # at most one per calendar date

    name = "stg_storage_usage"
    if is_stored(name):
        old = inc.stored_table(spark, at(name))
        new = inc.since_watermark(
            readers.read_storage(sources.storage, cfg, full=False), old, (inc.STORAGE_WATERMARK,), "usage_date"
        )
        batch = stage_storage(new, cfg)
        inc.sync_schema(old, batch, cfg.schema_policy)
        batch = stage_table(batch, "storage-batch")
        t[name] = old
        if dates := [r[0] for r in batch.select("usage_date").distinct().collect()]:
            inc.note_changes(spark, at(name), dates)
            t[name] = inc.replace_table(spark, inc.upsert(old, batch, "storage_snapshot_id", ["usage_date"]), at(name))
    else:
        first_load(name, stage_storage(readers.read_storage(sources.storage, cfg), cfg))

    name = "int_hourly_compute_costs"
    if is_stored(name):
        if inc.has_missing(spark, at(name), ["usage_hour_ntz", "warehouse_id"]):
            inc.repair_table(
                spark, at(name), lambda df: inc.backfill_warehouse_id(backfill(df), metering), ["usage_hour_ntz", "warehouse_id"]
            )
        inputs = [changed("stg_warehouse_metering"), changed("stg_query_history")]
        both = None if None in inputs else sorted({*inputs[0], *inputs[1]}, key=str)
        batch = inc.hourly_costs_incremental(metering, queries, inc.stored_table(spark, at(name)), cfg, "usage_date", both)
        t[name] = merge(name, batch, "cost_hour_key", ["_loaded_at"], True)
    else:
        first_load(name, hourly_costs(metering, queries, cfg))

    return t


def build_incremental(spark: SparkSession, root: str, sources: Sources, cfg: Config) -> dict[str, DataFrame]:
    """Load the staged tables, then bring the marts up to date.

    Marts that grow with usage are computed again for the changed dates only, windows from the first of them
    on. The notes of changes are dropped when all marts are done, so a run that dies is made up for by the next.
    """
    root = root.rstrip("/")
    t = load_incremental(spark, root, sources, cfg)

    def at(name: str) -> str:
        return f"{root}/{name}"

    def changed(name: str) -> list | None:
        return inc.changed_dates(spark, at(name))

    def by_date(name: str, make, upstream: str, dates: list | None) -> None:
        t[name] = con.refresh_dates(spark, at(name), make, t[upstream], at(upstream), dates)

    def windowed(name: str, table: con.Windowed, upstream: str) -> None:
        t[name] = con.refresh_windows(spark, at(name), table, t[upstream], at(upstream), changed(upstream))

    windowed("fct_daily_costs", daily_table(cfg), "int_hourly_compute_costs")
    windowed("fct_daily_storage_costs", storage_table(cfg), "stg_storage_usage")
    dates = changed("stg_query_history")
    priced = con.is_complete(spark, at("int_top_spenders")) and inc.stored_table(spark, at("int_top_spenders")).select("has_cost_estimate").first()
    if priced and priced[0] != (sources.attribution is not None):
        dates = None  # estimates came or went as a whole
    by_date("int_top_spenders", lambda log: top_spenders_base(log, sources.attribution), "stg_query_history", dates)
    windowed("fct_top_spenders", SPENDERS, "int_top_spenders")
    by_date("int_warehouse_sizes", lambda log: size_uses(log, "usage_date"), "stg_query_history", changed("stg_query_history"))
    by_date("int_warehouse_hours", meter_hours, "stg_warehouse_metering", changed("stg_warehouse_metering"))
    t["dim_warehouse"] = dim_from_state(t.pop("int_warehouse_hours"), t.pop("int_warehouse_sizes"))
    built = build_small_marts(t, sources, cfg, store_under(root))
    for name in ("stg_warehouse_metering", "stg_query_history", "stg_storage_usage", "int_hourly_compute_costs", *CHANGING):
        inc.take_changes(spark, at(name))
    return built


def check(tables: dict[str, DataFrame]) -> DataFrame:
    return run_checks(tables)
