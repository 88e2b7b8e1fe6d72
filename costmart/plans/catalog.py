"""Every operator as a runnable query over the benchmark tables, with its SQL counterpart.

`QUERIES[name](spark, folder)` gives the Spark result; `ORACLES[name]` is SQL for the same tables.
Frames a query reads more than once are stored first, as a production build stores its tables.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import date, datetime
from decimal import Decimal
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from costmart.config import Config
from costmart.functions import exprs as X
from costmart.operators import analytics as A
from costmart.operators import continued as CON
from costmart.operators import daily as D
from costmart.operators import departments as DEP
from costmart.operators import forecast as FC
from costmart.operators import hourly as H
from costmart.operators import incremental as I
from costmart.operators import keyindex as KI
from costmart.operators import quality as Q
from costmart.operators import ranking as R
from costmart.operators import spenders as SP
from costmart.operators import staging as ST
from costmart.operators import storage as STO
from costmart.operators import summary as SUM
from costmart.operators import warehouses as WH
from costmart.plans import marts
from costmart.plans.oracle import ASOF, LABEL_CREDITS, UNASSIGNED, half_up, key, micro, nudge, pct, usd, with_ctes
from costmart.session import scratch_path, stage_table
from costmart.sources import readers, writers
from costmart.sources.adapter import Inputs
from costmart.streaming import ingest as ING

AS_OF = date(2024, 1, 31)
MID_MONTH = date(2024, 1, 20)
NOW = datetime(2024, 2, 2, 12, 0, 0)
# Old state of incremental tables ends here; later rows are the batch.
CUT = datetime(2024, 1, 20, 12, 0, 0)
CUT_SQL = "timestamp '2024-01-20 12:00:00'"

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


class Env:
    """Inputs, staging and marts of one folder, lazy unless marked stored."""

    def __init__(self, spark: SparkSession, folder: str, as_of: date = AS_OF):
        self.spark = spark
        self.cfg = Config(as_of=as_of)
        self.inputs = Inputs(spark, folder)

    # Stored: the result feeds several branches of one plan.
    def stored(self, df: DataFrame, name: str) -> DataFrame:
        return stage_table(df, name)

    def metering(self):
        return readers.read_metering(self.inputs.metering(self.cfg.days_ago(self.cfg.metering_history_days)), self.cfg)

    def queries(self):
        return readers.read_queries(self.inputs.queries(self.cfg.days_ago(self.cfg.query_history_days)), self.cfg)

    def sm(self):
        return ST.stage_metering(self.metering(), self.cfg)

    def sq(self):
        return ST.stage_queries(self.queries(), self.cfg)

    def ss(self):
        return ST.stage_storage(readers.read_storage(self.inputs.storage(), self.cfg), self.cfg)

    def hourly(self):
        return H.hourly_costs(self.sm(), self.sq(), self.cfg)

    def daily(self):
        return D.daily_costs(self.hourly(), self.cfg)

    def sd(self):
        return STO.daily_storage_costs(self.ss(), self.cfg)

    def base(self):
        return SP.top_spenders_base(self.sq(), self.inputs.attribution())

    def dept(self):
        return DEP.cost_by_department(self.daily(), self.inputs.department_map())

    def bva(self):
        return DEP.budget_vs_actual(self.daily(), self.inputs.department_map(), self.inputs.budget())

    def categories(self):
        compute = SUM.category_compute(self.daily())
        clustering = SUM.category_clustering(self.inputs.clustering(), self.cfg)
        return compute.unionByName(SUM.category_storage(self.sd())).unionByName(clustering)

    def sources(self):
        i = self.inputs
        return marts.Sources(
            i.metering(), i.queries(), i.storage(), i.department_map(), i.budget(), i.attribution(), i.clustering()
        )

    def sizes(self):
        return WH.dim_warehouse(self.sm(), self.sq())

    def idle(self, days: int = 30, hourly: DataFrame | None = None):
        return A.idle_summary(hourly or self.hourly(), self.cfg, days, sizes=WH.latest_size(self.sq()))

    def projected(self, days: int = 30, hourly: DataFrame | None = None):
        # One row per warehouse, read by the projection and by the sizing.
        return self.stored(A.idle_projection(self.idle(days, hourly), days), "idle")

    def estimates(self, hourly: DataFrame | None = None):
        projected = self.projected(hourly=hourly)
        return A.idle_estimates(projected, A.rightsizing(projected))


def query(name: str, sql: str | None, as_of: date = AS_OF, extra: dict[str, str] | None = None):
    """Register a query; `sql` None means a rows-only check."""

    def register(build: Callable[[Env], DataFrame]):
        def run(spark: SparkSession, folder: str) -> DataFrame:
            # The load stamp is metadata of the run, not part of the result.
            return build(Env(spark, folder, as_of)).drop("_loaded_at")

        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = with_ctes(sql, as_of.isoformat(), extra)
        return build

    return register


def _csv_copy(e: Env, df: DataFrame, name: str) -> str:
    path = scratch_path(e.spark, name)
    df.write.option("header", True).csv(path)
    return path


def _tagged(parts: dict[str, DataFrame], column: str) -> DataFrame:
    """Row count and the sum of one column per frame."""
    counted = [
        df.agg(F.count(F.lit(1)).alias("row_count"), F.sum(F.col(column_of).cast("decimal(38,6)")).cast("decimal(38,6)").alias("total")).select(
            F.lit(name).alias(column), "row_count", "total"
        )
        for name, (df, column_of) in parts.items()
    ]
    return reduce(DataFrame.unionByName, counted)


# ================================ sources and sinks ==============================================

query("s01_read_metering", "select * from c_metering_h")(lambda e: e.metering())
query("s02_read_queries", "select * from c_queries_h")(lambda e: e.queries())
query("s03_read_storage", f"select * from c_storage where usage_date >= {ASOF} - 365")(
    lambda e: readers.read_storage(e.inputs.storage(), e.cfg)
)
# A blank field comes back from a CSV file trimmed to nothing, that is, as NULL or blank alike.
query("s04_read_department_map", f"select warehouse_name, {UNASSIGNED.format('department')} as department from c_map")(
    lambda e: readers.read_department_map(e.spark, _csv_copy(e, e.inputs.department_map(), "department-map")).withColumn(
        "department", X.department_or_unassigned(F.col("department"))
    )
)
query("s05_read_budget", "select * from c_budget")(
    lambda e: readers.read_budget(e.spark, _csv_copy(e, e.inputs.budget(), "budget"))
)
query("s06_conform_storage", "select * from c_storage")(lambda e: readers.conform_storage(e.inputs.raw_storage()))
query("s07_conform_queries", "select * from c_queries")(lambda e: readers.conform_queries(e.inputs.raw_queries()))
query(
    "s08_conform_metering",
    """select cast(start_time as timestamp) as start_time, cast(end_time as timestamp) as end_time,
              dense_rank() over (order by warehouse_name) as warehouse_id, warehouse_name, total_credits_used as credits_used,
              cast(round(total_credits_used * 0.95, 3) as decimal(18,3)) as credits_used_compute,
              cast(round(total_credits_used * 0.05, 3) as decimal(18,3)) as credits_used_cloud_services, total_cost_usd as total_cost
       from c_raw_metering""",
)(lambda e: readers.conform_metering(e.stored(e.inputs.raw_metering(), "raw-metering")))


_LOADED = f"""
    select 'metering' as input, count(*) as row_count, {usd('sum(credits_used_compute)')} as total from c_metering
    union all select 'queries', count(*), {usd('sum(total_elapsed_time)')} from c_queries
    union all select 'storage', count(*), {usd('sum(average_failsafe_bytes)')} from c_storage"""


@query("s09_load_inputs", _LOADED)
def _(e: Env) -> DataFrame:
    paths = {
        "metering": _csv_copy(e, e.inputs.raw_metering(), "metering"),
        "queries": _csv_copy(e, e.inputs.raw_queries(), "queries"),
        "storage": _csv_copy(e, e.inputs.raw_storage(), "storage"),
    }
    loaded = readers.load_inputs(e.spark, "demo", paths)
    columns = {"metering": "credits_used_compute", "queries": "total_elapsed_time", "storage": "average_failsafe_bytes"}
    return _tagged({name: (loaded[name], column) for name, column in columns.items()}, "input")


@query("s09_load_live", _LOADED)
def _(e: Env) -> DataFrame:
    """Live mode reads typed tables."""
    typed = {"metering": e.inputs.metering(), "queries": e.inputs.queries(), "storage": e.inputs.storage()}
    paths = {name: scratch_path(e.spark, name) for name in typed}
    for name, df in typed.items():
        df.write.parquet(paths[name])
    loaded = readers.load_inputs(e.spark, "live", paths)
    columns = {"metering": "credits_used_compute", "queries": "total_elapsed_time", "storage": "average_failsafe_bytes"}
    return _tagged({name: (loaded[name], column) for name, column in columns.items()}, "input")


@query(
    "s10_optional_inputs",
    f"""select 'attribution' as input, count(*) as row_count, {usd('sum(estimated_query_cost_usd)')} as total from c_attr
        union all select 'clustering', count(*), {usd('sum(credits_used)')} from c_clust""",
)
def _(e: Env) -> DataFrame:
    paths = {name: scratch_path(e.spark, name) for name in ("attribution", "clustering")}
    e.inputs.attribution().write.parquet(paths["attribution"])
    e.inputs.clustering().write.parquet(paths["clustering"])
    loaded = readers.optional_inputs(e.spark, **paths)
    columns = {"attribution": "estimated_query_cost_usd", "clustering": "credits_used"}
    return _tagged({name: (loaded[name], column) for name, column in columns.items()}, "input")


query("s11_write_table", "select * from c_daily")(
    lambda e: writers.write_table(e.daily(), scratch_path(e.spark, "fct_daily_costs"), "usage_date")
)


@query(
    "s12_write_insights_csv",
    """select scope, name, window_spend_usd, idle_usd_month_est, idle_share_pct, nullif(suggested_action, '') as suggested_action,
              vs_budget_pct from c_insights""",
)
def _(e: Env) -> DataFrame:
    path = scratch_path(e.spark, "insights")
    rows = _insights(e)
    writers.write_insights_csv(rows, path)
    return e.spark.read.option("header", True).schema(rows.schema).csv(path).withColumn(
        "suggested_action", F.nullif("suggested_action", F.lit(""))
    )


query("s13_write_clustered", "select * from c_sq")(
    lambda e: writers.write_clustered(e.sq(), scratch_path(e.spark, "stg_query_history"))
)
@query("s13_write_interleaved", "select * from c_sq")
def _(e: Env) -> DataFrame:
    """Clustered by warehouse and user at once, and merged into under the same layout's dates."""
    staged = e.stored(e.sq(), "staged")
    return writers.write_interleaved(staged, scratch_path(e.spark, "stg_query_history"))


query("s14_recent", f"select * from c_daily where usage_date >= {ASOF} - 21")(lambda e: readers.recent(e.daily(), e.cfg, 7))
query("s14_recent_departments", f"select * from c_dept where usage_date >= {ASOF} - 21")(
    lambda e: readers.recent(e.dept(), e.cfg, 7)
)
query("s15_warehouse_settings", "select upper(name) as name, auto_suspend, upper(size) as size from c_settings")(
    lambda e: readers.warehouse_settings(
        e.inputs.settings().withColumnsRenamed({"name": "NAME", "auto_suspend": "AUTO_SUSPEND", "size": "WAREHOUSE_SIZE"})
    )
)
query("s16_load_budget", "select date, trim(department) as department, budget_usd from c_budget")(
    lambda e: readers.load_budget(
        e.inputs.budget().where(F.col("date") < F.lit(date(2000, 1, 1))),
        lambda: readers.read_budget(e.spark, _csv_copy(e, e.inputs.budget(), "budget")),
    )
)



def _no_fallback() -> DataFrame:
    raise AssertionError("the primary budget has rows")


query("s16_load_primary_budget", "select date, trim(department) as department, budget_usd from c_budget")(
    lambda e: readers.load_budget(e.inputs.budget(), _no_fallback)
)

# ================================ staging and predicates =========================================

query("p01_stage_metering", "select * from c_sm")(lambda e: e.sm())
query(
    "p02_filter_compute_queries",
    "select * from c_queries_h where execution_status = 'SUCCESS' and warehouse_name is not null",
)(lambda e: ST.filter_compute_queries(e.queries()))
query("p03_stage_queries", "select * from c_sq")(lambda e: e.sq())
query(
    "p04_runtime_category",
    """select query_id, case when total_elapsed_time > 600000 then 'long_running'
                             when total_elapsed_time > 60000 then 'medium_running' else 'fast' end as runtime_category from c_queries""",
)(lambda e: e.inputs.queries().select("query_id", X.runtime_category(F.col("total_elapsed_time")).alias("runtime_category")))
query("p05_stage_storage", "select * from c_ss")(lambda e: e.ss())
query(
    "p06_size_credits",
    f"""select query_id, {LABEL_CREDITS.format("upper(replace(warehouse_size, ' ', '-'))")} as credits from c_queries""",
)(lambda e: e.inputs.queries().select("query_id", X.size_credits(X.size_label(F.col("warehouse_size"))).alias("credits")))
query("p07_dim_department", "select upper(trim(warehouse_name)) as warehouse_name, trim(department) as department from c_map")(
    lambda e: DEP.dim_department(e.inputs.department_map())
)
query("p08_department_or_unassigned", f"select warehouse_name, {UNASSIGNED.format('department')} as department from c_map")(
    lambda e: e.inputs.department_map().withColumn("department", X.department_or_unassigned(F.col("department")))
)
query(
    "p09_showback_department",
    f"""select s.name as warehouse_name, case when upper(s.name) = 'CLOUD_SERVICES_ONLY' then 'Overhead'
               else {UNASSIGNED.format('m.department')} end as department
        from c_settings s left join c_map m on s.name = m.warehouse_name""",
)(
    lambda e: e.inputs.settings()
    .select(F.col("name").alias("warehouse_name"))
    .join(e.inputs.department_map(), "warehouse_name", "left")
    .withColumn("department", X.showback_department(F.col("warehouse_name"), F.col("department")))
)
query("p10_idle_signal", "select warehouse_name, usage_hour_ntz, is_potentially_idle, idle_cost_usd from c_hourly")(
    lambda e: e.hourly().select("warehouse_name", "usage_hour_ntz", "is_potentially_idle", "idle_cost_usd")
)
query("p11_hourly_efficiency", "select warehouse_name, usage_hour_ntz, avg_cost_per_query, cost_per_runtime_hour from c_hourly")(
    lambda e: e.hourly().select("warehouse_name", "usage_hour_ntz", "avg_cost_per_query", "cost_per_runtime_hour")
)
query("p12_daily_efficiency", "select * from c_eff")(
    lambda e: D.daily_efficiency(D.daily_rollup(e.hourly())).withColumn(
        "compute_credits", F.col("compute_credits").cast("decimal(28,3)")
    )
)
query("p13_positive_costs", "select * from c_cats3 where cost_usd > 0")(lambda e: SUM.positive_costs(e.categories()))
query(
    "p14_warehouse_placeholders",
    f"select warehouse_name, warehouse_type, {', '.join(WH.PLACEHOLDERS)}, is_active from c_dimw",
)(lambda e: e.sizes().select("warehouse_name", "warehouse_type", *WH.PLACEHOLDERS, "is_active"))
query("p15_enforce_contract", "select * from c_sd")(lambda e: D.enforce_contract(e.sd(), STO.STORAGE_CONTRACT))
query(
    "p16_normalize",
    "select usage_date, warehouse_name, cast(total_cost as double) as total_cost, try_cast(daily_cost_key as double) as daily_cost_key from c_daily",
)(
    lambda e: readers.normalize(
        e.daily().select(*[F.col(c).alias(c.upper()) for c in ("usage_date", "warehouse_name", "total_cost", "daily_cost_key")]),
        ["total_cost", "daily_cost_key"],
    )
)

# ================================ joins ==========================================================

query(
    "j01_metering_activity",
    "select warehouse_name, usage_hour_ntz, queries_executed, total_runtime_seconds, gb_scanned, unique_users from c_joined",
)(
    lambda e: e.hourly().select(
        "warehouse_name", "usage_hour_ntz", "queries_executed", "total_runtime_seconds", "gb_scanned", "unique_users"
    )
)
query("j02_query_attribution", "select * from c_base")(lambda e: e.base())
query(
    "j03_primary_warehouse",
    "select s.usage_date, s.user_name, s.query_count, p.primary_warehouse_name from c_sp s left join c_primary p using (user_name, usage_date)",
)(lambda e: SP.spenders_daily(e.base()).select("usage_date", "user_name", "query_count", "primary_warehouse_name"))
query("j04_warehouse_size", "select m.*, s.warehouse_size from c_metered m left join c_size s on m.warehouse_name = s.warehouse_name")(
    lambda e: WH.last_metered(e.sm()).join(WH.latest_size(e.sq()), "warehouse_name", "left")
)
query(
    "j05_daily_department",
    """select f.usage_date, f.warehouse_name, f.total_cost, m.department from c_daily f
       left join c_map m on upper(f.warehouse_name) = upper(m.warehouse_name)""",
)(
    lambda e: DEP.with_department(e.daily(), e.inputs.department_map()).select(
        "usage_date", "warehouse_name", "total_cost", F.col("_department").alias("department")
    )
)
query("j06_budget_department", "select * from c_dept_actual")(
    lambda e: DEP.department_actuals(e.daily(), e.inputs.department_map())
)
query("j07_full_outer_budget", "select * from c_bva where actual_cost_usd = 0 or budget_usd = 0")(
    lambda e: e.bva().where((F.col("actual_cost_usd") == 0) | (F.col("budget_usd") == 0))
)
query("j08_dow_baseline", f"select warehouse_name, day_of_week, {nudge('dow_factor', 6)} as dow_factor from c_dow")(
    lambda e: FC.dow_factors(e.daily(), e.cfg).withColumn("dow_factor", X.nudge_round(F.col("dow_factor"), 6))
)
query("j09_spine_baseline", "select warehouse_name, observation_days, days_ahead, forecast_date from c_spine cross join c_baseline")(
    lambda e: FC.forecast_spine(FC.forecast_baseline(e.daily(), e.cfg), e.cfg).select(
        "warehouse_name", "observation_days", "days_ahead", "forecast_date"
    )
)
query("j10_forecast_season", "select warehouse_name, forecast_date, days_ahead, forecasted_cost_usd from c_fc")(
    lambda e: FC.cost_forecast(e.daily(), e.cfg).select("warehouse_name", "forecast_date", "days_ahead", "forecasted_cost_usd")
)


@query(
    "j11_backfill_warehouse_id",
    "select usage_hour_ntz, warehouse_name, warehouse_id, cost_hour_key from c_hourly",
)
def _(e: Env) -> DataFrame:
    hourly = e.hourly()
    before_cut = F.col("usage_hour_ntz") < F.lit(CUT).cast("timestamp_ntz")
    legacy = hourly.withColumn("warehouse_id", F.when(~before_cut, F.col("warehouse_id"))).withColumn(
        "cost_hour_key", F.when(~before_cut, F.col("cost_hour_key"))
    )
    return I.backfill_warehouse_id(legacy, e.sm()).select("usage_hour_ntz", "warehouse_name", "warehouse_id", "cost_hour_key")


_RANKED_DEPT = f"""
    select t.name, t.value, case when sum(t.value) over () > 0 then {pct('t.value', 'sum(t.value) over ()')}
           else cast(0 as decimal(38,2)) end as share,
           case when b.budget_window_usd > 0 then {pct('t.value - b.budget_window_usd', 'b.budget_window_usd')} end as delta_pct
    from (select department as name, {usd('sum(total_cost_usd)')} as value from c_dept_win group by 1 order by value desc, name limit {{n}}) t
    left join c_budget_win b on t.name = b.department"""
query("j12_ranked_budget", _RANKED_DEPT.format(n=15))(
    lambda e: A.ranked_list(
        A.window_slice(e.dept(), e.cfg, 30), "department", "total_cost_usd", 15, A.budget_window(e.inputs.budget(), e.cfg, 30)
    )
)


def _insights(e: Env) -> DataFrame:
    hourly = e.stored(e.hourly(), "hourly")
    # The columns that the report reads, without the running and moving figures.
    used = ("usage_date", "warehouse_name", "compute_cost", "idle_cost", "total_cost")
    daily = e.stored(D.daily_costs(hourly, e.cfg).select(*used), "daily")
    departments = DEP.cost_by_department(daily, e.inputs.department_map())
    return A.insights(daily, departments, e.inputs.budget(), e.estimates(hourly), e.cfg, 30)


query("j13_spend_idle", "select name, window_spend_usd, idle_usd_month_est, idle_share_pct from c_insights where scope = 'warehouse'")(
    lambda e: _insights(e)
    .where(F.col("scope") == "warehouse")
    .select("name", "window_spend_usd", "idle_usd_month_est", "idle_share_pct")
)
query("j14_idle_sizing", "select * from c_est")(lambda e: e.estimates())

# ================================ aggregations ===================================================

query("a01_query_activity", "select * from c_act")(lambda e: H.query_activity(e.sq()))
query("a02_daily_rollup", "select * from c_roll")(
    lambda e: D.daily_rollup(e.hourly()).withColumn("compute_credits", F.col("compute_credits").cast("decimal(28,3)"))
)
query("a03_top_spenders_base", "select * from c_base0")(lambda e: SP.top_spenders_base(e.sq()))
query("a04_spenders_daily", "select * from c_sp")(lambda e: SP.spenders_daily(e.base()).drop("primary_warehouse_name"))
query("a05_cost_by_department", "select * from c_dept")(lambda e: e.dept())
query("a06_department_actuals", "select * from c_dept_actual")(
    lambda e: DEP.department_actuals(e.daily(), e.inputs.department_map())
)
query("a07_last_metered", "select * from c_metered")(lambda e: WH.last_metered(e.sm()))
query("a08_primary_warehouse", "select * from c_primary")(lambda e: SP.primary_warehouse(e.base()))
query(
    "a09_forecast_baseline",
    f"""select warehouse_name, observation_days, {', '.join(nudge(c, 4) + ' as ' + c for c in
        ('avg_daily_cost', 'stddev_daily_cost', 'last_7d_avg', 'prev_7d_avg', 'trend_slope_per_day'))} from c_baseline""",
)(
    lambda e: FC.forecast_baseline(e.daily(), e.cfg).select(
        "warehouse_name",
        "observation_days",
        *[
            X.nudge_round(F.col(c), 4).alias(c)
            for c in ("avg_daily_cost", "stddev_daily_cost", "last_7d_avg", "prev_7d_avg", "trend_slope_per_day")
        ],
    )
)
query("a10_dow_factors", f"select warehouse_name, day_of_week, {nudge('dow_factor', 6)} as dow_factor from c_dow")(
    lambda e: FC.dow_factors(e.daily(), e.cfg).withColumn("dow_factor", X.nudge_round(F.col("dow_factor"), 6))
)
query("a11_category_compute", "select * from c_cat_compute")(lambda e: SUM.category_compute(e.daily()))
query("a12_category_storage", "select * from c_cat_storage")(lambda e: SUM.category_storage(e.sd()))
query("a13_category_clustering", "select * from c_cat_clust")(
    lambda e: SUM.category_clustering(e.inputs.clustering(), e.cfg)
)
def _marks(staged: DataFrame) -> DataFrame:
    found = [(I.high_water_mark(staged, "usage_hour_ntz", "usage_date"), I.high_water_mark(staged, "usage_date"))]
    return staged.sparkSession.createDataFrame(found, "high_water_mark timestamp_ntz, last_date date")


query("a14_high_water_mark", "select max(usage_hour_ntz) as high_water_mark, max(usage_date) as last_date from c_sq")(
    lambda e: _marks(e.stored(e.sq(), "staged"))
)


def _amounts(e: Env) -> DataFrame:
    return e.inputs.table("events").withColumn("amount", F.col("value").cast("decimal(18,2)"))


@query(
    "a15_profile_by_key",
    f"""select event_type, count(*) as row_count, {usd('sum(cast(value as decimal(18,2)))')} as total_amount,
               {half_up('sum(cast(value as decimal(18,2))) * 100', 'count(*) * 100', 6)} as avg_amount,
               {nudge('stddev_samp(value)', 6)} as stddev_amount, count(distinct props) as items, true as within_error from events group by 1""",
)
def _(e: Env) -> DataFrame:
    """The profile with the exact count of items beside the estimate, which must lie within its error of it."""
    rows = _amounts(e)
    exact = rows.groupBy("event_type").agg(F.countDistinct("props").alias("items"))
    profile = A.profile_by_key(rows, "event_type", "amount", "props").withColumn("stddev_amount", X.nudge_round(F.col("stddev_amount"), 6))
    found = profile.join(exact, "event_type")
    # approx_count_distinct is asked for its default relative deviation, 5 %.
    return found.withColumn("within_error", H.within_error(F.col("approx_items"), F.col("items"), 0.05)).drop("approx_items")


@query(
    "a15_users_from_sketches",
    """select warehouse_name, cast(date_trunc('month', usage_date) as date) as month, count(*) as query_count,
              count(distinct user_name) as users, true as within_error from c_sq group by 1, 2""",
)
def _(e: Env) -> DataFrame:
    """Users per warehouse and month from hourly sketches of two deliveries; the log is read for changed dates only."""
    staged = e.stored(e.sq(), "staged")

    def refresh(root: str, log: DataFrame, path: str, changed: list | None) -> DataFrame:
        return CON.refresh_dates(e.spark, f"{root}/sketches", H.activity_sketches, log, path, changed)

    month = F.trunc("usage_date", "month").alias("month")
    merged = H.activity_from_sketches(_two_deliveries(e, refresh, staged, "query_id"), "warehouse_name", month)
    exact = staged.groupBy("warehouse_name", month).agg(F.countDistinct("user_name").alias("users"))
    found = merged.join(exact, ["warehouse_name", "month"])
    return found.withColumn("within_error", H.within_error(F.col("approx_users"), F.col("users"))).drop("approx_users")


query(
    "a15_profile_exact",
    f"""select event_type, count(*) as row_count, {usd('sum(cast(value as decimal(18,2)))')} as total_amount,
               {half_up('sum(cast(value as decimal(18,2))) * 100', 'count(*) * 100', 6)} as avg_amount,
               {nudge('stddev_samp(value)', 6)} as stddev_amount from events group by 1""",
)(
    lambda e: A.profile_by_key(_amounts(e), "event_type", "amount", "props")
    .drop("approx_items")
    .withColumn("stddev_amount", X.nudge_round(F.col("stddev_amount"), 6))
)
query("a15_count_by_hour", "select date_trunc('hour', ts) as created_hour, count(*) as row_count from events group by 1")(
    lambda e: A.count_by_hour(e.inputs.table("events"), "ts")
)
query(
    "a15_rollup_by_day",
    f"""select event_type, cast(date_trunc('day', ts) as timestamp) as created_date, count(*) as row_count,
               {usd('sum(cast(value as decimal(18,2)))')} as total_amount from events group by 1, 2""",
)(lambda e: A.rollup_by_day(_amounts(e), "event_type", "ts", "amount"))
query("a16_idle_summary", "select * from c_idle")(lambda e: e.idle())
query(
    "a17_forecast_by_date",
    f"""select forecast_date, {usd('sum(forecasted_cost_usd)')} as forecasted, {usd('sum(confidence_band_low)')} as low,
               {usd('sum(confidence_band_high)')} as high from c_fc group by 1""",
)(lambda e: A.forecast_by_date(FC.cost_forecast(e.daily(), e.cfg)))
query(
    "a18_actuals_by_date",
    f"select usage_date, {usd('sum(total_cost)')} as total_cost from c_daily where usage_date >= {ASOF} - 30 group by 1",
)(lambda e: A.actuals_by_date(e.daily(), e.cfg))
query(
    "a19_storage_by_date",
    """select usage_date, cast(sum(estimated_active_cost_usd) as decimal(38,9)) as active, cast(sum(estimated_failsafe_cost_usd) as decimal(38,9)) as failsafe,
              cast(sum(estimated_stage_cost_usd) as decimal(38,9)) as stage from c_sd group by 1""",
)(lambda e: A.storage_by_date(e.sd()))
query("a20_budget_window", "select * from c_budget_win")(lambda e: A.budget_window(e.inputs.budget(), e.cfg, 30))
_RUN_RATE = f"""
    select trim(m.department) as department, {half_up('sum(r.total_cost_usd) * 100', '30 * 100', 6)} as daily_cost_usd
    from c_raw_metering r join c_map m on upper(trim(r.warehouse_name)) = upper(trim(m.warehouse_name))
    where trim(m.department) <> '' and cast(cast(r.start_time as timestamp) as date) >
          (select max(cast(cast(start_time as timestamp) as date)) from c_raw_metering) - 30 group by 1"""


def _run_rate(e: Env) -> DataFrame:
    return A.department_run_rate(e.stored(e.inputs.raw_metering(), "raw-metering"), e.inputs.department_map())


query("a21_department_run_rate", _RUN_RATE)(_run_rate)
query(
    "a22_latest",
    "select 'metering' as input, cast(max(end_time) as timestamp) as latest from c_metering union all select 'budget', cast(max(usage_date) as timestamp) from c_bva",
)(
    lambda e: A.latest(e.inputs.metering(), "end_time")
    .select(F.lit("metering").alias("input"), "latest")
    .unionByName(A.latest(e.bva(), "usage_date").select(F.lit("budget").alias("input"), F.col("latest").cast("timestamp_ntz").alias("latest")))
)
query(
    "a23_department_fallback",
    f"""select coalesce(m.department, 'Unassigned') as department, f.usage_date, {usd('sum(f.compute_cost + f.idle_cost)')} as total_cost_usd
        from c_daily f left join c_map m on upper(f.warehouse_name) = upper(m.warehouse_name) group by 1, 2""",
)(lambda e: DEP.department_fallback(e.daily(), e.inputs.department_map()))

# ================================ window functions ===============================================


def _daily_columns(*columns: str):
    return lambda e: e.daily().select("usage_date", "warehouse_name", *columns)


for _id, _column in (
    ("w01_month_to_date", "month_to_date_cost"),
    ("w02_moving_average_7", "cost_7day_avg"),
    ("w03_day_over_day", "day_over_day_change"),
    ("w04_week_over_week", "week_over_week_change"),
):
    query(_id, f"select usage_date, warehouse_name, {_column} from c_daily")(_daily_columns(_column))

for _id, _column in (("w05_storage_month_to_date", "month_to_date_storage_cost"), ("w06_storage_average_30", "storage_cost_30day_avg")):
    query(_id, f"select usage_date, database_name, {_column} from c_sd")(
        lambda e, c=_column: e.sd().select("usage_date", "database_name", c)
    )

for _id, _column, _value in (
    ("w07_rank_by_query_count", "rank_by_query_count", lambda: R.sortable(F.col("query_count"))),
    ("w08_rank_by_runtime", "rank_by_runtime", lambda: R.sortable(F.col("total_runtime_seconds"), 3, nulls="first")),
    ("w09_rank_by_cost", "rank_by_cost", lambda: R.sortable(F.col("estimated_cost_usd"), 6)),
):

    def _rank(e: Env, column=_column, value=_value) -> DataFrame:
        spenders = e.stored(SP.spenders_daily(e.base()), "spenders")
        ranks = R.descending_ranks(spenders, "usage_date", value())
        return R.add_rank(spenders, ranks, "usage_date", value(), column).select("usage_date", "user_name", column)

    query(_id, f"select usage_date, user_name, {_column} from c_ranked")(_rank)

for _id, _column in (
    ("w10_share_of_queries", "pct_of_daily_query_total"),
    ("w11_share_of_cost", "pct_of_daily_cost"),
    ("w12_rolling_7d_cost", "rolling_7d_cost_usd"),
):
    query(_id, f"select usage_date, user_name, {_column} from c_ranked")(
        lambda e, c=_column: SP.top_spenders(e.base()).select("usage_date", "user_name", c)
    )

for _id, _column in (("w13_category_share", "pct_of_daily_total"), ("w14_category_month_to_date", "mtd_cost_usd")):
    query(_id, f"select usage_date, cost_category, {_column} from c_sum3")(
        lambda e, c=_column: SUM.with_shares(SUM.positive_costs(e.categories())).select("usage_date", "cost_category", c)
    )
query("w15_latest_size", "select * from c_size")(lambda e: WH.latest_size(e.sq()))
query(
    "w16_dense_index",
    """select user_name, dense_rank() over (order by user_name) as user_number
       from (select distinct 'user_' || user_id as user_name from events)""",
)(lambda e: R.dense_index(e.inputs.queries(), "user_name", "user_number"))
query("w17_forecast_spine", "select warehouse_name, days_ahead, forecast_date from c_metered cross join c_spine")(
    lambda e: FC.forecast_spine(WH.last_metered(e.sm()), e.cfg).select("warehouse_name", "days_ahead", "forecast_date")
)

# ================================ sorts and top-N ================================================

query("t01_budget_ordered", "select * from c_bva order by usage_date, department")(
    lambda e: e.bva().orderBy("usage_date", "department")
)
query("t02_ranked_list", _RANKED_DEPT.format(n=3))(
    lambda e: A.ranked_list(
        A.window_slice(e.dept(), e.cfg, 30), "department", "total_cost_usd", 3, A.budget_window(e.inputs.budget(), e.cfg, 30)
    )
)
query(
    "t02_ranked_warehouses",
    f"""select name, value, case when sum(value) over () > 0 then {pct('value', 'sum(value) over ()')}
               else cast(0 as decimal(38,2)) end as share, cast(null as decimal(38,2)) as delta_pct
        from (select warehouse_name as name, {usd('sum(total_cost)')} as value from c_daily_win group by 1 order by value desc, name limit 8)""",
)(lambda e: A.ranked_list(A.window_slice(e.daily(), e.cfg, 30), "warehouse_name", "total_cost"))
query(
    "t03_top_databases",
    "select database_name, cast(sum(estimated_storage_cost_usd) as decimal(38,9)) as cost from c_sd group by 1 order by cost desc, database_name limit 3",
)(lambda e: A.top_databases(e.sd(), 3))
_TOP_USERS = f"""
    select user_name, cast(sum(query_count) as bigint) as queries, {half_up('sum(total_runtime_seconds) * 1000', '3600 * 1000', 1)} as runtime_hrs,
           round(sum(gb_scanned), 1) as gb_scanned, {usd('coalesce(sum(estimated_cost_usd), 0)')} as est_cost
    from {{src}} group by 1 order by {{order}}, user_name limit 8"""
query("t04_top_users", _TOP_USERS.format(src="c_sp", order="est_cost desc, runtime_hrs desc"))(
    lambda e: A.top_users(SP.spenders_daily(e.base()))
)
query("t04_top_users_volume", _TOP_USERS.format(src="c_sp0", order="runtime_hrs desc"))(
    lambda e: A.top_users(SP.spenders_daily(SP.top_spenders_base(e.sq())))
)


def _idle_table(e: Env) -> DataFrame:
    projected = e.projected()
    return A.idle_table(projected, A.rightsizing(projected), 5)


query("t05_idle_table", "select * from c_est order by idle_usd_month_est desc, warehouse_name limit 5")(_idle_table)
query(
    "t06_department_series",
    f"""select department, usage_date as date, total_cost_usd as usd, department =
               (select department from c_dept where usage_date between {ASOF} - 29 and {ASOF} - 1
                group by 1 order by sum(total_cost_usd) desc, department limit 1) as is_primary
        from c_dept where usage_date between {ASOF} - 29 and {ASOF} - 1""",
)(lambda e: A.department_series(e.stored(e.dept(), "dept"), e.cfg, 30))


def _probe(name: str, df: DataFrame) -> DataFrame:
    return df.limit(1).agg((F.count(F.lit(1)) > 0).alias("has_rows")).select(F.lit(name).alias("table_name"), "has_rows")


query(
    "t07_has_rows",
    f"""select 'metering' as table_name, count(*) > 0 as has_rows from c_metering
        union all select 'late_metering', count(*) > 0 from c_metering where start_time > {ASOF} + interval 30 day""",
)(
    lambda e: _probe("metering", e.inputs.metering()).unionByName(
        _probe("late_metering", e.inputs.metering().where(F.col("start_time") > F.lit(datetime(2024, 3, 1)).cast("timestamp_ntz")))
    )
)

# ================================ set operations =================================================

query("u01_union_categories", "select * from c_cats3")(lambda e: e.categories())
query("u02_union_insights", "select * from c_insights")(_insights)
_DIAGNOSTICS = f"""
    select 'fct_daily_costs' as table_name, case when max(usage_date) is null then 'Missing' else 'OK' end as status, count(*) as row_count,
           max(usage_date) as latest from c_daily
    union all select 'fct_cost_by_department', case when max(usage_date) is null then 'Missing' else 'OK' end, count(*), max(usage_date) from c_dept
    union all select 'budget_daily', case when max(date) is null then 'Missing' else 'OK' end, count(*), max(date) from c_budget
    union all select 'fct_daily_storage_costs', case when max(usage_date) is null then 'Missing' else 'OK' end, count(*), max(usage_date) from c_sd
    union all select 'fct_cost_forecast', case when max(forecast_date) is null then 'Missing' else 'OK' end, count(*), max(forecast_date) from c_fc
    union all select 'future_costs', 'Missing', count(*), max(usage_date) from c_daily where usage_date > {ASOF} + 1
    union all select 'absent', 'Missing', 0, null"""


def _diagnostics(e: Env) -> DataFrame:
    daily = e.stored(e.daily(), "daily")
    return Q.table_diagnostics(
        {
            "fct_daily_costs": (daily, "usage_date"),
            "fct_cost_by_department": (DEP.cost_by_department(daily, e.inputs.department_map()), "usage_date"),
            "budget_daily": (e.inputs.budget(), "date"),
            "fct_daily_storage_costs": (e.sd(), "usage_date"),
            "fct_cost_forecast": (FC.cost_forecast(daily, e.cfg), "forecast_date"),
            "future_costs": (daily.where(F.col("usage_date") > F.lit(date(2024, 2, 1))), "usage_date"),
            "absent": (None, "usage_date"),
        }
    )


query("u03_union_status", _DIAGNOSTICS)(_diagnostics)

# ================================ scalar functions ===============================================


def _events(e: Env) -> DataFrame:
    return e.inputs.table("events")


query(
    "f01_bucket",
    """select event_id, date_trunc('hour', ts) as hour, cast(date_trunc('day', ts) as timestamp) as day,
              cast(date_trunc('month', ts) as timestamp) as month from events""",
)(lambda e: _events(e).select("event_id", *[X.bucket(F.col("ts"), u).alias(u) for u in ("hour", "day", "month")]))
query(
    "f02_shift",
    """select event_id, ts - interval 1 hour as hour_before, ts - interval 30 day as month_before,
              cast(ts as date) + 7 as week_after from events""",
)(
    lambda e: _events(e).select(
        "event_id",
        X.shift(F.col("ts"), -1, "hour").alias("hour_before"),
        X.shift(F.col("ts"), -30, "day").alias("month_before"),
        X.shift(X.day_of(F.col("ts")), 7, "date").alias("week_after"),
    )
)
query("f03_dow", "select event_id, cast(dayofweek(ts) + 1 as integer) as day_of_week from events")(
    lambda e: _events(e).select("event_id", X.dow(F.col("ts")).alias("day_of_week"))
)
query("f04_load_stamp", "select event_id, timestamp '2024-01-31 00:00:00' as loaded from events")(
    lambda e: _events(e).select("event_id", X.load_stamp(e.cfg).alias("loaded"))
)
query(
    "f05_to_ntz",
    """select event_id, ts as parsed, date_trunc('hour', ts) as hour, try_cast(event_type as timestamp) as unreadable,
              cast(ts as date) as day from events""",
)(
    lambda e: _events(e).select(
        "event_id",
        X.to_ntz(F.col("ts").cast("string")).alias("parsed"),
        X.ntz_hour(F.col("ts").cast("string")).alias("hour"),
        X.to_ntz(F.col("event_type")).alias("unreadable"),
        F.col("ts").cast("string").try_cast("date").alias("day"),
    )
)
query(
    "f06_clean_name",
    "select event_id, upper(trim('  ' || event_type || ' ')) as name, upper(replace('x ' || event_type, ' ', '-')) as label from events",
)(
    lambda e: _events(e).select(
        "event_id",
        X.clean_name(F.concat(F.lit("  "), "event_type", F.lit(" "))).alias("name"),
        X.size_label(F.concat(F.lit("x "), "event_type")).alias("label"),
    )
)
query(
    "f07_meter_key",
    """select event_id, case when event_type <> 'error' then (user_id % 9) || '|' || strftime(date_trunc('hour', ts), '%Y-%m-%d %H:%M:%S') end
              as metering_id from events""",
)(
    lambda e: _events(e).select(
        "event_id",
        X.meter_key(F.when(F.col("event_type") != "error", F.col("user_id") % 9), X.bucket(F.col("ts"))).alias("metering_id"),
    )
)
query("f08_surrogate_key", f"""select event_id, {key("nullif(event_type, 'error')", 'cast(ts as date)', 'user_id')} as row_key from events""")(
    lambda e: _events(e).select(
        "event_id",
        X.surrogate_key(F.nullif("event_type", F.lit("error")), X.day_of(F.col("ts")), F.col("user_id")).alias("row_key"),
    )
)
query("f09_coalesce_nullif", f"""select event_id, {UNASSIGNED.format("nullif(event_type, 'error')")} as department from events""")(
    lambda e: _events(e).select(
        "event_id", X.department_or_unassigned(F.nullif("event_type", F.lit("error"))).alias("department")
    )
)
query(
    "f10_greatest_least",
    """select event_id, case when event_type <> 'error' then greatest(user_id, 10) end as high,
              case when event_type <> 'error' then least(user_id, 10) end as low from events""",
)(
    lambda e: _events(e)
    .withColumn("n", F.when(F.col("event_type") != "error", F.col("user_id")))
    .select(
        "event_id",
        X.strict_greatest(F.col("n"), F.lit(10).cast("bigint")).alias("high"),
        X.strict_least(F.col("n"), F.lit(10).cast("bigint")).alias("low"),
    )
)
query(
    "f11_rounding",
    f"""select o_orderkey, {half_up('cast(o_totalprice as decimal(18,2)) * 100', '(o_custkey + 7) * 100', 6)} as per_customer,
               {nudge('o_totalprice / 7e0', 2)} as seventh, {nudge('sqrt(o_totalprice)', 6)} as root from orders""",
)(
    lambda e: e.inputs.table("orders").select(
        "o_orderkey",
        X.exact_div(X.money(F.col("o_totalprice").cast("decimal(18,2)")), X.whole(F.col("o_custkey") + 7), 6).alias("per_customer"),
        X.nudge_round(F.col("o_totalprice") / 7.0, 2).alias("seventh"),
        X.nudge_round(F.sqrt("o_totalprice"), 6).alias("root"),
    )
)
# Quotients beyond a bigint at six decimals.
query(
    "f11_large_quotient",
    f"""select o_orderkey, {half_up('cast(o_totalprice as decimal(18,2)) * 100 * 10000000000', '(o_custkey % 7 + 1) * 100', 6)} as share from orders""",
)(
    lambda e: e.inputs.table("orders").select(
        "o_orderkey",
        X.exact_div(
            (F.col("o_totalprice").cast("decimal(18,2)") * F.lit(Decimal(10**10))).cast("decimal(28,2)"), X.whole(F.col("o_custkey") % 7 + 1), 6
        ).alias("share"),
    )
)
query(
    "f12_conditional_sum",
    """select event_type, cast(sum(case when value > 10 then 1 else 0 end) as bigint) as large,
              cast(sum(case when value <= 10 then 1 else 0 end) as bigint) as small from events group by 1""",
)(
    lambda e: _events(e)
    .groupBy("event_type")
    .agg(
        F.sum(F.when(F.col("value") > 10, 1).otherwise(0)).alias("large"),
        F.sum(F.when(F.col("value") <= 10, 1).otherwise(0)).alias("small"),
    )
)
query("f13_stddev", f"select event_type, {nudge('stddev_samp(value)', 6)} as deviation from events group by 1")(
    lambda e: _events(e).groupBy("event_type").agg(X.nudge_round(F.stddev_samp("value"), 6).alias("deviation"))
)
query(
    "f14_casts",
    """select event_id, cast(ts as date) as day, cast(event_id as varchar) as text, cast(value as decimal(38,6)) as amount,
              cast(user_id as integer) as number, event_type = 'error' as flag from events""",
)(
    lambda e: _events(e).select(
        "event_id",
        F.col("ts").cast("date").alias("day"),
        F.col("event_id").cast("string").alias("text"),
        F.col("value").cast("decimal(38,6)").alias("amount"),
        F.col("user_id").cast("int").alias("number"),
        (F.col("event_type") == "error").alias("flag"),
    )
)
query("f15_spine", f"select r_name, {ASOF} + cast(d as integer) as date from region, range(1, 31) t(d)")(
    lambda e: e.inputs.table("region").select("r_name", F.explode(X.spine(F.lit(e.cfg.as_of), 1, 30)).alias("date"))
)
query(
    "f16_clip",
    """select event_id, greatest(0, least(100, cast(value as decimal(18,2)))) as clipped, case when value > 50 then 'high' else 'low' end as band
       from events""",
)(
    lambda e: _events(e).select(
        "event_id",
        X.clip(F.col("value").cast("decimal(18,2)"), Decimal("0.00"), Decimal("100.00")).cast("decimal(18,2)").alias("clipped"),
        X.pick(F.col("value") > 50, F.lit("high"), F.lit("low")).alias("band"),
    )
)

# ================================ incremental loads ==============================================


def _old(df: DataFrame, column: str = "usage_hour_ntz") -> DataFrame:
    """The state of a table as of the cut."""
    return df.where(F.col(column) <= F.lit(CUT).cast("timestamp_ntz"))


query(
    "i01_since_watermark",
    f"""select * from c_queries_h where date_trunc('hour', end_time) >=
        (select max(usage_hour_ntz) from c_sq where usage_hour_ntz <= {CUT_SQL}) - interval 1 hour""",
)(lambda e: I.since_watermark(e.queries(), _old(e.sq())))


@query("i01_streamed_activity", "select * from c_act")
def _(e: Env) -> DataFrame:
    """The log as files that land out of order, through the stream: exact users, late rows counted in after all.

    A last file with one row of far later time closes the newest hours.
    """
    staged = e.stored(e.sq(), "staged")
    root = scratch_path(e.spark, "stream")
    day = F.dayofmonth("usage_hour_ntz")
    late = (F.col("query_id").cast("bigint") % 50 == 0) & day.between(3, 9)
    closing = staged.limit(1).withColumns({"end_time": F.lit(datetime(2030, 1, 1)).cast("timestamp_ntz"), "warehouse_name": F.lit("-")})
    for rows in (staged.where((day <= 10) & ~late), staged.where((day > 10) & ~late), staged.where(late), closing):
        rows.coalesce(1).write.mode("append").parquet(f"{root}/landing")
    hours, kept = ING.streamed_activity(e.spark, f"{root}/landing", root, staged.schema)
    return ING.corrected_activity(hours, kept, staged)


@query("i02_upsert", f"""
    select * replace (case when usage_hour_ntz >= {CUT_SQL} - interval 1 hour then 'MERGED' else role_name end as role_name) from c_sq""")
def _(e: Env) -> DataFrame:
    """Two deliveries merged: the second repeats the lookback hours with changed rows, twice over."""
    staged = e.stored(e.sq(), "staged")
    since = F.col("usage_hour_ntz") >= F.lit(datetime(2024, 1, 20, 11)).cast("timestamp_ntz")
    batch = staged.where(since).withColumn("role_name", F.lit("MERGED"))
    stale = staged.where(since).withColumn("_loaded_at", F.col("_loaded_at") - F.expr("interval 1 day"))
    return I.upsert(_old(staged), batch.unionByName(stale), "query_id", ["_loaded_at"])


@query("i02_upsert_table", "select * from c_sq")
def _(e: Env) -> DataFrame:
    """The same on stored tables: only the dates the batch touches are rewritten."""
    staged = e.stored(e.sq(), "staged")
    path = scratch_path(e.spark, "stg_query_history")
    target = writers.write_clustered(_old(staged), path)
    batch = I.since_watermark(staged, target, partition_by="usage_date")
    merged = I.upsert_table(e.spark, path, batch, "query_id", ["_loaded_at", "end_time"], sort_by="warehouse_name")
    return merged.select(*staged.columns)


def _merged_with(e: Env, column: str) -> DataFrame:
    """Two deliveries of a log in which every fiftieth statement has no date or no id, merged on disk."""
    hole = F.col("query_id").cast("bigint") % 50 == 0
    staged = e.stored(e.sq().withColumn(column, F.when(~hole, F.col(column))), "staged")
    path = scratch_path(e.spark, "stg_query_history")
    I.upsert_table(e.spark, path, _old(staged), "query_id", ["_loaded_at", "end_time"], sort_by="warehouse_name")
    since = F.col("usage_hour_ntz") >= F.lit(datetime(2024, 1, 20, 11)).cast("timestamp_ntz")
    for _ in range(2):  # the second time stands for a replay
        merged = I.upsert_table(e.spark, path, staged.where(since), "query_id", ["_loaded_at", "end_time"], sort_by="warehouse_name")
    return merged.select(*staged.columns)


MOVED_SQL = "case when cast(query_id as bigint) % 40 = 0 and usage_date <= date '2024-01-10' then {0} + interval 12 day else {0} end"


@query("i02_moved_dates", f"""
    select * replace (cast({MOVED_SQL.format('usage_date')} as date) as usage_date, {MOVED_SQL.format('usage_hour_ntz')} as usage_hour_ntz) from c_sq""")
def _(e: Env) -> DataFrame:
    """Statements that come again under another date: their old dates are found by the key index."""
    staged = e.stored(e.sq(), "staged")
    path = scratch_path(e.spark, "stg_query_history")
    writers.write_clustered(staged, path)
    moved = staged.where((F.col("query_id").cast("bigint") % 40 == 0) & (F.col("usage_date") <= F.lit(date(2024, 1, 10))))
    later = {c: F.col(c) + F.expr("interval 12 day") for c in ("usage_hour_ntz", "usage_date")}
    moved = moved.withColumns({**later, "usage_date": F.date_add("usage_date", 12)})
    order = ["_loaded_at", "end_time"]
    I.upsert_table(e.spark, path, moved, "query_id", order, sort_by="warehouse_name")
    return I.upsert_table(e.spark, path, moved, "query_id", order, sort_by="warehouse_name").select(*staged.columns)


_HOLE = "case when cast(query_id as bigint) % 50 = 0 then null else {0} end as {0}"
query("i02_upsert_null_date", f"select * replace ({_HOLE.format('usage_date')}) from c_sq")(
    lambda e: _merged_with(e, "usage_date")
)
query("i02_upsert_null_key", f"select * replace ({_HOLE.format('query_id')}) from c_sq")(
    lambda e: _merged_with(e, "query_id")
)


@query("i04_legacy_tables", "select * from c_hourly")
def _(e: Env) -> DataFrame:
    """Stored tables of an older version (no hour bucket, no warehouse id), brought up to date by one run."""
    root = scratch_path(e.spark, "legacy")
    # The log grows without bound: its old rows are written once, in their place, and read from there.
    metering = e.stored(_old(e.sm()), "metering")
    log = writers.write_clustered(_old(e.sq()).drop("usage_hour_ntz"), f"{root}/stg_query_history")
    hourly = H.hourly_costs(metering, I.backfill(log), e.cfg)
    writers.write_table(metering.drop("usage_hour_ntz"), f"{root}/stg_warehouse_metering", "usage_date")
    old_hourly = hourly.drop("usage_hour_ntz").withColumn("warehouse_id", F.lit(None).cast("bigint"))
    writers.write_table(old_hourly, f"{root}/int_hourly_compute_costs", "usage_date")
    loaded = marts.load_incremental(e.spark, root, e.sources(), e.cfg)
    return loaded["int_hourly_compute_costs"].select(*hourly.columns)


query(
    "i03_fallback_watermark",
    f"""select * from c_queries_h where end_time >=
        (select cast(max(usage_date) as timestamp) from c_sq where usage_hour_ntz <= {CUT_SQL}) - interval 1 day""",
)(lambda e: I.since_watermark(e.queries(), _old(e.sq()).drop("usage_hour_ntz")))


@query("i04_backfill", "select query_id, end_time, usage_hour_ntz, usage_date from c_sq")
def _(e: Env) -> DataFrame:
    """A target whose older rows lack the hour and which has no date column at all."""
    before = F.col("end_time") < F.lit(CUT).cast("timestamp_ntz")
    legacy = e.sq().select("query_id", "end_time", F.when(~before, F.col("usage_hour_ntz")).alias("usage_hour_ntz"))
    return I.backfill(legacy)


@query(
    "i05_sync_schema",
    f"""select query_id, case when usage_hour_ntz > {CUT_SQL} then user_name end as user_name, end_time,
               case when usage_hour_ntz <= {CUT_SQL} then role_name end as role_name from c_sq""",
)
def _(e: Env) -> DataFrame:
    staged = e.sq()
    new = staged.where(F.col("usage_hour_ntz") > F.lit(CUT).cast("timestamp_ntz"))
    target, batch = I.sync_schema(
        _old(staged).select("query_id", "role_name", "end_time"), new.select("query_id", "user_name", "end_time")
    )
    return target.unionByName(batch)


query("i06_storage_watermark", "select * from c_storage where usage_date > date '2024-01-20'")(
    lambda e: I.since_watermark(
        readers.read_storage(e.inputs.storage(), e.cfg, full=False),
        e.ss().where(F.col("usage_date") <= F.lit(date(2024, 1, 20))),
        (I.STORAGE_WATERMARK,),
        "usage_date",
    )
)


@query("i07_hourly_incremental", "select * from c_hourly")
def _(e: Env) -> DataFrame:
    """Old hours kept, lookback hours and later recomputed; the result equals one full build."""
    metering, staged = e.stored(e.sm(), "metering"), e.stored(e.sq(), "staged")
    target = e.stored(H.hourly_costs(_old(metering), _old(staged), e.cfg), "hourly")
    batch = I.hourly_costs_incremental(metering, staged, target, e.cfg)
    return I.upsert(target, batch, "cost_hour_key", ["_loaded_at"])


# ================================ marts refreshed by what changed ================================


def _two_deliveries(e: Env, refresh: Callable[[str, DataFrame, str, list | None], DataFrame], rows: DataFrame, key: str | None = None) -> DataFrame:
    """A table stored up to the cut and refreshed, then merged with what came later and refreshed again.

    `refresh(root, table, path, changed)` brings the marts under `root` up to date. Later rows are told by hour or,
    where there is none, by date; some rows of the first delivery come again with them.
    """
    root = scratch_path(e.spark, "deliveries")
    path = f"{root}/upstream"
    staged = e.stored(rows, "staged")
    column = "usage_hour_ntz" if "usage_hour_ntz" in staged.columns else "usage_date"
    refresh(root, writers.write_table(_old(staged, column), path, "usage_date"), path, None)
    I.take_changes(e.spark, path)
    late = F.col(column) > F.lit(CUT).cast("timestamp_ntz") - F.expr("interval 30 hour")
    if key:
        merged = I.upsert_table(e.spark, path, staged.where(late), key, ["usage_date"])
    else:  # whole dates
        dates = [r[0] for r in staged.where(late).select("usage_date").distinct().collect()]
        I.note_changes(e.spark, path, dates)
        I.replace_dates(e.spark, path, staged.where(I.on_dates("usage_date", dates)), dates, "usage_date", None)
        merged = I.stored_table(e.spark, path)
    return refresh(root, merged, path, I.changed_dates(e.spark, path))


def _windowed(e: Env, table: CON.Windowed):
    return lambda root, upstream, path, changed: CON.refresh_windows(e.spark, f"{root}/mart", table, upstream, path, changed)


query("w01_continued_daily", "select * from c_daily")(
    lambda e: _two_deliveries(e, _windowed(e, marts.daily_table(e.cfg)), e.hourly(), "cost_hour_key").select(*[f.name for f in D.DAILY_CONTRACT.fields])
)
query("w05_continued_storage", "select * from c_sd")(
    lambda e: _two_deliveries(e, _windowed(e, marts.storage_table(e.cfg)), e.ss()).select(*[f.name for f in STO.STORAGE_CONTRACT.fields])
)


def _spenders(e: Env, ranked: bool) -> DataFrame:
    """Base rows of changed dates, and ranked rows from the first of them on; a third of the estimates come late."""
    late = e.inputs.attribution().where(F.col("query_id").cast("bigint") % 3 == 0)
    early = e.inputs.attribution().join(late.select("query_id"), "query_id", "left_anti")

    def refresh(root: str, log: DataFrame, path: str, changed: list | None) -> DataFrame:
        estimates = early if changed is None else e.inputs.attribution()
        if changed is not None:
            KI.ensure_index(e.spark, path, log, "query_id", "usage_date")
            told = KI.dates_of_keys(e.spark, path, log, late, "query_id", "usage_date").distinct()
            changed = [*{*changed, *(r[0] for r in told.collect())}]  # one per calendar date
        base_path = f"{root}/base"
        base = CON.refresh_dates(e.spark, base_path, lambda rows: SP.top_spenders_base(rows, estimates), log, path, changed)
        if not ranked:
            return base
        told = I.changed_dates(e.spark, base_path) if changed is not None else None
        return CON.refresh_windows(e.spark, f"{root}/ranked", marts.SPENDERS, base, base_path, told)

    return _two_deliveries(e, refresh, e.sq(), "query_id")


@query("m05_forecast_from_moments", "select * from c_fc")
def _(e: Env) -> DataFrame:
    """The forecast from moments per date, brought up to date by a second delivery."""

    def refresh(root: str, daily: DataFrame, path: str, changed: list | None) -> DataFrame:
        return CON.refresh_dates(e.spark, f"{root}/moments", FC.cost_moments, daily, path, changed)

    return FC.forecast_from_moments(_two_deliveries(e, refresh, e.daily()), e.cfg)


query("m06_changed_dates", "select * from c_base")(lambda e: _spenders(e, ranked=False))
query("m07_changed_dates", "select * from c_ranked")(lambda e: _spenders(e, ranked=True))


@query("w12_continued_spenders", "select usage_date, user_name, rolling_7d_cost_usd from c_ranked")
def _(e: Env) -> DataFrame:
    """Rolling figures carried over the cut by snapshots of each user's last rows."""
    rows = SP.spenders_daily(e.base())
    table = CON.Windowed("user_name", "estimated_cost_usd", 6, lambda r: r, SP.ranked_spenders)
    return _two_deliveries(e, _windowed(e, table), rows).select("usage_date", "user_name", "rolling_7d_cost_usd")


@query("m10_from_state", "select * from c_dimw")
def _(e: Env) -> DataFrame:
    """The warehouse dimension from maxima kept by date; the log is read for changed dates only."""
    hours = writers.write_table(WH.meter_hours(e.sm()), scratch_path(e.spark, "warehouse-hours"), "usage_date")

    def refresh(root: str, log: DataFrame, path: str, changed: list | None) -> DataFrame:
        sizes = CON.refresh_dates(e.spark, f"{root}/sizes", lambda rows: WH.size_uses(rows, "usage_date"), log, path, changed)
        return WH.dim_from_state(hours, sizes)

    return _two_deliveries(e, refresh, e.sq(), "query_id")


# ================================ marts ==========================================================

query("m01_int_hourly_compute_costs", "select * from c_hourly")(lambda e: e.hourly())
query("m02_fct_daily_costs", "select * from c_daily")(lambda e: e.daily())
query("m03_fct_daily_storage_costs", "select * from c_sd")(lambda e: e.sd())
query("m04_fct_total_cost_summary", "select * from c_sum3")(
    lambda e: SUM.total_cost_summary(e.daily(), e.sd(), e.cfg, e.inputs.clustering())
)
query("m04_total_cost_summary_base", "select * from c_sum2")(lambda e: SUM.total_cost_summary(e.daily(), e.sd(), e.cfg))
query("m05_fct_cost_forecast", "select * from c_fc")(lambda e: FC.cost_forecast(e.daily(), e.cfg))
query("m06_int_top_spenders", "select * from c_base")(lambda e: e.base())
query("m07_fct_top_spenders", "select * from c_ranked")(lambda e: SP.top_spenders(e.base()))
# Rows without a date are ranked among themselves.
query("m07_top_spenders_undated", """
    select usage_date, count(*) as users, max(rank_by_query_count) as last_rank, cast(sum(query_count) as bigint) as query_count
    from (select usage_date, query_count, rank() over (partition by usage_date order by query_count desc) as rank_by_query_count
          from (select user_name, case when day(usage_date) % 3 = 0 then null else usage_date end as usage_date,
                       sum(query_count) as query_count from c_base group by 1, 2))
    group by 1""")(
    lambda e: SP.top_spenders(
        e.base().withColumn("usage_date", F.when(F.dayofmonth("usage_date") % 3 != 0, F.col("usage_date")))
    )
    .groupBy("usage_date")
    .agg(F.count("*").alias("users"), F.max("rank_by_query_count").alias("last_rank"), F.sum("query_count").alias("query_count"))
)
query("m08_fct_cost_by_department", "select * from c_dept")(lambda e: e.dept())
query("m09_fct_budget_vs_actual", "select * from c_bva")(lambda e: e.bva())
query("m10_dim_warehouse", "select * from c_dimw")(lambda e: e.sizes())
query("m11_dim_department", "select upper(trim(warehouse_name)) as warehouse_name, trim(department) as department from c_map")(
    lambda e: DEP.dim_department(e.inputs.department_map())
)

# ================================ data quality ===================================================

query("q01_not_null", "select * from c_hourly where cost_per_runtime_hour is null")(
    lambda e: Q.not_null(e.hourly(), "cost_per_runtime_hour")
)
query("q02_unique", "select user_name, count(*) as row_count from c_sq where user_name is not null group by 1 having count(*) > 1")(
    lambda e: Q.unique(e.sq(), "user_name")
)
query("q03_unique_combo", "select usage_date, warehouse_name, count(*) as row_count from c_sq group by 1, 2 having count(*) > 1")(
    lambda e: Q.unique_combo(e.sq(), ["usage_date", "warehouse_name"])
)
query("q04_between", "select * from c_daily where not (efficiency_score >= 60 and efficiency_score <= 90) and efficiency_score is not null")(
    lambda e: Q.between(e.daily(), "efficiency_score", 60, 90, where="efficiency_score is not null")
)
query("q05_accepted", "select * from c_dimw where warehouse_size is not null and warehouse_size not in ('X-SMALL', 'SMALL', 'MEDIUM')")(
    lambda e: Q.accepted(e.sizes(), "warehouse_size", ["X-SMALL", "SMALL", "MEDIUM"], where="warehouse_size is not null")
)
query("q06_relationship", "select * from c_daily where warehouse_name not in (select warehouse_name from c_map)")(
    lambda e: Q.relationship(e.daily(), e.inputs.department_map(), "warehouse_name")
)
query("q07_idle_within_compute", "select usage_date, warehouse_name, compute_cost, idle_cost from c_daily where idle_cost > compute_cost")(
    lambda e: Q.idle_within_compute(e.daily())
)
_ROLLUP = f"""
    select usage_date, warehouse_name, cast(sum(compute_cost_usd) as decimal(28,6)) as compute_cost, cast(sum(idle_cost_usd) as decimal(28,6)) as idle_cost
    from c_hourly group by 1, 2"""
# Before the cap, and with a tighter limit, so that there are violations to find.
query("q07_idle_within_share", f"select * from ({_ROLLUP}) where idle_cost > compute_cost * 0.05")(
    lambda e: Q.idle_within_compute(D.daily_rollup(e.hourly()), Decimal("0.05"))
)
_OTHER_CONTRACT = (
    StructType([f for f in D.DAILY_CONTRACT.fields if f.name not in ("compute_cost", "total_cost")])
    .add("compute_cost", "decimal(7,6)")
    .add("region", "string")
)
_COST_TYPE = D.DAILY_CONTRACT["compute_cost"].dataType.simpleString()
query(
    "q08_matches_contract",
    f"""select 'compute_cost' as "column", 'decimal(7,6)' as expected, '{_COST_TYPE}' as actual,
               count(*) filter (compute_cost is not null and try_cast(compute_cost as decimal(7,6)) is null) as misfits from c_daily
        union all select 'region', 'string', null, null
        union all select 'total_cost', null, '{D.DAILY_CONTRACT["total_cost"].dataType.simpleString()}', null""",
)(lambda e: Q.contract_misfits(e.daily(), _OTHER_CONTRACT))
_AGE = half_up("epoch_us(timestamp '2024-02-02 12:00:00') - epoch_us({0})", "3600000000", 2)
_BAND = "case when {0} > 96 then 'error' when {0} > 48 then 'warn' else 'pass' end"
query(
    "q09_source_freshness",
    f"""select latest, age_hours, {_BAND.format('age_hours')} as status
        from (select max(start_time) as latest, {_AGE.format('max(start_time)')} as age_hours from c_metering)""",
)(lambda e: Q.source_freshness(e.inputs.metering(), "start_time", NOW))
for _source, _table, _column in (("queries", "c_queries", "end_time"), ("storage", "c_storage", "usage_date")):
    _latest = f"cast(max({_column}) as timestamp)"
    query(
        f"q09_{_source}_freshness",
        f"""select latest, age_hours, {_BAND.format('age_hours')} as status
            from (select {_latest} as latest, {_AGE.format(_latest)} as age_hours from {_table})""",
    )(lambda e, s=_source, c=_column: Q.source_freshness(getattr(e.inputs, s)(), c, NOW))
query(
    "q10_mart_freshness",
    f"""select latest, age_hours, {_BAND.format('age_hours')} as status
        from (select cast(max(usage_date) as timestamp) as latest, {_AGE.format('cast(max(usage_date) as timestamp)')} as age_hours from c_daily)""",
)(lambda e: Q.mart_freshness(e.daily(), NOW))
query("q11_table_diagnostics", _DIAGNOSTICS)(_diagnostics)


@query(
    "q12_critical_empty",
    f"""select 'future_costs' as table_name, 'No rows in future_costs.' as detail
        where not exists (select 1 from c_daily where usage_date > {ASOF} + 1)
        union all select 'fct_daily_costs', 'No rows in fct_daily_costs.' where not exists (select 1 from c_daily)""",
)
def _(e: Env) -> DataFrame:
    daily = e.stored(e.daily(), "daily")
    return Q.critical_empty(
        {
            "fct_daily_costs": daily,
            "fct_cost_by_department": DEP.cost_by_department(daily, e.inputs.department_map()),
            "future_costs": daily.where(F.col("usage_date") > F.lit(date(2024, 2, 1))),
        }
    )




@query(
    "q00_run_checks",
    """select check_name, table_name, cast(violations as bigint) as violations from (values
        ('not_null(usage_date)', 'fct_daily_costs', (select count(*) from c_daily where usage_date is null)),
        ('between(compute_cost)', 'fct_daily_costs', (select count(*) from c_daily where not (compute_cost >= 0))),
        ('between(idle_cost)', 'fct_daily_costs', (select count(*) from c_daily where not (idle_cost >= 0))),
        ('between(efficiency_score)', 'fct_daily_costs', (select count(*) from c_daily where not (efficiency_score between 0 and 100))),
        ('idle_within_compute', 'fct_daily_costs', (select count(*) from c_daily where idle_cost > compute_cost)),
        ('unique(daily_cost_key)', 'fct_daily_costs', (select count(*) from (select daily_cost_key from c_daily group by 1 having count(*) > 1))),
        ('relationship(warehouse_name)', 'fct_daily_costs',
            (select count(*) from c_daily where warehouse_name not in (select warehouse_name from c_sm))),
        ('not_null(warehouse_name)', 'dim_department', (select count(*) from c_map where warehouse_name is null)),
        ('not_null(department)', 'dim_department', (select count(*) from c_map where department is null)),
        ('unique(warehouse_name)', 'dim_department',
            (select count(*) from (select upper(trim(warehouse_name)) from c_map group by 1 having count(*) > 1)))
      ) t(check_name, table_name, violations)""",
)
def _(e: Env) -> DataFrame:
    metering = e.stored(e.sm(), "metering")
    daily = e.stored(D.daily_costs(H.hourly_costs(metering, e.sq(), e.cfg), e.cfg), "daily")
    tables = {"fct_daily_costs": daily, "dim_department": DEP.dim_department(e.inputs.department_map())}
    return Q.run_checks({**tables, "stg_warehouse_metering": metering}, {n: Q.SUITES[n] for n in tables})


_SUITE_TABLES = {
    "stg_warehouse_metering": "c_sm", "stg_query_history": "c_sq", "stg_storage_usage": "c_ss", "int_hourly_compute_costs": "c_hourly",
    "fct_daily_costs": "c_daily", "fct_daily_storage_costs": "c_sd", "fct_total_cost_summary": "c_sum3", "fct_cost_forecast": "c_fc",
    "int_top_spenders": "c_base", "fct_top_spenders": "c_ranked", "fct_cost_by_department": "c_dept", "fct_budget_vs_actual": "c_bva",
    "dim_warehouse": "c_dimw", "budget_daily": "c_budget", "storage_history": "c_storage", "query_history": "c_queries",
    "dim_department": "(select upper(trim(warehouse_name)) as warehouse_name, trim(department) as department from c_map)",
}


def _suite_sql() -> str:
    """Every declared check as a count of its violations."""
    parts = []
    for table, sql in _SUITE_TABLES.items():
        suite = Q.SUITES[table]
        found = {f"not_null({c})": f"from {sql} where {c} is null" for c in suite.not_null}
        for c, low, high in suite.between:
            limits = [f"{c} >= {low}"] * (low is not None) + [f"{c} <= {high}"] * (high is not None)
            found[f"between({c})"] = f"from {sql} where not ({' and '.join(limits)})"
        for c, values in suite.accepted:
            found[f"accepted({c})"] = f"from {sql} where {c} not in ({', '.join(repr(v) for v in values)})"
        found |= {name: f"from {sql} where {rule}" for name, rule in suite.rules.items()}
        for columns in [(c,) for c in suite.unique] + list(suite.unique_combos):
            some = f"where {columns[0]} is not null" if len(columns) == 1 else ""
            keys = ", ".join(columns)
            found[f"unique({keys})"] = f"from (select {keys} from {sql} {some} group by {keys} having count(*) > 1)"
        for c, parent in suite.relationships:
            known = f"select {c} from {_SUITE_TABLES[parent]} where {c} is not null"
            found[f"relationship({c})"] = f"from {sql} where {c} is not null and {c} not in ({known})"
        parts += [f"select '{check}' as check_name, '{table}' as table_name, count(*) as violations {rest}" for check, rest in found.items()]
    return " union all ".join(parts)


@query("q00_all_suites", _suite_sql())
def _(e: Env) -> DataFrame:
    """Every declared suite over a whole build."""
    inputs = e.inputs
    tables = marts.build(e.sources(), e.cfg, marts.store_under(scratch_path(e.spark, "build")))
    return Q.run_checks({**tables, "budget_daily": inputs.budget(), "storage_history": inputs.storage(), "query_history": inputs.queries()})


# ================================ dashboard metrics ==============================================

_MTD = f"usage_date between date_trunc('month', {ASOF}) and {ASOF}"
_RATE = f"greatest({half_up(micro('mtd_total') + f' * day(last_day({ASOF}))', f'day({ASOF}) * 1000000', 6)}, mtd_total)"
query(
    "d01_month_run_rate",
    f"""select {ASOF} as as_of, mtd_total, cast(day({ASOF}) as integer) as elapsed_days, cast(day(last_day({ASOF})) as integer) as days_in_month,
               {_RATE} as run_rate_month
        from (select {usd('coalesce(sum(total_cost), 0)')} as mtd_total from c_daily where {_MTD})""",
    MID_MONTH,
)(lambda e: A.month_run_rate(e.daily(), e.cfg))


def _projection(e: Env) -> DataFrame:
    daily = e.stored(e.daily(), "daily")
    return A.month_projection(daily, FC.cost_forecast(daily, e.cfg), e.cfg)


query(
    "d02_month_projection",
    f"""select {ASOF} as as_of, mtd_total, remaining_forecast, mtd_total + remaining_forecast as month_projection
        from (select {usd('coalesce(sum(total_cost), 0)')} as mtd_total,
                     (select {usd('sum(forecasted_cost_usd)')} from c_fc where forecast_date <= last_day({ASOF})) as remaining_forecast
              from c_daily where {_MTD})""",
    MID_MONTH,
)(_projection)
query(
    "d02_projection_without_forecast",
    f"""select {ASOF} as as_of, mtd_total, cast(null as decimal(38,6)) as remaining_forecast, {_RATE} as month_projection
        from (select {usd('coalesce(sum(total_cost), 0)')} as mtd_total from c_daily where {_MTD})""",
    MID_MONTH,
)(
    lambda e: A.month_projection(
        (daily := e.stored(e.daily(), "daily")),
        _forecast_of_another_run(daily, e),
        e.cfg,
    )
)


def _forecast_of_another_run(daily: DataFrame, e: Env) -> DataFrame:
    """A forecast made on another day does not count."""
    return FC.cost_forecast(daily, Config(as_of=date(2024, 1, 19)))


query(
    "d03_budget_variance",
    f"""select budget_mtd, actual_mtd, actual_mtd - budget_mtd as variance_usd, {pct('actual_mtd - budget_mtd', 'budget_mtd')} as variance_pct,
               case when actual_mtd <= 0 then 'no spend' when actual_mtd > budget_mtd then 'over' when actual_mtd < budget_mtd then 'under' else 'on' end as variance_status
        from (select (select {usd('sum(budget_usd)')} from c_budget where {_MTD.replace('usage_date', 'date', 1)}) as budget_mtd,
                     (select {usd('coalesce(sum(total_cost_usd), 0)')} from c_dept where {_MTD}) as actual_mtd)""",
    MID_MONTH,
)(lambda e: A.budget_variance(e.dept(), e.inputs.budget(), e.cfg))
_VARIANCE = """
    select budget_mtd, actual_mtd, actual_mtd - budget_mtd as variance_usd, {pct} as variance_pct,
           case when budget_mtd > 0 and actual_mtd <= 0 then 'no spend' when budget_mtd = 0 then 'vs actual spend'
                when actual_mtd > budget_mtd then 'over' when actual_mtd < budget_mtd then 'under' else 'on' end as variance_status
    from (select {budget} as budget_mtd, {actual} as actual_mtd)"""
query(
    "d03_no_department_month",
    _VARIANCE.format(
        pct=pct("actual_mtd - budget_mtd", "budget_mtd"),
        budget=f"(select {usd('sum(budget_usd)')} from c_budget where {_MTD.replace('usage_date', 'date', 1)})",
        actual=f"(select {usd('sum(total_cost)')} from c_daily where {_MTD})",
    ),
    MID_MONTH,
)(lambda e: A.budget_variance(e.dept().where(F.col("usage_date") < F.lit(date(2024, 1, 1))), e.inputs.budget(), e.cfg, e.daily()))
query(
    "d03_budget_outside_month",
    _VARIANCE.format(
        pct="cast(null as decimal(38,2))",
        budget=f"(select {usd('0 * count(*)')} from c_budget)",
        actual=f"(select {usd('sum(total_cost_usd)')} from c_dept where {_MTD})",
    ),
    MID_MONTH,
)(
    lambda e: A.budget_variance(
        e.dept(), e.inputs.budget().where(F.col("date") > F.lit(date(2024, 1, 31))), e.cfg, e.daily()
    )
)
query(
    "d04_idle_share_30d",
    f"""select idle_total, cost_total, case when cost_total > 0 then {pct('idle_total', 'cost_total')} end as idle_share_pct
        from (select {usd('coalesce(sum(idle_cost), 0)')} as idle_total, {usd('coalesce(sum(total_cost), 0)')} as cost_total from c_daily_win)""",
)(lambda e: A.idle_share_30d(e.daily(), e.cfg))
query(
    "d05_compute_vs_storage",
    f"""select 'COMPUTE' as cost_category, cast(sum(total_cost) as decimal(38,9)) as mtd_usd from c_daily where {_MTD}
        union all select 'STORAGE', cast(sum(estimated_storage_cost_usd) as decimal(38,9)) from c_sd where {_MTD}""",
    MID_MONTH,
)(lambda e: A.compute_vs_storage(e.daily(), e.sd(), e.cfg))
query("d06_idle_projection", "select * from c_proj")(lambda e: A.idle_projection(e.idle(), 30))
query("d07_rightsizing", "select * from c_rs")(lambda e: A.rightsizing(A.idle_projection(e.idle(), 30)))
_RS_WIDE = {
    "c_rs_wide": """
        select warehouse_name, avg_credits_per_active_hour, warehouse_size,
               case when avg_credits_per_active_hour < 100 then case warehouse_size
                    when 'MEDIUM' then 'Right-size to Small' when 'LARGE' then 'Right-size to Medium'
                    when 'X-LARGE' then 'Right-size to Large' when '2X-LARGE' then 'Right-size to X-Large'
                    when '3X-LARGE' then 'Right-size to 2X-Large' when '4X-LARGE' then 'Right-size to 3X-Large' end end as rightsize_suggestion
        from c_proj"""
}
query("d07_rightsizing_wide", "select * from c_rs_wide", extra=_RS_WIDE)(
    lambda e: A.rightsizing(A.idle_projection(e.idle(), 30), below=Decimal(100))
)


def _savings(e: Env) -> DataFrame:
    projected = e.projected()
    return A.savings_summary(projected, A.rightsizing(projected, below=Decimal(100)))


query(
    "d08_savings_summary",
    f"""select (select count(*) from c_rs_wide where trim(rightsize_suggestion) <> '') as warehouses_flagged,
               {usd('greatest(sum(idle_month_est), 0)')} as estimated_savings from c_proj""",
    extra=_RS_WIDE,
)(_savings)


def _autosuspend(e: Env) -> DataFrame:
    projected = e.projected()
    return A.autosuspend_targets(projected, A.rightsizing(projected), readers.warehouse_settings(e.inputs.settings()))


query(
    "d09_autosuspend_targets",
    """select e.warehouse_name, e.idle_share_pct, s.auto_suspend as current_seconds, case when e.idle_share_pct >= 40 then 300 else 600 end as target_seconds
       from c_est e left join c_settings s on upper(e.warehouse_name) = upper(s.name)
       where e.rightsize_suggestion is null and s.auto_suspend is distinct from case when e.idle_share_pct >= 40 then 300 else 600 end""",
)(_autosuspend)
query("d10_insights", "select * from c_insights")(_insights)
_MULTIPLIERS = {
    "AFRICA": Decimal("1.25"),
    "AMERICA": Decimal("1.10"),
    "ASIA": Decimal("0.75"),
    "EUROPE": Decimal("1.00"),
    "MIDDLE EAST": Decimal("0.60"),
}
_FACTOR = "case department " + " ".join(f"when '{d}' then {m}" for d, m in _MULTIPLIERS.items()) + " end"
query(
    "d11_derive_budget",
    f"""select department, {ASOF} + cast(d as integer) as date, cast(round(cast(weighted as decimal(20,6)) * scale, 2) as decimal(18,2)) as budget_usd
        from (select *, cast({half_up(f"{micro('sum(daily_cost_usd) over ()')} * 110", f"{micro('sum(weighted) over ()')} * 100", 6)} as decimal(14,6)) as scale
              from (select *, cast(cast(daily_cost_usd as decimal(18,6)) * {_FACTOR} as decimal(20,6)) as weighted from c_run_rate)),
             range(-75, 31) t(d)""",
    extra={"c_run_rate": _RUN_RATE},
)(lambda e: A.derive_budget(_run_rate(e), _MULTIPLIERS, e.cfg))
for _days in A.WINDOW_PRESETS:
    query(f"d12_window_{_days}", f"select * from c_daily where usage_date between {ASOF} - {_days} and {ASOF} - 1")(
        lambda e, n=_days: A.window_slice(e.daily(), e.cfg, n)
    )
query(
    "d13_summary_this_month",
    f"select usage_date, cost_category, cost_usd, pct_of_daily_total, mtd_cost_usd from c_sum3 where usage_date >= date_trunc('month', {ASOF})",
)(lambda e: A.summary_this_month(SUM.total_cost_summary(e.daily(), e.sd(), e.cfg, e.inputs.clustering()), e.cfg))
query(
    "d14_forecast_run",
    f"""select forecast_date, warehouse_name, forecasted_cost_usd, confidence_band_low, confidence_band_high, days_ahead
        from c_fc where forecast_run_date = {ASOF}""",
)(lambda e: A.forecast_run(FC.cost_forecast(e.daily(), e.cfg), e.cfg.as_of))
