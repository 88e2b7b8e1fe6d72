"""ANSI SQL counterparts of the operators, written against the benchmark tables.

`with_ctes` prefixes a query with just the common table expressions it names, directly or not. The
SQL states each operator's definition independently of the Spark code: windows where Spark uses value
counts, joins where Spark aggregates once.
"""

from __future__ import annotations

import re

AS_OF = "2024-01-31"
TB = 2**40


def half_up(num: str, den: str, k: int) -> str:
    """Exact num / den at k decimals, half away from zero; both are integer expressions."""
    n, d = f"cast({num} as hugeint)", f"cast(nullif({den}, 0) as hugeint)"
    q = (
        f"((case when ({n} < 0) <> ({d} < 0) then -1 else 1 end)"
        f" * ((abs({n}) * {2 * 10**k} + abs({d})) // (2 * abs({d}))))"
    )
    unit = "1" if k == 0 else "0." + "0" * (k - 1) + "1"
    return f"cast(cast({q} as decimal({38 - k},0)) * {unit} as decimal(38,{k}))"


def micro(x: str) -> str:
    return f"cast(({x}) * 1000000 as hugeint)"


def usd(x: str) -> str:
    return f"cast({x} as decimal(38,6))"


def pct(part: str, total: str, k: int = 2) -> str:
    return half_up(f"{micro(part)} * 100", micro(total), k)


def key(*columns: str) -> str:
    parts = " || '-' || ".join(f"coalesce(cast({c} as varchar), '_null_')" for c in columns)
    return f"md5({parts})"


def storage_usd(num_bytes: str, days: str = "1") -> str:
    return half_up(f"{num_bytes} * 2300", f"{TB} * 3044 * {days}", 9)


def tb(num_bytes: str, k: int) -> str:
    return half_up(num_bytes, str(TB), k)


def nudge(x: str, k: int) -> str:
    return f"round({x} + 1e-9, {k})"


WH = "case when user_id % 9 = 8 then 'CLOUD_SERVICES_ONLY' else 'WH_' || (user_id % 9) end"
SIZE = "['X-Small','Small','Medium','Large','X-Large','2X-Large','3X-Large','4X-Large'][user_id % 9 + 1]"
LABEL_CREDITS = (
    "case {0} when 'X-SMALL' then 1 when 'SMALL' then 2 when 'MEDIUM' then 4 when 'LARGE' then 8"
    " when 'X-LARGE' then 16 when '2X-LARGE' then 32 when '3X-LARGE' then 64 when '4X-LARGE' then 128 end"
)
UNASSIGNED = "coalesce(nullif(trim({0}), ''), 'Unassigned')"
ASOF = "date '$asof'"

CTES = {
    # ---- inputs -------------------------------------------------------------------------------
    "c_metering": f"""
        select *, cast(round(credits_used * 0.95, 3) as decimal(18,3)) as credits_used_compute,
               cast(round(credits_used * 0.05, 3) as decimal(18,3)) as credits_used_cloud_services
        from (select user_id % 9 as warehouse_id, {WH} as warehouse_name, date_trunc('hour', ts) as start_time,
                     date_trunc('hour', ts) + interval 1 hour as end_time,
                     cast(round(cast(sum(cast(value as decimal(18,2))) as decimal(28,2)) * 0.01, 3) as decimal(18,3)) as credits_used
              from events group by 1, 2, 3, 4)""",
    "c_queries": f"""
        select cast(event_id as varchar) as query_id, ts - to_milliseconds(ms) as start_time, ts as end_time,
               'user_' || user_id as user_name, event_type as role_name, {WH} as warehouse_name,
               {SIZE} as warehouse_size, event_type as query_type, 'DB_' || (user_id % 5) as database_name,
               'S_' || (event_id % 3) as schema_name,
               case when event_type = 'error' then 'FAIL' else 'SUCCESS' end as execution_status,
               k * 1073741824 as bytes_scanned, k * 10 as rows_produced,
               ms as total_elapsed_time, ms as execution_time
        from (select *, cast(cast(value as decimal(18,2)) * 2000 as bigint) as ms,
                     cast(json_extract_string(props, '$.k') as bigint) as k from events)""",
    "c_storage": """
        select usage_date, cast(substring(database_name, 1, 1) as bigint) + 1000 as database_id, database_name, b as average_database_bytes,
               cast(cast(b as hugeint) // 5 as decimal(38,0)) as average_failsafe_bytes
        from (select date '2024-01-01' + cast(o_orderkey % 30 as integer) as usage_date, o_orderpriority as database_name,
                     cast(sum(cast(o_totalprice as decimal(18,2))) * 1000000 as decimal(38,0)) as b
              from orders group by 1, 2)""",
    "c_map": """
        select 'WH_' || n_nationkey as warehouse_name, case when n_nationkey = 6 then ' ' else r_name end as department
        from nation join region on n_regionkey = r_regionkey""",
    "c_budget": """
        select r_name as department, cast(d as date) as date, cast(100 + 10 * r_regionkey as decimal(18,2)) as budget_usd
        from region, range(date '2024-01-01', date '2024-02-15', interval 1 day) t(d)""",
    "c_attr": """
        select query_id, cast(round(cast(total_elapsed_time as decimal(18,0)) * 0.00001, 6) as decimal(38,6)) as estimated_query_cost_usd
        from c_queries""",
    "c_clust": """
        select date_trunc('hour', ts) as usage_hour,
               cast(sum(case when event_type = 'signup' then 0.010 else 0.002 end) as decimal(18,3)) as credits_used
        from events group by 1""",
    "c_settings": f"""
        select distinct {WH} as name,
               cast(case user_id % 9 % 3 when 0 then 300 when 1 then 600 end as integer) as auto_suspend, {SIZE} as size
        from events""",
    "c_raw_metering": """
        select cast(start_time as varchar) as start_time, cast(end_time as varchar) as end_time, warehouse_name,
               credits_used as total_credits_used, cast(round(credits_used * 3, 2) as decimal(18,2)) as total_cost_usd
        from c_metering""",
    # ---- scans and staging --------------------------------------------------------------------
    "c_metering_h": f"select * from c_metering where start_time >= {ASOF} - interval 30 day",
    "c_queries_h": f"select * from c_queries where start_time >= {ASOF} - interval 30 day",
    "c_sm": """
        select date_trunc('hour', end_time) as usage_hour_ntz, date_trunc('hour', start_time) as hour_start,
               date_trunc('hour', end_time) as hour_end, cast(end_time as date) as usage_date, warehouse_id, warehouse_name,
               credits_used as total_credits_used, credits_used_compute, credits_used_cloud_services,
               cast(credits_used_compute * 3.00 as decimal(28,6)) as compute_cost_usd,
               cast(credits_used_cloud_services * 3.00 as decimal(28,6)) as cloud_services_cost_usd,
               cast(0 as decimal(28,6)) as idle_cost_usd, cast(credits_used * 3.00 as decimal(28,6)) as total_cost_usd,
               warehouse_id || '|' || strftime(date_trunc('hour', end_time), '%Y-%m-%d %H:%M:%S') as metering_id
        from c_metering_h""",
    "c_sq": """
        select query_id, date_trunc('hour', end_time) as usage_hour_ntz, date_trunc('hour', start_time) as hour_start_ntz,
               date_trunc('hour', end_time) as hour_end_ntz, cast(end_time as date) as usage_date, start_time, end_time,
               user_name, role_name, warehouse_name, warehouse_size, query_type, database_name, schema_name,
               execution_status, bytes_scanned, rows_produced, total_elapsed_time as total_elapsed_ms,
               execution_time as execution_ms, bytes_scanned / 1073741824e0 as gb_scanned,
               cast(total_elapsed_time * 0.001 as decimal(18,3)) as total_elapsed_seconds,
               case when total_elapsed_time > 600000 then 'long_running' when total_elapsed_time > 60000 then 'medium_running'
                    else 'fast' end as runtime_category
        from c_queries_h where execution_status = 'SUCCESS' and warehouse_name is not null""",
    "c_ss": f"""
        select {key('coalesce(cast(database_id as varchar), database_name)', 'usage_date')} as storage_snapshot_id,
               usage_date, database_id, database_name, average_database_bytes as avg_database_bytes,
               average_failsafe_bytes as avg_failsafe_bytes, cast(0 as decimal(38,0)) as avg_stage_bytes,
               {tb('average_database_bytes', 9)} as avg_database_tb, {tb('average_failsafe_bytes', 9)} as avg_failsafe_tb,
               cast(0 as decimal(38,9)) as avg_stage_tb, {tb('average_database_bytes + average_failsafe_bytes', 9)} as total_storage_tb,
               {storage_usd('average_database_bytes')} as estimated_active_cost_usd,
               {storage_usd('average_failsafe_bytes')} as estimated_failsafe_cost_usd,
               cast(0 as decimal(38,9)) as estimated_stage_cost_usd,
               {storage_usd('(average_database_bytes + average_failsafe_bytes)')} as estimated_storage_cost_usd
        from c_storage where usage_date >= {ASOF} - 365""",
    # ---- hourly -------------------------------------------------------------------------------
    "c_act": """
        select warehouse_name, usage_hour_ntz, count(*) as query_count,
               cast(sum(total_elapsed_ms) * 0.001 as decimal(20,3)) as total_runtime_seconds,
               sum(bytes_scanned) / 1073741824e0 as total_gb_scanned, count(distinct user_name) as unique_users
        from c_sq group by 1, 2""",
    "c_joined": """
        select m.usage_hour_ntz, m.hour_start, m.hour_end, cast(m.usage_hour_ntz as date) as usage_date, m.warehouse_id,
               m.warehouse_name, m.total_credits_used, m.total_cost_usd, m.compute_cost_usd, m.cloud_services_cost_usd,
               coalesce(q.query_count, 0) as queries_executed,
               coalesce(q.total_runtime_seconds, cast(0 as decimal(20,3))) as total_runtime_seconds,
               coalesce(q.total_gb_scanned, 0e0) as gb_scanned, coalesce(q.unique_users, 0) as unique_users
        from c_sm m left join c_act q on m.warehouse_name = q.warehouse_name and m.usage_hour_ntz = q.usage_hour_ntz""",
    "c_hourly": f"""
        select *, case when queries_executed > 0 then {half_up(micro('total_cost_usd'), 'queries_executed * 1000000', 6)} end as avg_cost_per_query,
               case when total_runtime_seconds > 0
                    then {half_up(micro('total_cost_usd') + ' * 3600', 'total_runtime_seconds * 1000 * 1000', 6)} end as cost_per_runtime_hour,
               queries_executed = 0 and total_credits_used > 0 as is_potentially_idle,
               case when queries_executed = 0 and total_credits_used > 0 then compute_cost_usd
                    else cast(0 as decimal(28,6)) end as idle_cost_usd,
               {key('warehouse_id', 'usage_hour_ntz')} as cost_hour_key
        from c_joined""",
    # ---- daily --------------------------------------------------------------------------------
    "c_roll": f"""
        select usage_date, warehouse_name, cast(sum(total_credits_used) as decimal(28,3)) as compute_credits,
               cast(sum(compute_cost_usd) as decimal(28,6)) as compute_cost,
               cast(sum(cloud_services_cost_usd) as decimal(28,6)) as cloud_services_cost,
               cast(sum(total_cost_usd) as decimal(28,6)) as total_cost, cast(sum(idle_cost_usd) as decimal(28,6)) as idle_cost,
               cast(sum(queries_executed) as bigint) as total_queries,
               {half_up('sum(unique_users)', 'count(unique_users)', 2)} as avg_concurrent_users
        from c_hourly group by 1, 2""",
    "c_eff": f"""
        select usage_date, warehouse_name, compute_credits, compute_cost, cloud_services_cost, total_cost,
               least(idle_cost, compute_cost) as idle_cost,
               cast(greatest(compute_cost - idle_cost, 0) as decimal(28,6)) as productive_cost,
               total_queries, avg_concurrent_users,
               case when total_queries > 0 then {half_up(micro('compute_cost'), 'total_queries * 1000000', 6)} end as cost_per_query,
               cast(case when compute_cost > 0
                    then greatest(0, least(100, {pct('compute_cost - least(idle_cost, compute_cost)', 'compute_cost')}))
                    else 100 end as decimal(5,2)) as efficiency_score
        from c_roll""",
    "c_daily": f"""
        select usage_date, warehouse_name, cast(compute_credits as decimal(38,3)) as compute_credits, {usd('compute_cost')} as compute_cost,
               {usd('cloud_services_cost')} as cloud_services_cost, {usd('total_cost')} as total_cost,
               {usd('idle_cost')} as idle_cost, {usd('productive_cost')} as productive_cost,
               cast(total_queries as decimal(38,0)) as total_queries, avg_concurrent_users, cost_per_query, efficiency_score,
               {usd('''sum(total_cost) over (partition by date_trunc('month', usage_date), warehouse_name order by usage_date)''')} as month_to_date_cost,
               {half_up(micro('sum(total_cost) over w7'), 'count(total_cost) over w7 * 1000000', 6)} as cost_7day_avg,
               {usd('total_cost - lag(total_cost, 1) over w')} as day_over_day_change,
               {usd('total_cost - lag(total_cost, 7) over w')} as week_over_week_change,
               {key('usage_date', 'warehouse_name')} as daily_cost_key
        from c_eff
        window w as (partition by warehouse_name order by usage_date),
               w7 as (partition by warehouse_name order by usage_date rows between 6 preceding and current row)""",
    # ---- storage, summary ---------------------------------------------------------------------
    "c_sd": f"""
        select {key('database_name', 'usage_date')} as daily_storage_key, usage_date, cast(database_id as decimal(38,0)) as database_id,
               database_name, {tb('avg_database_bytes', 6)} as active_storage_tb, {tb('avg_failsafe_bytes', 6)} as failsafe_storage_tb,
               cast(0 as decimal(38,6)) as stage_storage_tb, {tb('b', 6)} as total_storage_tb,
               {storage_usd('avg_database_bytes')} as estimated_active_cost_usd,
               {storage_usd('avg_failsafe_bytes')} as estimated_failsafe_cost_usd,
               cast(0 as decimal(38,9)) as estimated_stage_cost_usd, {storage_usd('b')} as estimated_storage_cost_usd,
               {storage_usd('sum(b) over (partition by database_name, month(usage_date) order by usage_date)')} as month_to_date_storage_cost,
               {storage_usd('sum(b) over w30', 'count(b) over w30')} as storage_cost_30day_avg
        from (select *, cast(avg_database_bytes + avg_failsafe_bytes as hugeint) as b from c_ss)
        window w30 as (partition by database_name order by usage_date rows between 29 preceding and current row)""",
    "c_cat_compute": """
        select usage_date, 'COMPUTE' as cost_category, cast(sum(compute_credits) as decimal(38,4)) as credits_used,
               cast(sum(total_cost) as decimal(38,9)) as cost_usd from c_daily group by 1""",
    "c_cat_storage": """
        select usage_date, 'STORAGE' as cost_category, cast(null as decimal(38,4)) as credits_used,
               cast(sum(estimated_storage_cost_usd) as decimal(38,9)) as cost_usd from c_sd group by 1""",
    "c_cat_clust": """
        select cast(usage_hour as date) as usage_date, 'AUTO_CLUSTERING' as cost_category,
               cast(sum(credits_used) as decimal(38,4)) as credits_used,
               cast(cast(sum(credits_used) as decimal(28,3)) * 3.00 as decimal(38,9)) as cost_usd from c_clust group by 1""",
    "c_cats2": "select * from c_cat_compute union all select * from c_cat_storage",
    "c_cats3": "select * from c_cats2 union all select * from c_cat_clust",
    "c_sum3": f"""
        select {key('cost_category', 'usage_date')} as total_cost_summary_id, usage_date, cost_category, credits_used, cost_usd,
               {half_up('cost_usd * 1000000000 * 100', 'sum(cost_usd) over (partition by usage_date) * 1000000000', 2)} as pct_of_daily_total,
               cast(sum(cost_usd) over (partition by cost_category, date_trunc('month', usage_date) order by usage_date
                    rows between unbounded preceding and current row) as decimal(38,9)) as mtd_cost_usd
        from c_cats3 where cost_usd is not null and cost_usd > 0""",
    "c_sum2": f"""
        select {key('cost_category', 'usage_date')} as total_cost_summary_id, usage_date, cost_category, credits_used, cost_usd,
               {half_up('cost_usd * 1000000000 * 100', 'sum(cost_usd) over (partition by usage_date) * 1000000000', 2)} as pct_of_daily_total,
               cast(sum(cost_usd) over (partition by cost_category, date_trunc('month', usage_date) order by usage_date
                    rows between unbounded preceding and current row) as decimal(38,9)) as mtd_cost_usd
        from c_cats2 where cost_usd is not null and cost_usd > 0""",
    # ---- forecast -----------------------------------------------------------------------------
    "c_actuals": f"""
        select usage_date, warehouse_name, cast(total_cost as double) as cost, cast(dayofweek(usage_date) + 1 as integer) as dow
        from c_daily where usage_date >= {ASOF} - 60""",
    "c_baseline": f"""
        select *, (last_7d_avg - prev_7d_avg) / 7.0e0 as trend_slope_per_day
        from (select warehouse_name, avg(cost) as avg_daily_cost, stddev_samp(cost) as stddev_daily_cost, count(*) as observation_days,
                     avg(case when usage_date >= {ASOF} - 7 then cost end) as last_7d_avg,
                     avg(case when usage_date between {ASOF} - 14 and {ASOF} - 8 then cost end) as prev_7d_avg
              from c_actuals group by 1 having count(*) >= 7)""",
    "c_dow": """
        select a.warehouse_name, a.dow as day_of_week, avg(a.cost) / nullif(b.avg_daily_cost, 0) as dow_factor
        from c_actuals a join c_baseline b on a.warehouse_name = b.warehouse_name
        group by a.warehouse_name, a.dow, b.avg_daily_cost""",
    "c_spine": f"select cast(d as integer) as days_ahead, {ASOF} + cast(d as integer) as forecast_date from range(1, 31) t(d)",
    "c_fc": f"""
        select {key('warehouse_name', 'forecast_date', ASOF)} as forecast_id, {ASOF} as forecast_run_date, forecast_date, days_ahead,
               warehouse_name, cast({nudge('greatest(0, p)', 6)} as decimal(38,6)) as forecasted_cost_usd,
               cast({nudge('greatest(0, p - s)', 6)} as decimal(38,6)) as confidence_band_low,
               cast({nudge('greatest(0, p + s)', 6)} as decimal(38,6)) as confidence_band_high,
               'rolling_avg_linear_trend' as forecast_method, 60 as lookback_days, {ASOF} as as_of_date
        from (select b.warehouse_name, s.forecast_date, s.days_ahead,
                     (b.avg_daily_cost + s.days_ahead * coalesce(b.trend_slope_per_day, 0e0)) * coalesce(d.dow_factor, 1e0) as p,
                     coalesce(b.stddev_daily_cost, 0e0) * sqrt(s.days_ahead) as s
              from c_spine s cross join c_baseline b
              left join c_dow d on b.warehouse_name = d.warehouse_name and dayofweek(s.forecast_date) + 1 = d.day_of_week)""",
    # ---- spenders -----------------------------------------------------------------------------
    "c_base": f"""
        select q.usage_date, user_name, role_name, database_name, warehouse_name, count(q.query_id) as query_count,
               cast(sum(total_elapsed_seconds) as decimal(20,3)) as total_runtime_seconds,
               {half_up('sum(total_elapsed_ms)', 'count(total_elapsed_ms) * 1000', 6)} as avg_runtime_seconds,
               cast(sum(case when runtime_category = 'long_running' then 1 else 0 end) as bigint) as long_running_query_count,
               sum(gb_scanned) as gb_scanned, cast(sum(rows_produced) as bigint) as rows_produced,
               {usd('sum(a.estimated_query_cost_usd)')} as estimated_cost_usd, true as has_cost_estimate
        from c_sq q left join c_attr a on q.query_id = a.query_id group by 1, 2, 3, 4, 5""",
    "c_base0": "select * replace (cast(null as decimal(38,6)) as estimated_cost_usd, false as has_cost_estimate) from c_base",
    "c_primary": """
        select usage_date, user_name, warehouse_name as primary_warehouse_name from c_base
        qualify row_number() over (partition by user_name, usage_date order by query_count desc, warehouse_name) = 1""",
    "c_sp": f"""
        select usage_date, user_name, cast(sum(query_count) as bigint) as query_count,
               cast(sum(total_runtime_seconds) as decimal(38,3)) as total_runtime_seconds,
               cast(sum(long_running_query_count) as bigint) as long_running_query_count, sum(gb_scanned) as gb_scanned,
               {usd('sum(estimated_cost_usd)')} as estimated_cost_usd, bool_or(has_cost_estimate) as has_cost_estimate
        from c_base group by 1, 2""",
    "c_ranked": f"""
        select {key('s.user_name', 's.usage_date')} as top_spender_id, s.usage_date, s.user_name, p.primary_warehouse_name, s.query_count,
               s.total_runtime_seconds, s.long_running_query_count, s.gb_scanned, s.estimated_cost_usd, s.has_cost_estimate,
               rank() over (partition by s.usage_date order by s.query_count desc) as rank_by_query_count,
               rank() over (partition by s.usage_date order by s.total_runtime_seconds desc nulls first) as rank_by_runtime,
               rank() over (partition by s.usage_date order by s.estimated_cost_usd desc nulls last) as rank_by_cost,
               {half_up('s.query_count * 100', 'sum(s.query_count) over (partition by s.usage_date)', 2)} as pct_of_daily_query_total,
               {pct('s.estimated_cost_usd', 'sum(s.estimated_cost_usd) over (partition by s.usage_date)')} as pct_of_daily_cost,
               {usd('''sum(s.estimated_cost_usd) over (partition by s.user_name order by s.usage_date
                   rows between 6 preceding and current row)''')} as rolling_7d_cost_usd
        from c_sp s left join c_primary p on s.user_name = p.user_name and s.usage_date = p.usage_date""",
    "c_sp0": """
        select usage_date, user_name, cast(sum(query_count) as bigint) as query_count,
               cast(sum(total_runtime_seconds) as decimal(38,3)) as total_runtime_seconds, sum(gb_scanned) as gb_scanned,
               cast(null as decimal(38,6)) as estimated_cost_usd, false as has_cost_estimate
        from c_base0 group by 1, 2""",
    # ---- departments, warehouses --------------------------------------------------------------
    "c_dept": f"""
        select f.usage_date, case when upper(f.warehouse_name) = 'CLOUD_SERVICES_ONLY' then 'Overhead'
                                  else {UNASSIGNED.format('m.department')} end as department,
               {usd('sum(f.compute_cost)')} as compute_cost_usd, {usd('sum(f.idle_cost)')} as idle_cost_usd,
               {usd('sum(f.total_cost)')} as total_cost_usd
        from c_daily f left join c_map m on upper(f.warehouse_name) = upper(m.warehouse_name) group by 1, 2""",
    "c_dept_actual": f"""
        select f.usage_date, {UNASSIGNED.format('m.department')} as department, {usd('sum(f.total_cost)')} as actual_cost_usd
        from c_daily f left join c_map m on upper(f.warehouse_name) = upper(m.warehouse_name) group by 1, 2""",
    "c_bva": """
        select coalesce(a.usage_date, b.date) as usage_date, coalesce(a.department, trim(b.department)) as department,
               coalesce(a.actual_cost_usd, cast(0 as decimal(38,6))) as actual_cost_usd,
               coalesce(b.budget_usd, cast(0 as decimal(18,2))) as budget_usd
        from c_dept_actual a full outer join c_budget b on a.usage_date = b.date and a.department = trim(b.department)""",
    "c_size": """
        select warehouse_name, upper(replace(warehouse_size, ' ', '-')) as warehouse_size from c_sq where warehouse_size is not null
        qualify row_number() over (partition by warehouse_name order by usage_hour_ntz desc, end_time desc,
                                   upper(replace(warehouse_size, ' ', '-'))) = 1""",
    "c_metered": "select warehouse_id, warehouse_name, max(usage_hour_ntz) as last_metered_at from c_sm group by 1, 2",
    "c_dimw": f"""
        select m.warehouse_id, m.warehouse_name, 'STANDARD' as warehouse_type, q.warehouse_size,
               {LABEL_CREDITS.format('q.warehouse_size')} as warehouse_size_credits_per_hour,
               cast(null as decimal(38,0)) as auto_suspend_seconds, cast(null as boolean) as auto_resume,
               cast(null as decimal(38,0)) as min_cluster_count, cast(null as decimal(38,0)) as max_cluster_count,
               cast(null as boolean) as is_multi_cluster, cast(null as varchar) as scaling_policy,
               cast(null as varchar) as owner_role, cast(null as timestamp) as created_on, cast(null as timestamp) as dropped_on,
               true as is_active, m.last_metered_at
        from c_metered m left join c_size q on m.warehouse_name = q.warehouse_name""",
    # ---- idle and sizing (30-day window) ------------------------------------------------------
    "c_idle": f"""
        select h.*, s.warehouse_size from (
          select warehouse_name,
               {usd("sum(case when is_potentially_idle and total_credits_used >= 0.05 then compute_cost_usd else 0 end)")} as idle_cost_adj,
               {usd('sum(total_cost_usd)')} as total_cost, {usd('sum(compute_cost_usd)')} as compute_cost, count(*) as total_hours,
               cast(sum(case when queries_executed > 0 then 1 else 0 end) as bigint) as active_hours,
               cast(sum(case when queries_executed > 0 then total_credits_used else 0 end) as decimal(38,3)) as credits_on_active_hours,
               count(distinct usage_date) as total_days,
               count(distinct case when queries_executed > 0 then usage_date end) as active_days
          from c_hourly where usage_date between {ASOF} - 29 and {ASOF} group by 1) h
        left join (select warehouse_name, max(warehouse_size) as warehouse_size from c_dimw group by 1) s
          on h.warehouse_name = s.warehouse_name""",
    "c_proj": f"""
        select *, cast(coalesce(greatest(0, least(100, {pct('idle_cost_adj', 'total_cost', 6)})), 0) as decimal(38,6)) as idle_share,
               {half_up(micro('idle_cost_adj') + ' * 30', '30 * 1000000', 6)} as idle_month_est,
               case when active_hours > 0 then {half_up('credits_on_active_hours * 1000', 'active_hours * 1000', 6)} end as avg_credits_per_active_hour
        from c_idle""",
    "c_rs": """
        select warehouse_name, avg_credits_per_active_hour, warehouse_size,
               case when avg_credits_per_active_hour < 0.15 then case warehouse_size
                    when 'MEDIUM' then 'Right-size to Small' when 'LARGE' then 'Right-size to Medium'
                    when 'X-LARGE' then 'Right-size to Large' when '2X-LARGE' then 'Right-size to X-Large'
                    when '3X-LARGE' then 'Right-size to 2X-Large' when '4X-LARGE' then 'Right-size to 3X-Large' end end as rightsize_suggestion
        from c_proj""",
    "c_est": """
        select p.warehouse_name, p.idle_month_est as idle_usd_month_est,
               cast(round_even(p.idle_share, 0) as decimal(38,0)) as idle_share_pct, r.rightsize_suggestion
        from c_proj p left join c_rs r on p.warehouse_name = r.warehouse_name""",
    "c_budget_win": f"""
        select department, {usd('sum(budget_usd)')} as budget_window_usd from c_budget
        where date between {ASOF} - 30 and {ASOF} - 1 group by 1""",
    "c_dept_win": f"select * from c_dept where usage_date between {ASOF} - 30 and {ASOF} - 1",
    "c_daily_win": f"select * from c_daily where usage_date between {ASOF} - 30 and {ASOF} - 1",
    "c_insights": f"""
        select 'department' as scope, s.name, s.window_spend_usd, cast(null as decimal(38,6)) as idle_usd_month_est,
               cast(null as decimal(38,0)) as idle_share_pct, cast(null as varchar) as suggested_action,
               case when b.budget_window_usd > 0 then {pct('s.window_spend_usd - b.budget_window_usd', 'b.budget_window_usd')} end as vs_budget_pct
        from (select department as name, {usd('sum(total_cost_usd)')} as window_spend_usd from c_dept_win group by 1) s
        left join c_budget_win b on s.name = b.department
        union all
        select 'warehouse', w.name, w.window_spend_usd, e.idle_usd_month_est, e.idle_share_pct,
               coalesce(e.rightsize_suggestion, case when e.idle_share_pct >= 70 then 'Schedule weekends'
                   when e.idle_share_pct >= 40 then 'Auto-suspend 5 min' when e.idle_share_pct >= 20 then 'Auto-suspend 10 min' end, ''),
               cast(null as decimal(38,2))
        from (select warehouse_name as name, {usd('sum(total_cost)')} as window_spend_usd from c_daily_win group by 1) w
        left join c_est e on w.name = e.warehouse_name""",
}

_NAME = re.compile(r"\bc_[a-z0-9_]+\b")


def _needed(sql: str, found: dict[str, str], ctes: dict[str, str]) -> None:
    for name in dict.fromkeys(_NAME.findall(sql)):
        if name in ctes and name not in found:
            _needed(ctes[name], found, ctes)
            found[name] = ctes[name]


def with_ctes(sql: str, as_of: str = AS_OF, extra: dict[str, str] | None = None) -> str:
    found: dict[str, str] = {}
    _needed(sql, found, {**CTES, **(extra or {})})
    prefix = ",\n".join(f"{name} as ({text})" for name, text in found.items())
    return f"{'with ' + prefix if prefix else ''}\n{sql}".replace("$asof", as_of).strip()
