"""Operators built for skew, against brute force on skewed data, and the shape of the physical plans."""

import random
from datetime import date, datetime

import pytest
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from costmart.operators import forecast, incremental, ranking, spenders
from costmart.plans import marts
from costmart.sources import readers, schemas


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_ranks_equal_the_window_on_a_hot_day_with_ties(spark):
    rng = random.Random(7)
    rows = []
    for i in range(6000):
        day = 1 if i % 3 == 0 else rng.choice([None, *range(2, 30)])
        value = rng.choice([None, 0, 1, 1, 1, 5, rng.randint(0, 2**45), 2**20, 2**20 - 1, 2**20 + 1])
        rows.append((i, day, value))
    frame = spark.createDataFrame(rows, "id int, day int, v bigint")
    for nulls, order in (("last", F.desc_nulls_last("v")), ("first", F.desc_nulls_first("v"))):
        value = ranking.sortable(F.col("v"), nulls=nulls)
        ours = ranking.add_rank(frame, ranking.descending_ranks(frame, "day", value), "day", value, "r")
        brute = frame.withColumn("r", F.rank().over(W.partitionBy("day").orderBy(order)))
        assert {(r.id, r.r) for r in ours.collect()} == {(r.id, r.r) for r in brute.collect()}


def test_negative_values_rank_below_zero(spark):
    frame = spark.createDataFrame([(1, v) for v in (-5, -1, 0, 3, -(2**21))], "day int, v bigint")
    value = ranking.sortable(F.col("v"))
    ranks = {r._value: r._rank for r in ranking.descending_ranks(frame, "day", value).collect()}
    assert ranks == {3: 1, 0: 2, -1: 3, -5: 4, -(2**21): 5}


def test_positions_equal_dense_rank(spark):
    names = [f"W{i % 97}" for i in range(1000)] + ["HOT"] * 500 + [None]
    frame = spark.createDataFrame([(n,) for n in names], "name string").repartition(7)
    found = {r["name"]: r.n for r in ranking.dense_index(frame, "name", "n").collect()}
    assert found == {n: i for i, n in enumerate(sorted({n for n in names if n}), 1)}


def test_days_are_never_windowed_whole(spark, tables):
    plan = plan_of(spenders.top_spenders(tables["int_top_spenders"]))
    assert "rank(" not in plan
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_ranking_equals_windows(spark, tables):
    # Some rows without a date or a user, which form groups of their own.
    undated = F.when(F.col("warehouse_name") != "WH_1", F.col("usage_date")).alias("usage_date")
    unnamed = F.when(F.col("warehouse_name") != "WH_2", F.col("user_name")).alias("user_name")
    others = [c for c in tables["int_top_spenders"].columns if c not in ("usage_date", "user_name")]
    base = tables["int_top_spenders"].select(undated, unnamed, *others)
    found = spenders.top_spenders(base)
    assert found.where("usage_date is null").count() > 0 and found.where("rank_by_cost is null").count() == 0
    day = W.partitionBy("usage_date")
    by = {
        "rank_by_query_count": F.desc("query_count"),
        "rank_by_runtime": F.desc_nulls_first("total_runtime_seconds"),
        "rank_by_cost": F.desc("estimated_cost_usd"),
    }
    ranks = [F.rank().over(day.orderBy(order)).cast("bigint").alias(c) for c, order in by.items()]
    want = spenders.spenders_daily(base).select("usage_date", "user_name", *ranks)
    found = found.select(*want.columns)
    assert found.exceptAll(want).count() == 0 and want.exceptAll(found).count() == 0


def test_copies_of_one_key_are_reduced_before_the_shuffle(spark):
    frame = spark.createDataFrame([("k", i) for i in range(100)], "key string, seq int").repartition(4)
    plan = plan_of(incremental.latest_per_key(frame, "key", ["seq"]))
    before_exchange = plan.index("WindowGroupLimit", plan.index("Exchange"))
    assert "Partial" in plan[before_exchange:]


def test_horizon_and_watermark_reach_the_scan(spark, cfg, tmp_path):
    rows = [("1", datetime(2024, 1, 5), datetime(2024, 1, 5, 1), "u", "r", "W", "S", "Q", "D", "S", "SUCCESS", 1, 1, 1, 1)]
    spark.createDataFrame(rows, schemas.QUERIES).write.parquet(f"{tmp_path}/q")
    source = readers.load(spark, f"{tmp_path}/q", schemas.QUERIES)
    recent = readers.read_queries(source, cfg)
    assert "GreaterThanOrEqual(start_time,2024-01-01T00:00)" in plan_of(recent)
    target = spark.createDataFrame([(datetime(2024, 1, 4, 8),)], "usage_hour_ntz timestamp_ntz")
    late = incremental.since_watermark(source, target)
    assert "GreaterThanOrEqual(end_time,2024-01-04T07:00)" in plan_of(late)
    pruned = recent.select("query_id")
    assert "ReadSchema: struct<query_id:string,start_time:timestamp_ntz>" in plan_of(pruned)


def test_forecast_is_one_aggregation_without_joins(spark, cfg, tables):
    plan = plan_of(forecast.cost_forecast(tables["fct_daily_costs"], cfg))
    assert "Join" not in plan and plan.count("Exchange") == 1


def test_read_back_prunes_date_directories(spark, cfg, tables):
    plan = plan_of(readers.recent(tables["fct_top_spenders"], cfg, 3))
    assert "PartitionFilters: [isnotnull(usage_date" in plan and "2024-01-17" in plan


def test_no_mart_uses_a_cross_or_nested_loop_join(spark, cfg, tables):
    lazy = {}

    def keep(name, df):
        lazy[name] = df
        return tables[name]

    from conftest import DATA
    from costmart.sources.adapter import Inputs

    inputs = Inputs(spark, DATA)
    sources = marts.Sources(
        inputs.metering(), inputs.queries(), inputs.storage(), inputs.department_map(), inputs.budget(),
        inputs.attribution(), inputs.clustering(),
    )
    marts.build(sources, cfg, keep)
    assert len(lazy) == 12
    for name, df in lazy.items():
        plan = plan_of(df)
        for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "PythonUDF", "SinglePartition"):
            assert bad not in plan, (name, bad)


@pytest.mark.parametrize("hot", ["user", "hour"])
def test_activity_counts_a_hot_group_exactly(spark, cfg, hot):
    from costmart.operators.hourly import query_activity

    rows = [("W", datetime(2024, 1, 1, 0 if hot == "hour" or i % 3 else i % 24), "u" if hot == "user" else f"u{i}", 1000, 2**30) for i in range(3000)]
    frame = spark.createDataFrame(rows, "warehouse_name string, usage_hour_ntz timestamp_ntz, user_name string, total_elapsed_ms bigint, bytes_scanned bigint")
    out = query_activity(frame).collect()
    assert sum(r.query_count for r in out) == 3000
    assert max(r.unique_users for r in out) == (1 if hot == "user" else 3000)
    assert date(2024, 1, 1) == out[0].usage_hour_ntz.date()
