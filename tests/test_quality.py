"""Checks find what they should, the published marts pass theirs, and totals reconcile."""

from datetime import date, datetime
from decimal import Decimal

from pyspark.sql import functions as F

from costmart.operators import quality as Q
from costmart.operators.daily import DAILY_CONTRACT
from costmart.operators.storage import STORAGE_CONTRACT
from costmart.plans import marts
from costmart.sources.adapter import Inputs

from conftest import DATA


def test_violations_are_found(spark):
    frame = spark.createDataFrame([("a", 1), ("a", 5), (None, None), ("b", 9)], "k string, v int")
    assert Q.not_null(frame, "k").count() == 1
    assert [tuple(r) for r in Q.unique(frame, "k").collect()] == [("a", 2)]
    assert Q.unique_combo(frame, ["k", "v"]).count() == 0
    assert [r.v for r in Q.between(frame, "v", 2, 8).orderBy("v").collect()] == [1, 9]
    assert [r.v for r in Q.between(frame, "v", 2, 8, where="k = 'b'").collect()] == [9]
    assert [r.k for r in Q.accepted(frame, "k", ["a"]).collect()] == ["b"]
    assert [r.k for r in Q.relationship(frame, spark.createDataFrame([("a",), (None,)], "k string"), "k").collect()] == ["b"]


def test_duplicate_map_rows_are_caught(spark):
    mapping = spark.createDataFrame([("W", "A"), ("w ", "B")], "warehouse_name string, department string")
    from costmart.operators.departments import dim_department

    assert Q.unique(dim_department(mapping), "warehouse_name").count() == 1


def test_freshness_bands(spark):
    frame = spark.createDataFrame([(datetime(2024, 1, 1),)], "t timestamp_ntz")
    for now, status in ((datetime(2024, 1, 3), "pass"), (datetime(2024, 1, 3, 0, 1), "warn"), (datetime(2024, 1, 5, 1), "error")):
        assert Q.source_freshness(frame, "t", now).first().status == status
    assert Q.source_freshness(frame.limit(0), "t", datetime(2024, 1, 1)).first().status == "missing"
    ahead = spark.createDataFrame([(date(2024, 1, 9),)], "usage_date date")
    assert Q.mart_freshness(ahead, datetime(2024, 1, 1)).first().age_hours == 0


def test_contracts(spark, tables):
    assert Q.matches_contract(tables["fct_daily_costs"], DAILY_CONTRACT)
    assert Q.matches_contract(tables["fct_daily_storage_costs"], STORAGE_CONTRACT)
    assert Q.contract_differences(tables["fct_daily_costs"], DAILY_CONTRACT).count() == 0
    other = tables["fct_daily_costs"].drop("total_cost").withColumn("extra", F.lit(1))
    assert {r["column"] for r in Q.contract_differences(other, DAILY_CONTRACT).collect()} == {"total_cost", "extra"}


def test_all_marts_pass_their_suites(spark, tables):
    inputs = Inputs(spark, DATA)
    extra = {"budget_daily": inputs.budget(), "storage_history": inputs.storage(), "query_history": inputs.queries()}
    found = marts.check({**tables, **extra}).collect()
    assert len(found) >= 75
    assert [r for r in found if r.violations] == []


def test_totals_reconcile(spark, tables):
    total = tables["fct_daily_costs"].agg(F.sum("total_cost")).first()[0]
    assert tables["fct_cost_by_department"].agg(F.sum("total_cost_usd")).first()[0] == total
    assert tables["fct_budget_vs_actual"].agg(F.sum("actual_cost_usd")).first()[0] == total
    compute = tables["fct_total_cost_summary"].where("cost_category = 'COMPUTE'").agg(F.sum("cost_usd")).first()[0]
    assert compute == total


def test_month_end_equals_the_sum_of_days(spark, tables):
    daily = tables["fct_daily_costs"].where("usage_date <= '2024-01-31'")
    sums = daily.groupBy("warehouse_name").agg(F.sum("total_cost").alias("s"), F.max_by("month_to_date_cost", "usage_date").alias("m"))
    assert sums.where("s <> m").count() == 0


def test_shares_add_up_to_a_hundred(spark, tables):
    for name, column in (("fct_total_cost_summary", "pct_of_daily_total"), ("fct_top_spenders", "pct_of_daily_query_total")):
        rows = tables[name].groupBy("usage_date").agg(F.sum(column).alias("s"), F.count("*").alias("n")).collect()
        assert all(abs(r.s - 100) <= Decimal("0.005") * r.n for r in rows), name


def test_ranks_start_at_one_and_grow_with_smaller_values(spark, tables):
    rows = tables["fct_top_spenders"].select("usage_date", "query_count", "rank_by_query_count").collect()
    for day in {r.usage_date for r in rows}:
        own = [r for r in rows if r.usage_date == day]
        for r in own:
            assert r.rank_by_query_count == 1 + sum(o.query_count > r.query_count for o in own)


def test_all_checks_of_a_table_share_one_scan(spark, tmp_path):
    from pyspark.sql import functions as F

    from costmart.operators.quality import Suite, run_checks
    from costmart.sources.writers import write_table

    rows = [("a", 1, "x", 5), ("a", 1, "x", -1), (None, 2, "y", None), (None, 2, "z", 3), ("b", None, "gone", -7), ("c", None, None, 1)]
    child = write_table(spark.createDataFrame(rows, "k string, n int, ref string, v int"), f"{tmp_path}/child")
    parent = write_table(spark.createDataFrame([("x",), ("y",), (None,)], "ref string"), f"{tmp_path}/parent")
    suites = {
        "child": Suite(
            not_null=("k", "ref"), unique=("k", "n"), unique_combos=(("k", "n"),), between=(("v", 0, None),),
            accepted=(("ref", ("x", "y", "z")),), relationships=(("ref", "parent"), ("k", "parent2")), rules={"odd": "v % 2 <> 0"},
        ),
        "parent": Suite(unique=("ref",)),
    }
    parent2 = write_table(spark.createDataFrame([("a",), ("b",), ("c",)], "k string"), f"{tmp_path}/parent2")
    checked = run_checks({"child": child, "parent": parent, "parent2": parent2}, suites)
    plan = checked._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") == 3
    got = {(r.table_name, r.check_name): r.violations for r in checked.collect()}
    assert got == {
        ("child", "not_null(k)"): 2, ("child", "not_null(ref)"): 1, ("child", "unique(k)"): 1, ("child", "unique(n)"): 2,
        ("child", "unique(k, n)"): 2, ("child", "between(v)"): 2, ("child", "accepted(ref)"): 1, ("child", "relationship(ref)"): 2,
        ("child", "relationship(k)"): 0, ("child", "odd"): 5, ("parent", "unique(ref)"): 0,
    }
    empty = run_checks({"child": child.where(F.lit(False)), "parent": parent, "parent2": parent2}, suites)
    assert {r.violations for r in empty.collect()} == {0}
