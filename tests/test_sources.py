"""Readers, writers and helpers on files and tables."""

from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from costmart.sources import readers, schemas, writers
from costmart.sources.adapter import Inputs

from conftest import DATA


@pytest.mark.parametrize("fmt", ["parquet", "orc", "json", "csv"])
def test_file_formats_round_trip(spark, tmp_path, fmt):
    rows = [("W1", "Data"), ("W2", "Sales")]
    frame = spark.createDataFrame(rows, schemas.DEPARTMENT_MAP)
    frame.write.option("header", True).format(fmt).save(f"{tmp_path}/m")
    assert sorted(tuple(r) for r in readers.load(spark, f"{tmp_path}/m", schemas.DEPARTMENT_MAP, fmt).collect()) == rows


def test_catalog_tables_are_read_with_the_declared_types(spark):
    spark.createDataFrame([("A", "2024-01-01", "12.50")], "department string, date string, budget_usd string").createOrReplaceTempView("plan")
    frame = readers.load(spark, "plan", schemas.BUDGET, "table")
    assert frame.schema == schemas.BUDGET and frame.first().budget_usd == Decimal("12.50")
    assert readers.table_exists(spark, "plan") and not readers.table_exists(spark, "no_such_table")


def test_live_inputs_and_optional_inputs(spark, tmp_path):
    inputs = Inputs(spark, DATA)
    paths = {name: f"{tmp_path}/{name}" for name in ("metering", "queries", "storage")}
    for name, path in paths.items():
        getattr(inputs, name)().write.parquet(path)
    loaded = readers.load_inputs(spark, "live", paths)
    for name in paths:
        assert loaded[name].schema == getattr(schemas, name.upper())
        assert readers.has_rows(loaded[name])
    assert readers.optional_inputs(spark) == {"attribution": None, "clustering": None}
    with pytest.raises(ValueError):
        readers.load_inputs(spark, "other", paths)


def test_horizon_of_the_adapter_changes_no_result(spark, cfg):
    inputs = Inputs(spark, DATA)
    since = cfg.days_ago(cfg.query_history_days)
    for read, frame in ((readers.read_queries, inputs.queries), (readers.read_metering, inputs.metering)):
        assert read(frame(), cfg).exceptAll(read(frame(since), cfg)).count() == 0
    assert "GreaterThanOrEqual(ts,2024-01-01T00:00)" in inputs.queries(since)._jdf.queryExecution().executedPlan().toString()


def test_storage_horizon_applies_to_full_builds_only(spark, cfg):
    rows = [(date(2022, 1, 1), 1, "D", Decimal(1), Decimal(1)), (date(2024, 1, 1), 1, "D", Decimal(1), Decimal(1))]
    frame = spark.createDataFrame(rows, schemas.STORAGE)
    assert readers.read_storage(frame, cfg).count() == 1 and readers.read_storage(frame, cfg, full=False).count() == 2


def test_clustered_table_is_sorted_inside_its_files(spark, tmp_path):
    rows = [(date(2024, 1, 1 + i % 2), f"W{i * 7 % 10}", i) for i in range(100)]
    frame = spark.createDataFrame(rows, "usage_date date, warehouse_name string, n int").repartition(5)
    stored = writers.write_clustered(frame, f"{tmp_path}/t")
    assert stored.columns == frame.columns and stored.count() == 100
    for file in (tmp_path / "t").glob("usage_date=*/*.parquet"):
        names = [r.warehouse_name for r in spark.read.parquet(str(file)).coalesce(1).collect()]
        assert names == sorted(names)


def test_settings_need_a_suspend_column(spark):
    with pytest.raises(ValueError):
        readers.warehouse_settings(spark.createDataFrame([("W",)], "name string"))
    row = readers.warehouse_settings(spark.createDataFrame([("w", "x")], "Name string, Auto_Suspend string")).first()
    assert (row.name, row.auto_suspend, row.size) == ("W", None, None)


def test_recent_window_covers_the_window_before(spark, cfg):
    frame = spark.createDataFrame([(date(2024, 1, d),) for d in range(1, 32)], "usage_date date")
    assert readers.recent(frame, cfg, 3).agg(F.min("usage_date")).first()[0] == date(2024, 1, 17)
    assert readers.recent(frame, cfg, 7).agg(F.min("usage_date")).first()[0] == date(2024, 1, 10)


def test_text_rows_are_conformed(spark):
    values = {name: "1" for name in schemas.QUERIES.names} | {"start_time": "2024-01-01 05:00:00", "end_time": "nonsense"}
    row = readers.conform_queries(spark.createDataFrame([tuple(values[n] for n in schemas.QUERIES.names)], schemas.RAW_QUERIES)).first()
    assert row.start_time == datetime(2024, 1, 1, 5) and row.end_time is None and row.bytes_scanned == 1
