"""Incremental loads: late rows, repeated keys, moved dates, two deliveries against one."""

from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from costmart.config import Config
from costmart.operators import incremental as I
from costmart.plans import marts
from costmart.session import require_local
from costmart.sources.adapter import Inputs
from costmart.sources.writers import read_table
from costmart.streaming import ingest

from conftest import DATA


def rows_of(df, *columns):
    return sorted(tuple(r) for r in df.select(*columns).collect())


def test_lookback_keeps_the_mark_and_the_hour_before(spark):
    target = spark.createDataFrame([(datetime(2024, 1, 1, 10),)], "usage_hour_ntz timestamp_ntz")
    src = spark.createDataFrame([(datetime(2024, 1, 1, h, 59),) for h in (8, 9, 10, 11)], "end_time timestamp_ntz")
    assert [r.end_time.hour for r in I.since_watermark(src, target).orderBy("end_time").collect()] == [9, 10, 11]


def test_empty_target_and_unknown_columns_select_everything(spark):
    src = spark.createDataFrame([(datetime(2024, 1, 1, 8),)], "end_time timestamp_ntz")
    empty = spark.createDataFrame([], "usage_hour_ntz timestamp_ntz")
    assert I.since_watermark(src, empty).count() == 1
    assert I.since_watermark(src, spark.createDataFrame([(1,)], "x int")).count() == 1
    days = spark.createDataFrame([(date(2024, 1, 1),)], "usage_date date")
    nothing = spark.createDataFrame([], "usage_date date")
    assert I.since_watermark(days, nothing, (I.STORAGE_WATERMARK,), "usage_date").count() == 1


def test_storage_mark_is_strict(spark):
    days = spark.createDataFrame([(date(2024, 1, d),) for d in (1, 2, 3)], "usage_date date")
    target = spark.createDataFrame([(date(2024, 1, 2),)], "usage_date date")
    assert rows_of(I.since_watermark(days, target, (I.STORAGE_WATERMARK,), "usage_date"), "usage_date") == [(date(2024, 1, 3),)]


def test_same_key_twice_keeps_the_newest(spark):
    target = spark.createDataFrame([("a", 1, "old"), ("b", 1, "old")], "k string, seq int, v string")
    batch = spark.createDataFrame([("a", 2, "mid"), ("a", 3, "new"), ("c", 1, "new")], "k string, seq int, v string")
    assert rows_of(I.upsert(target, batch, "k", ["seq"]), "k", "v") == [("a", "new"), ("b", "old"), ("c", "new")]


def test_schema_policy(spark):
    target = spark.createDataFrame([("a", 1)], "k string, n int")
    batch = spark.createDataFrame([("b", "x")], "k string, extra string")
    merged = I.upsert(target, batch, "k", ["k"])
    assert merged.columns == ["k", "n", "extra"] and merged.count() == 2
    with pytest.raises(ValueError, match="extra"):
        I.sync_schema(target, batch, "fail")


def test_table_merge_rewrites_touched_dates_and_moves_rows(spark, tmp_path):
    schema = "k string, seq int, usage_date date"
    path = f"{tmp_path}/t"
    first = spark.createDataFrame([("a", 1, date(2024, 1, 1)), ("b", 1, date(2024, 1, 2)), ("c", 1, date(2024, 1, 3))], schema)
    I.upsert_table(spark, path, first, "k", ["seq"])
    untouched = {p.name for p in (tmp_path / "t" / "usage_date=2024-01-03").glob("*.parquet")}
    # "a" moves to another date, leaving its old date empty; "b" stays in place; "d" is new.
    batch = spark.createDataFrame([("a", 2, date(2024, 1, 2)), ("d", 1, date(2024, 1, 4))], schema)
    for _ in range(2):  # the second run stands for a retry
        out = I.upsert_table(spark, path, batch, "k", ["seq"])
        assert rows_of(out, "k", "seq", "usage_date") == [
            ("a", 2, date(2024, 1, 2)),
            ("b", 1, date(2024, 1, 2)),
            ("c", 1, date(2024, 1, 3)),
            ("d", 1, date(2024, 1, 4)),
        ]
    assert not (tmp_path / "t" / "usage_date=2024-01-01").exists()
    assert {p.name for p in (tmp_path / "t" / "usage_date=2024-01-03").glob("*.parquet")} == untouched


def test_interrupted_replacement_is_finished_by_the_next_run(spark, tmp_path, monkeypatch):
    schema = "k string, seq int, usage_date date"
    path = f"{tmp_path}/t"
    first = spark.createDataFrame([("a", 1, date(2024, 1, 1)), ("b", 1, date(2024, 1, 1))], schema)
    I.upsert_table(spark, path, first, "k", ["seq"])
    batch = spark.createDataFrame([("a", 2, date(2024, 1, 1))], schema)
    finish, calls = I.finish_pending, []

    def die(spark, path):
        calls.append(path)
        if len(calls) == 2:  # the replacement itself: the old date is gone, the new one not yet there
            I._delete(spark, f"{path}/usage_date=2024-01-01")
            raise RuntimeError("lost driver")
        finish(spark, path)

    monkeypatch.setattr(I, "finish_pending", die)
    with pytest.raises(RuntimeError):
        I.upsert_table(spark, path, batch, "k", ["seq"])
    monkeypatch.setattr(I, "finish_pending", finish)
    out = I.upsert_table(spark, path, batch, "k", ["seq"])
    assert rows_of(out, "k", "seq") == [("a", 2), ("b", 1)]
    assert not (tmp_path / "t.pending").exists()


def test_backfill_fills_only_what_is_missing(spark):
    target = spark.createDataFrame(
        [(datetime(2024, 1, 1, 5, 30), None), (datetime(2024, 1, 1, 6, 30), datetime(2024, 1, 1, 1))],
        "hour_start timestamp_ntz, usage_hour_ntz timestamp_ntz",
    )
    out = rows_of(I.backfill(target), "usage_hour_ntz", "usage_date")
    assert out == [(datetime(2024, 1, 1, 1), date(2024, 1, 1)), (datetime(2024, 1, 1, 5), date(2024, 1, 1))]


def test_incremental_build_in_two_deliveries_equals_one_full_build(spark, cfg, tables, tmp_path):
    inputs = Inputs(spark, DATA)
    cut = F.lit(datetime(2024, 1, 18, 7)).cast("timestamp_ntz")
    cut_day = F.lit(date(2024, 1, 18))

    def sources(early: bool):
        keep = (lambda df, c, v: df.where(F.col(c) <= v)) if early else (lambda df, c, v: df)
        return marts.Sources(
            keep(inputs.metering(), "end_time", cut), keep(inputs.queries(), "end_time", cut),
            keep(inputs.storage(), "usage_date", cut_day), inputs.department_map(), inputs.budget(),
            inputs.attribution(), inputs.clustering(),
        )

    root = str(tmp_path / "warehouse")
    marts.build_incremental(spark, root, sources(True), cfg)
    built = marts.build_incremental(spark, root, sources(False), cfg)
    for name in ("stg_query_history", "stg_storage_usage", "int_hourly_compute_costs", "fct_daily_costs", "fct_top_spenders", "fct_total_cost_summary"):
        columns = tables[name].columns
        assert built[name].select(*columns).exceptAll(tables[name]).count() == 0, name
        assert tables[name].exceptAll(built[name].select(*columns)).count() == 0, name


def test_stream_of_files_equals_the_batch(spark, cfg, tables, tmp_path):
    queries = Inputs(spark, DATA).queries()
    landing, path = f"{tmp_path}/landing", f"{tmp_path}/table"
    cut = F.lit(datetime(2024, 1, 15)).cast("timestamp_ntz")
    again = queries.where(F.col("end_time") <= cut)
    queries.where(F.col("end_time") > cut - F.expr("interval 2 hours")).coalesce(1).write.mode("append").parquet(landing)
    again.coalesce(1).write.mode("append").parquet(landing)

    def run():
        stream = ingest.ingest_queries(spark, landing, path, f"{tmp_path}/checkpoint", cfg, files_per_batch=1)
        assert stream.awaitTermination(240)
        return read_table(spark, path, tables["stg_query_history"].schema)

    want = rows_of(tables["stg_query_history"], "query_id", "usage_hour_ntz")
    # The stream has no horizon filter; the batch build drops statements started before it.
    horizon = datetime(2024, 1, 1)
    first = run()
    assert rows_of(first.where(F.col("start_time") >= F.lit(horizon).cast("timestamp_ntz")), "query_id", "usage_hour_ntz") == want
    assert rows_of(run(), "query_id") == rows_of(first, "query_id")  # nothing new landed


def test_streamed_hours_equal_batch_hours(spark, tables, tmp_path):
    landing = f"{tmp_path}/landing"
    staged = tables["stg_query_history"]
    columns = ["warehouse_name", "end_time", "user_name", "total_elapsed_ms", "bytes_scanned"]
    staged.select(*columns).coalesce(1).write.parquet(landing)
    stream = ingest.read_landing(spark, landing, staged.select(*columns).schema)
    query = (
        ingest.hourly_activity_stream(stream).writeStream.format("memory").queryName("activity")
        .option("checkpointLocation", f"{tmp_path}/checkpoint").outputMode("append").trigger(availableNow=True).start()
    )
    assert query.awaitTermination(240)
    out = {(r.warehouse_name, r.usage_hour_ntz): (r.query_count, r.total_elapsed_ms) for r in spark.table("activity").collect()}
    want = {
        (r.warehouse_name, r.usage_hour_ntz): (r.n, r.ms)
        for r in staged.groupBy("warehouse_name", "usage_hour_ntz").agg(F.count("*").alias("n"), F.sum("total_elapsed_ms").alias("ms")).collect()
    }
    last = max(r.end_time for r in staged.select(F.max("end_time").alias("end_time")).collect()) - timedelta(hours=1)
    closed = {k: v for k, v in want.items() if k[1] + timedelta(hours=1) <= last}
    assert closed and all(out.get(k) == v for k, v in closed.items())
    assert all(want[k] == v for k, v in out.items())


SCHEMA = "k string, seq int, usage_date date"
DAY = date(2024, 1, 1)


def test_rows_without_a_date_are_kept_and_moved(spark, tmp_path):
    path = f"{tmp_path}/t"
    I.upsert_table(spark, path, spark.createDataFrame([("a", 1, None), ("b", 1, None)], SCHEMA), "k", ["seq"])
    out = I.upsert_table(spark, path, spark.createDataFrame([("c", 1, None)], SCHEMA), "k", ["seq"])
    assert sorted(r.k for r in out.collect()) == ["a", "b", "c"]
    moved = spark.createDataFrame([("a", 2, DAY), ("b", 2, DAY), ("c", 2, DAY)], SCHEMA)
    out = I.upsert_table(spark, path, moved, "k", ["seq"])
    assert rows_of(out, "k", "seq", "usage_date") == [(k, 2, DAY) for k in "abc"]


def test_rows_without_a_key_are_neither_merged_nor_repeated(spark, tmp_path):
    path = f"{tmp_path}/t"
    rows = [(None, 1, DAY), (None, 1, DAY), (None, 2, DAY), ("a", 1, DAY)]
    batch = spark.createDataFrame(rows, SCHEMA)
    for _ in range(2):  # the second run repeats the batch, as a lookback does
        out = I.upsert_table(spark, path, batch, "k", ["seq"])
        assert sorted(r.seq for r in out.where("k is null").collect()) == [1, 1, 2]
    out = I.upsert_table(spark, path, spark.createDataFrame([(None, 3, DAY)], SCHEMA), "k", ["seq"])
    assert sorted(r.seq for r in out.where("k is null").collect()) == [1, 1, 2, 3]


def test_stored_schema_decides_on_changes(spark, tmp_path):
    path = f"{tmp_path}/t"
    wide = spark.createDataFrame([("a", 1, DAY, "x"), ("b", 1, date(2024, 1, 2), "y")], SCHEMA + ", extra string")
    I.upsert_table(spark, path, wide, "k", ["seq"])
    batch = spark.createDataFrame([("c", 1, DAY)], SCHEMA)
    with pytest.raises(ValueError, match="extra"):
        I.upsert_table(spark, path, batch, "k", ["seq"], policy="fail")
    out = I.upsert_table(spark, path, batch, "k", ["seq"])
    assert {r.k: r.extra for r in out.collect()} == {"a": "x", "b": "y", "c": None}


def test_a_run_that_dies_between_two_moves_is_finished(spark, tmp_path, monkeypatch):
    path = f"{tmp_path}/t"
    days = [date(2024, 1, d) for d in (1, 2, 3)]
    I.upsert_table(spark, path, spark.createDataFrame([("a", 1, days[0]), ("b", 1, days[1])], SCHEMA), "k", ["seq"])
    move, moved = I._move, []

    def die(spark, source, target):
        if moved:
            raise RuntimeError("lost driver")
        moved.append(source)
        move(spark, source, target)

    monkeypatch.setattr(I, "_move", die)
    batch = spark.createDataFrame([("a", 2, days[2]), ("b", 2, days[1])], SCHEMA)
    with pytest.raises(RuntimeError):
        I.upsert_table(spark, path, batch, "k", ["seq"])
    monkeypatch.setattr(I, "_move", move)
    I.finish_pending(spark, path)
    assert rows_of(I.stored_table(spark, path), "k", "seq", "usage_date") == [("a", 2, days[2]), ("b", 2, days[1])]
    assert sorted(p.name for p in tmp_path.iterdir()) == ["t"]


def test_merged_dates_stay_sorted(spark, tmp_path):
    import pyarrow.parquet as pq

    path = f"{tmp_path}/t"
    for start in (0, 500):
        rows = [(str(i), i % 7, DAY) for i in range(start, start + 1000)]
        I.upsert_table(spark, path, spark.createDataFrame(rows, SCHEMA).repartition(5), "k", ["seq"], sort_by="seq")
    for file in (tmp_path / "t" / "usage_date=2024-01-01").glob("*.parquet"):
        values = pq.read_table(file, partitioning=None)["seq"].to_pylist()
        assert values == sorted(values)


def test_a_missing_table_does_not_cost_the_others_their_history(spark, cfg, tmp_path):
    inputs = Inputs(spark, DATA)
    sources = marts.Sources(inputs.metering(), inputs.queries(), inputs.storage(), inputs.department_map(), inputs.budget())
    root = str(tmp_path / "warehouse")
    first = marts.build_incremental(spark, root, sources, cfg)
    before, hours = first["stg_query_history"].count(), first["stg_warehouse_metering"].count()
    I._delete(spark, f"{root}/int_hourly_compute_costs")
    # A month later the sources' horizon no longer reaches the first weeks.
    later = marts.build_incremental(spark, root, sources, Config(as_of=date(2024, 2, 20)))
    assert later["stg_query_history"].count() == before
    assert later["int_hourly_compute_costs"].count() == hours


def test_temporary_folders_are_for_one_machine_only():
    for master in ("local", "local[8]", "local[*]"):
        require_local(master)
    for master in ("yarn", "spark://host:7077", "local-cluster[2,1,1024]", "k8s://x"):
        with pytest.raises(ValueError, match="checkpoint"):
            require_local(master)
