"""Merges that find keys by index, note what they changed, and marts that follow from there."""

import re
from datetime import date, datetime, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from costmart.operators import continued as con
from costmart.operators import incremental as I
from costmart.operators import keyindex as K
from costmart.operators import warehouses as WH
from costmart.plans import catalog, marts
from costmart.session import stage_table
from costmart.sources import files
from costmart.sources.adapter import Inputs
from costmart.sources.writers import write_table

from conftest import DATA

SCHEMA = "k string, seq int, usage_date date"
DAY = date(2024, 1, 1)


def days(n):
    return [DAY + timedelta(days=i) for i in range(n)]


def executed(df):
    return df._jdf.queryExecution().executedPlan().toString()


def same(a, b, name=""):
    columns = b.columns
    assert a.select(*columns).exceptAll(b).count() == 0, name
    assert b.exceptAll(a.select(*columns)).count() == 0, name


def test_key_search_reads_only_the_buckets_of_the_batch(spark, tmp_path):
    path = f"{tmp_path}/t"
    rows = [(str(i), 1, d) for i, d in enumerate(days(30) * 20)]
    I.upsert_table(spark, path, spark.createDataFrame(rows, SCHEMA), "k", ["seq"])
    I.upsert_table(spark, path, spark.createDataFrame([("new", 1, DAY)], SCHEMA), "k", ["seq"])  # builds the index
    table = I.stored_table(spark, path)
    batch = spark.createDataFrame([("7", 2, DAY), ("new", 2, days(4)[3])], SCHEMA)
    found = K.dates_of_keys(spark, path, table, batch, "k", "usage_date")
    buckets = sorted(r[0] for r in batch.select(K.bucket_of("k", K.bucket_count(spark, path))).distinct().collect())
    assert len(buckets) <= 2
    filters = re.search(r"PartitionFilters: \[([^\]]*)\]", executed(found)).group(1)
    assert "_bucket" in filters and all(str(b) in filters for b in buckets)
    assert all("/_keys/" in f for f in found.inputFiles())
    for bucket in set(range(16)) - set(buckets):  # the others are not read
        for file in (tmp_path / "t" / "_keys" / f"_bucket={bucket}").glob("*.parquet"):
            file.write_bytes(b"no parquet")
    assert {r[0] for r in found.collect()} == {days(30)[7], DAY}
    out = I.upsert_table(spark, path, batch, "k", ["seq"])
    assert {r.k: r.usage_date for r in out.where("seq = 2").collect()} == {"7": DAY, "new": days(4)[3]}
    assert out.count() == 601


def test_index_covers_the_table_after_a_run_that_died_and_after_folding(spark, tmp_path, monkeypatch):
    path = f"{tmp_path}/t"
    monkeypatch.setattr(K, "LEAST_BUCKETS", 2)
    monkeypatch.setattr(K.crowded, "__defaults__", (2,))
    I.upsert_table(spark, path, spark.createDataFrame([(str(i), 0, days(9)[i % 9]) for i in range(40)], SCHEMA), "k", ["seq"])
    replace = I.replace_dates
    monkeypatch.setattr(I, "replace_dates", lambda *a: (_ for _ in ()).throw(RuntimeError("lost driver")))
    with pytest.raises(RuntimeError):
        I.upsert_table(spark, path, spark.createDataFrame([("3", 1, days(9)[8])], SCHEMA), "k", ["seq"])
    monkeypatch.setattr(I, "replace_dates", replace)
    for n in range(2, 6):
        moved = [(str(i), n, days(9)[(i + n) % 9]) for i in range(n, 40, 5)]
        out = I.upsert_table(spark, path, spark.createDataFrame(moved, SCHEMA), "k", ["seq"])
        assert out.count() == out.select("k").distinct().count() == 40
        assert all(len(files.names(spark, f"{K.index_path(path)}/_bucket={b}")) <= 2 * 4 for b in (0, 1))
    pairs = spark.read.parquet(K.index_path(path)).select("k", "usage_date")
    assert out.select("k", "usage_date").exceptAll(pairs.distinct()).count() == 0


def test_the_merge_that_builds_the_index_writes_it_once(spark, tmp_path):
    """The batch goes into the index by the write that builds it; the log is then not read back through it."""
    path = f"{tmp_path}/t"
    I.upsert_table(spark, path, spark.createDataFrame([(str(i), 0, days(9)[i % 9]) for i in range(40)] + [(None, 0, DAY)], SCHEMA), "k", ["seq"])
    out = I.upsert_table(spark, path, spark.createDataFrame([(str(i), 1, days(9)[8]) for i in range(30, 60)] + [(None, 0, DAY)], SCHEMA), "k", ["seq"])
    assert {r.k: (r.seq, r.usage_date) for r in out.where("k is not null").collect()} == {
        str(i): (0, days(9)[i % 9]) if i < 30 else (1, days(9)[8]) for i in range(60)
    }
    assert out.where("k is null").count() == 1
    names = [files.names(spark, f"{K.index_path(path)}/_bucket={b}") for b in range(K.LEAST_BUCKETS)]
    assert max(sum(f.endswith(".parquet") for f in n) for n in names) == 1
    pairs = spark.read.parquet(K.index_path(path)).select("k", "usage_date")
    assert out.where("k is not null").select("k", "usage_date").exceptAll(pairs).count() == 0


def test_the_legacy_query_writes_its_log_once(spark, monkeypatch):
    staged = []
    monkeypatch.setattr(catalog, "stage_table", lambda df, name: staged.append(name) or stage_table(df, name))
    catalog.QUERIES["i04_legacy_tables"](spark, DATA)
    assert "staged" not in staged


def test_a_merge_reads_the_noted_schema_and_no_footers(spark, tmp_path):
    path = f"{tmp_path}/t"
    I.upsert_table(spark, path, spark.createDataFrame([("a", 1, DAY)], SCHEMA), "k", ["seq"])
    assert files.read_note(spark, f"{path}/_schema.json")["fields"]
    wide = spark.createDataFrame([("b", 1, days(2)[1], "x")], SCHEMA + ", extra string")
    I.upsert_table(spark, path, wide, "k", ["seq"])
    # A file that no reader of footers would survive: only the note can have told the schema.
    (tmp_path / "t" / "usage_date=2024-01-09").mkdir()
    (tmp_path / "t" / "usage_date=2024-01-09" / "part-broken.parquet").write_bytes(b"no parquet")
    out = I.upsert_table(spark, path, spark.createDataFrame([("c", 1, DAY)], SCHEMA), "k", ["seq"])
    assert out.columns == ["k", "seq", "usage_date", "extra"]
    assert {r.k: r.extra for r in out.where("usage_date < '2024-01-09'").collect()} == {"a": None, "b": "x", "c": None}
    files.delete(spark, f"{path}/usage_date=2024-01-09")
    files.delete(spark, f"{path}/_schema.json")  # a table of an older version
    assert set(I.stored_table(spark, path).columns) == {"k", "seq", "usage_date", "extra"}


def test_changes_are_noted_until_they_are_taken(spark, tmp_path):
    path = f"{tmp_path}/t"
    I.upsert_table(spark, path, spark.createDataFrame([("a", 1, DAY), ("b", 1, None)], SCHEMA), "k", ["seq"])
    assert I.changed_dates(spark, path) is None  # a new table: all
    I.take_changes(spark, path)
    assert I.changed_dates(spark, path) == []
    I.upsert_table(spark, path, spark.createDataFrame([("a", 2, days(3)[2])], SCHEMA), "k", ["seq"])
    I.upsert_table(spark, path, spark.createDataFrame([("b", 2, None)], SCHEMA), "k", ["seq"])
    assert I.changed_dates(spark, path) == [None, DAY, days(3)[2]]
    (tmp_path / "t" / "_changed.json").rename(tmp_path / "t" / "_changed.json.new")  # died between deletion and move
    assert I.changed_dates(spark, path) == [None, DAY, days(3)[2]]


@pytest.mark.parametrize("dies_at", ["before", "between", "after"])
def test_a_replaced_table_survives_a_run_that_dies(spark, tmp_path, monkeypatch, dies_at):
    path = f"{tmp_path}/t"
    write_table(spark.createDataFrame([("a", 1)], "k string, n int"), path)
    I.note_changes(spark, path, [DAY])
    move, finish = I._move, I.finish_pending

    def lost(*args):
        raise RuntimeError("lost driver")

    if dies_at == "before":  # the note is written, nothing moved
        monkeypatch.setattr(I, "finish_pending", lost)
    elif dies_at == "between":  # the old table is gone, the new one not in place
        monkeypatch.setattr(I, "_move", lost)
    new = I.stored_table(spark, path).unionByName(spark.createDataFrame([("b", 2)], "k string, n int"))
    if dies_at == "after":
        I.replace_table(spark, new, path)
    else:
        with pytest.raises(RuntimeError):
            I.replace_table(spark, new, path)
    monkeypatch.setattr(I, "_move", move)
    monkeypatch.setattr(I, "finish_pending", finish)
    I.finish_pending(spark, path)
    assert sorted(tuple(r) for r in I.stored_table(spark, path).collect()) == [("a", 1), ("b", 2)]
    assert I.changed_dates(spark, path) == [DAY]
    assert not [p for p in tmp_path.iterdir() if "pending" in p.name or "merged" in p.name]


def sources(inputs, early, rows=None):
    cut = F.lit(datetime(2024, 1, 18, 7)).cast("timestamp_ntz")
    keep = (lambda df, c, v: df.where(F.col(c) <= v)) if early else (lambda df, c, v: df)
    queries = inputs.queries() if rows is None else rows
    odd = F.col("query_id").cast("bigint") % 3 == 0
    return marts.Sources(
        keep(inputs.metering(), "end_time", cut), keep(queries, "end_time", cut),
        keep(inputs.storage(), "usage_date", F.lit(date(2024, 1, 18))), inputs.department_map(), inputs.budget(),
        inputs.attribution().where(~odd) if early else inputs.attribution(), inputs.clustering(),
        None if early else inputs.attribution().where(odd).select("query_id"),
    )


def test_two_deliveries_with_late_estimates_equal_one_build(spark, cfg, tables, tmp_path):
    inputs, root = Inputs(spark, DATA), str(tmp_path / "warehouse")
    marts.build_incremental(spark, root, sources(inputs, True), cfg)
    built = marts.build_incremental(spark, root, sources(inputs, False), cfg)
    for name, table in tables.items():
        same(built[name].drop("_loaded_at"), table.drop("_loaded_at"), name)
    for name in ("stg_query_history", "int_hourly_compute_costs", "int_top_spenders", "fct_top_spenders"):
        assert I.changed_dates(spark, f"{root}/{name}") == []
    again = marts.build_incremental(spark, root, sources(inputs, False), cfg)  # nothing new
    for name in ("fct_daily_costs", "fct_top_spenders", "dim_warehouse"):
        same(again[name].drop("_loaded_at"), tables[name].drop("_loaded_at"), name)


def test_a_run_that_dies_before_the_marts_is_made_up_for(spark, cfg, tables, tmp_path, monkeypatch):
    inputs, root = Inputs(spark, DATA), str(tmp_path / "warehouse")
    marts.build_incremental(spark, root, sources(inputs, True), cfg)
    refresh = con.refresh_windows
    monkeypatch.setattr(con, "refresh_windows", lambda *a: (_ for _ in ()).throw(RuntimeError("lost driver")))
    with pytest.raises(RuntimeError):
        marts.build_incremental(spark, root, sources(inputs, False), cfg)
    monkeypatch.setattr(con, "refresh_windows", refresh)
    built = marts.build_incremental(spark, root, sources(inputs, False), cfg)
    for name in ("fct_daily_costs", "fct_daily_storage_costs", "int_top_spenders", "fct_top_spenders", "dim_warehouse"):
        same(built[name].drop("_loaded_at"), tables[name].drop("_loaded_at"), name)


def test_changed_dates_only_are_read_from_the_log(spark, tmp_path):
    path, out = f"{tmp_path}/log", f"{tmp_path}/out"
    log = spark.createDataFrame([(str(i), i, d) for i, d in enumerate(days(20) * 3)], SCHEMA)
    upstream = write_table(log, path, "usage_date")
    plans = []

    def make(rows):
        plans.append(executed(rows))
        return rows.groupBy("usage_date").agg(F.sum("seq").alias("n"))

    con.refresh_dates(spark, out, make, upstream, path, None)
    got = con.refresh_dates(spark, out, make, upstream, path, [days(20)[4], days(20)[9]])
    assert "PartitionFilters: [usage_date" in plans[1] and "2024-01-05" in plans[1]
    same(got, log.groupBy("usage_date").agg(F.sum("seq").alias("n")))


def slow_windows(rows, back):
    """Per key in date order: (month so far, sum of the last rows) from plain lists."""
    out = {}
    for k in {r[0] for r in rows}:
        own = sorted((r for r in rows if r[0] == k), key=lambda r: r[1])
        for i, (_, d, v) in enumerate(own):
            month = [x for _, e, x in own[: i + 1] if (e.year, e.month) == (d.year, d.month)]
            out[k, d] = (sum(month), sum(x for *_, x in own[max(0, i - back) : i + 1]))
    return out


def test_windows_from_snapshots_equal_windows_over_all_rows(spark, tmp_path):
    """Deliveries that append, change and delete rows, across a month's border and with gaps."""
    from pyspark.sql import Window as W

    path, src = f"{tmp_path}/t", f"{tmp_path}/src"
    back = 3

    def trends(rows):
        by = W.partitionBy("k").orderBy("usage_date")
        month = W.partitionBy("k", F.trunc("usage_date", "month")).orderBy("usage_date")
        out = rows.withColumn("last", F.sum("v").over(by.rowsBetween(-back, 0))).withColumn("month", F.sum("_month_value").over(month))
        return out.where("NOT _carried").select("k", "usage_date", "v", "last", "month")

    table = con.Windowed("k", "v", back, lambda rows: rows, trends)
    state = {(k, d): i for i, (k, d) in enumerate((k, d) for d in days(28) for k in ("a", "b", None) if (d.day + len(k or "xy")) % 3)}
    changes = [list(state), [("a", d) for d in days(40)[28:]], [("b", days(40)[38]), ("a", days(40)[39])], [(None, days(40)[20])], [("c", days(50)[49])], []]
    starts = []
    for n, changed in enumerate(changes):
        for key in changed if n else ():
            state[key] = 1000 * n + key[1].day
        if n == 3:
            del state["a", days(40)[23]]
            changed = [*changed, ("a", days(40)[23])]
        rows = [(k, d, Decimal(v)) for (k, d), v in state.items()]
        upstream = write_table(spark.createDataFrame(rows, "k string, usage_date date, v decimal(18,0)"), src, "usage_date")
        dates = None if n == 0 else sorted({d for _, d in changed})
        starts.append(max((s for s in con.snapshots(spark, path) if dates and s <= dates[0]), default=None))
        got = con.refresh_windows(spark, path, table, upstream, src, dates)
        want = slow_windows(rows, back)
        assert {(r.k, r.usage_date): (int(r.month), int(r.last)) for r in got.collect()} == want, n
        assert got.count() == len(rows)
    assert starts[1] is not None and starts[2] is not None and starts[4] is not None


def test_dimension_from_state_reads_no_log(spark, tables, tmp_path):
    log, meters = tables["stg_query_history"], tables["stg_warehouse_metering"]
    sizes = write_table(WH.size_uses(log, "usage_date"), f"{tmp_path}/sizes", "usage_date")
    hours = write_table(WH.meter_hours(meters), f"{tmp_path}/hours", "usage_date")
    got = WH.dim_from_state(hours, sizes)
    assert "stg_query_history" not in " ".join(got.inputFiles()) and "stg_warehouse" not in " ".join(got.inputFiles())
    same(got, WH.dim_warehouse(meters, log))
