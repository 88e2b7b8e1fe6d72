"""Layout on disk, measured from footers; and streams whose late rows are accounted for."""

from datetime import date, datetime

from pyspark.sql import functions as F

from costmart.operators import hourly as H
from costmart.operators import incremental as I
from costmart.sources import writers
from costmart.streaming import ingest

DAY = date(2024, 1, 1)


def shares(spark, path, columns):
    groups = writers.row_groups(spark, path, list(columns))
    out = {}
    for column, value in columns.items():
        r = writers.read_share(groups, column, value).first()
        out[column] = r["read"] / r["row_groups"]
        assert r["row_groups"] >= 16
    return out


def test_interleaved_row_groups_prune_on_both_columns(spark, tmp_path):
    rows = spark.range(0, 120_000, 1, 8).select(
        F.concat(F.lit("WH_"), F.lpad((F.xxhash64("id") % 40 + 40).cast("string"), 3, "0")).alias("warehouse_name"),
        F.concat(F.lit("user_"), F.lpad((F.xxhash64("id", F.lit(1)) % 5000 + 5000).cast("string"), 5, "0")).alias("user_name"),
        F.col("id").alias("seq"), F.sha2(F.col("id").cast("string"), 256).alias("k"), F.lit(DAY).alias("usage_date"),
    )
    # A third of all rows in one cell.
    rows = rows.withColumns({c: F.when(F.col("seq") % 3 == 0, F.lit(v)).otherwise(F.col(c)) for c, v in (("warehouse_name", "WH_010"), ("user_name", "user_03000"))})
    wanted = {"warehouse_name": "WH_060", "user_name": "user_07777"}
    one, both = f"{tmp_path}/one", f"{tmp_path}/both"
    by_one = writers.laid_out(rows, "usage_date", "warehouse_name").write.option("parquet.block.size", 1 << 17)
    by_one.partitionBy("usage_date").parquet(one)
    stored = writers.write_interleaved(rows, both, row_group_bytes=1 << 17)
    assert stored.count() == 120_000 and stored.exceptAll(rows.select(*stored.columns)).count() == 0
    sorted_by_one, sorted_by_both = shares(spark, one, wanted), shares(spark, both, wanted)
    assert sorted_by_one["user_name"] > 0.6 > 0.35 > sorted_by_both["user_name"]
    assert sorted_by_both["warehouse_name"] < 0.35


def test_a_merge_keeps_row_groups_prunable(spark, tmp_path):
    path = f"{tmp_path}/t"
    spark.conf.set("parquet.block.size", str(1 << 16))
    try:
        make = lambda low, high: spark.range(low, high, 1, 6).select(
            F.sha2(F.col("id").cast("string"), 256).alias("k"), F.col("id").alias("seq"),
            F.concat(F.lit("WH_"), F.lpad((F.xxhash64("id") % 40 + 40).cast("string"), 3, "0")).alias("warehouse_name"), F.lit(DAY).alias("usage_date"),
        )
        for low, high in ((0, 40_000), (35_000, 60_000)):
            out = I.upsert_table(spark, path, make(low, high), "k", ["seq"], sort_by="warehouse_name")
        assert out.count() == 60_000
    finally:
        spark.conf.unset("parquet.block.size")
    files = {f for f in out.inputFiles()}
    groups = writers.row_groups(spark, f"{path}/usage_date={DAY}", ["warehouse_name"])
    total = writers.read_share(groups, "warehouse_name", "WH_044").first()
    assert files and total["read"] <= max(len(files), 0.35 * total["row_groups"])


def test_streamed_hours_have_exact_users_and_account_for_late_rows(spark, tables, tmp_path):
    staged = tables["stg_query_history"]
    day = F.dayofmonth("usage_hour_ntz")
    late = (F.col("query_id").cast("bigint") % 7 == 0) & day.between(3, 9)
    closing = staged.limit(1).withColumns({"end_time": F.lit(datetime(2030, 1, 1)).cast("timestamp_ntz"), "warehouse_name": F.lit("-")})
    for rows in (staged.where((day <= 10) & ~late), staged.where((day > 10) & ~late), staged.where(late), closing):
        rows.coalesce(1).write.mode("append").parquet(f"{tmp_path}/landing")
    hours, kept = ingest.streamed_activity(spark, f"{tmp_path}/landing", str(tmp_path), staged.schema)
    assert kept.count() == staged.where(late).count() > 0
    assert hours.agg(F.sum("query_count")).first()[0] + kept.count() == staged.count()
    got = ingest.corrected_activity(hours, kept, staged)
    want = H.query_activity(staged).select(*got.columns)
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0
    # Run again, nothing new landed: nothing is emitted or kept twice.
    again, kept_again = ingest.streamed_activity(spark, f"{tmp_path}/landing", str(tmp_path), staged.schema)
    assert again.count() == hours.count() and kept_again.count() == kept.count()
