"""Continuous form of the keyed incremental load and of the hourly activity rollup."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import IntegerType, StructType

from costmart.config import Config
from costmart.functions import exprs as X
from costmart.operators.hourly import HOUR_KEY, query_activity, seconds
from costmart.operators.incremental import upsert_table
from costmart.operators.staging import BYTES_PER_GB, stage_metering, stage_queries
from costmart.plans.marts import CLUSTERED
from costmart.sources import files, schemas


def read_landing(spark: SparkSession, folder: str, schema: StructType, files_per_batch: int | None = None) -> DataFrame:
    """Files as they land; `files_per_batch` bounds one micro-batch."""
    reader = spark.readStream.schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(folder)


def upsert_stream(
    stream: DataFrame,
    path: str,
    stage: Callable[[DataFrame], DataFrame],
    key: str,
    newest_first: list[str],
    checkpoint: str,
    key_implies_partition: bool = False,
    policy: str = "sync",
    sort_by: str | None = None,
) -> StreamingQuery:
    """Stage each micro-batch and merge it by key, then stop when the landed files are used up.

    Merging a batch again changes nothing, so a batch replayed after a failure does no harm. Late rows
    need no event-time watermark: they replace or join the rows of their own date.
    """

    def merge(batch: DataFrame, _epoch: int) -> None:
        upsert_table(
            batch.sparkSession, path, stage(batch), key, newest_first,
            key_implies_partition=key_implies_partition, policy=policy, sort_by=sort_by,
        )

    return (
        stream.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )


def ingest_queries(spark: SparkSession, landing: str, path: str, checkpoint: str, cfg: Config, files_per_batch: int | None = None) -> StreamingQuery:
    return upsert_stream(
        read_landing(spark, landing, schemas.QUERIES, files_per_batch),
        path,
        lambda batch: stage_queries(batch, cfg),
        "query_id",
        ["_loaded_at", "end_time"],
        checkpoint,
        policy=cfg.schema_policy,
        sort_by=CLUSTERED["stg_query_history"],
    )


def ingest_metering(spark: SparkSession, landing: str, path: str, checkpoint: str, cfg: Config, files_per_batch: int | None = None) -> StreamingQuery:
    return upsert_stream(
        read_landing(spark, landing, schemas.METERING, files_per_batch),
        path,
        lambda batch: stage_metering(batch, cfg),
        "metering_id",
        ["_loaded_at", "hour_start"],
        checkpoint,
        key_implies_partition=True,
        policy=cfg.schema_policy,
    )


def hourly_activity_stream(staged: DataFrame, lookback: str = "1 hour") -> DataFrame:
    """Activity per warehouse and hour over a stream; an hour is emitted once the lookback has passed.

    Distinct users are approximate, since streams have no exact distinct count. Event time has to be
    zoned, so it is read in the session zone (UTC) and the hour is turned back.
    """
    return (
        staged.withColumn("event_time", F.col("end_time").cast("timestamp"))
        .withWatermark("event_time", lookback)
        .groupBy("warehouse_name", F.window("event_time", "1 hour").alias("hour"))
        .agg(
            F.count(F.lit(1)).alias("query_count"),
            F.sum("total_elapsed_ms").alias("total_elapsed_ms"),
            F.sum("bytes_scanned").alias("bytes_scanned"),
            F.approx_count_distinct("user_name").alias("approx_users"),
        )
        .select("warehouse_name", F.col("hour.start").cast("timestamp_ntz").alias("usage_hour_ntz"), "query_count", "total_elapsed_ms", "bytes_scanned", "approx_users")
    )


# ---- exact activity on a stream -----------------------------------------------------------------

_ACTIVITY = ["warehouse_name", "end_time", "user_name", "total_elapsed_ms", "bytes_scanned"]


def exact_activity_stream(staged: DataFrame, lookback: str = "1 hour") -> DataFrame:
    """Activity per warehouse and hour with exact distinct users; an hour is emitted once the lookback has passed.

    Two chained aggregations: the first keeps one row of state per warehouse, hour and user, so a busy hour is
    spread over its users, and drops it with the hour; the second counts these rows.
    """
    users = (
        staged.select(*_ACTIVITY)
        .withColumn("event_time", F.col("end_time").cast("timestamp"))
        .withWatermark("event_time", lookback)
        .groupBy("warehouse_name", "user_name", F.window("event_time", "1 hour").alias("hour"))
        .agg(F.count(F.lit(1)).alias("n"), F.sum("total_elapsed_ms").alias("ms"), F.sum("bytes_scanned").alias("bytes"))
    )
    hours = users.groupBy("warehouse_name", F.window(F.window_time("hour"), "1 hour").alias("hour")).agg(
        F.sum("n").alias("query_count"), F.sum("ms").alias("_ms"), F.sum("bytes").alias("_bytes"), F.count("user_name").alias("unique_users")
    )
    return hours.select(
        "warehouse_name",
        F.col("hour.start").cast("timestamp_ntz").alias("usage_hour_ntz"),
        "query_count",
        seconds(F.col("_ms")).alias("total_runtime_seconds"),
        (F.col("_bytes") / F.lit(float(BYTES_PER_GB))).alias("total_gb_scanned"),
        "unique_users",
    )


def keep_late_rows(stream: DataFrame, path: str, checkpoint: str, lookback: timedelta = timedelta(hours=1)) -> StreamingQuery:
    """Write the rows that `exact_activity_stream` drops over the same batches to a side table.

    A row is late if its hour had ended a lookback before the newest row of earlier batches. That mark is noted per
    batch, so a batch that is run again finds the same rows late and overwrites its own folder.
    """
    note = f"{path.rstrip('/')}/_marks.json"

    def keep(batch: DataFrame, epoch: int) -> None:
        spark = batch.sparkSession
        marks = files.read_note(spark, note, {})
        before = marks.get(str(epoch - 1))
        rows = batch.select(*_ACTIVITY)
        newest = rows.agg(F.max("end_time")).first()[0]
        if before is not None:
            bound = datetime.fromisoformat(before) - lookback
            ends = X.bucket(F.col("end_time")) + F.expr("interval 1 hour")
            rows.where(ends <= F.lit(bound).cast("timestamp_ntz")).write.mode("overwrite").parquet(f"{path}/epoch={epoch}")
        known = [m for m in (before, newest.isoformat() if newest else None) if m]
        if known:
            files.write_note(spark, note, {str(epoch - 1): before, str(epoch): max(known)})  # the last two are enough

    return stream.writeStream.foreachBatch(keep).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def streamed_activity(spark: SparkSession, landing: str, root: str, schema: StructType, files_per_batch: int = 1) -> tuple[DataFrame, DataFrame]:
    """Run the landed files through both streams: (hours emitted so far, late rows)."""

    def stream() -> DataFrame:
        return read_landing(spark, landing, schema, files_per_batch)

    hours = exact_activity_stream(stream())
    emitted = (
        hours.writeStream.format("parquet").option("path", f"{root}/hours").option("checkpointLocation", f"{root}/hours-checkpoint")
        .outputMode("append").trigger(availableNow=True).start()
    )
    late = keep_late_rows(stream(), f"{root}/late", f"{root}/late-checkpoint")
    for query in (emitted, late):
        query.awaitTermination()
    late_schema = StructType([schema[c] for c in _ACTIVITY]).add("epoch", IntegerType())
    folder = f"{root}/late"
    found = spark.read.schema(late_schema).parquet(folder) if any(n.startswith("epoch=") for n in files.names(spark, folder)) else spark.createDataFrame([], late_schema)
    return spark.read.schema(hours.schema).parquet(f"{root}/hours"), found.drop("epoch")


def corrected_activity(hours: DataFrame, late: DataFrame, staged: DataFrame) -> DataFrame:
    """Emitted hours, with those that late rows belong to counted again from the stored log."""
    touched = late.select("warehouse_name", X.bucket(F.col("end_time")).alias("usage_hour_ntz")).distinct()
    same = [F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}")) for c in HOUR_KEY]
    kept = hours.alias("a").join(touched.alias("b"), same, "left_anti")
    again = staged.alias("a").join(touched.alias("b"), same, "left_semi")
    return kept.unionByName(query_activity(again).select(*hours.columns))
