"""Keyed incremental loads with a late-data lookback, on plain partitioned parquet."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass
from datetime import date, datetime, timedelta
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType, StructType

from costmart.config import Config
from costmart.functions import exprs as X
from costmart.operators import keyindex
from costmart.operators.hourly import hourly_costs
from costmart.session import scratch_path
from costmart.sources import files
from costmart.sources.files import delete as _delete
from costmart.sources.files import exists as table_stored
from costmart.sources.files import move as _move
from costmart.sources.files import save_schema, stored_table
from costmart.sources.writers import laid_out, read_table, write_table

EPOCH = datetime(1970, 1, 1)


@dataclass(frozen=True)
class Watermark:
    """How a target bounds the next scan: its column and how far behind the maximum to look."""

    column: str
    lookback: timedelta | None = timedelta(hours=1)
    strict: bool = False


# Preferred watermark first; the others serve targets written before the preferred column existed.
QUERY_WATERMARKS = (Watermark("usage_hour_ntz"), Watermark("usage_date", timedelta(days=1)))
METERING_WATERMARKS = (Watermark("usage_hour_ntz"), Watermark("hour_end"))
HOURLY_WATERMARKS = (Watermark("usage_hour_ntz"), Watermark("hour_start"))
STORAGE_WATERMARK = Watermark("usage_date", lookback=None, strict=True)


def choose_watermark(target: DataFrame, candidates: tuple[Watermark, ...]) -> Watermark | None:
    present = {c.lower() for c in target.columns}
    return next((w for w in candidates if w.column in present), None)


def high_water_mark(target: DataFrame, column: str, partition_by: str | None = None):
    """Largest value of `column`, brought to the driver as one literal so that filters can use it.

    With `partition_by` (a date directory that grows with `column`) only the newest one is scanned.
    """
    if partition_by and partition_by != column:
        newest = target.agg(F.max(partition_by)).first()[0]
        if newest is None:
            return None
        target = target.where(F.col(partition_by) == F.lit(newest))
    return target.agg(F.max(column)).first()[0]


def since_watermark(
    src: DataFrame,
    target: DataFrame,
    candidates: tuple[Watermark, ...] = QUERY_WATERMARKS,
    src_column: str = "end_time",
    partition_by: str | None = None,
) -> DataFrame:
    """Source rows from the lookback hour on. An empty target, or one with no usable column, selects
    everything.

    The mark is a whole hour or day, so comparing the raw column with it keeps the same rows as
    comparing the truncated one, and the comparison is pushed to the scan.
    """
    mark = choose_watermark(target, candidates)
    top = high_water_mark(target, mark.column, partition_by) if mark else None
    if top is None:
        return src.where(F.col(src_column) >= _literal(EPOCH, src, src_column))
    bound = top - mark.lookback if mark.lookback else top
    literal = _literal(bound, src, src_column)
    return src.where(F.col(src_column) > literal if mark.strict else F.col(src_column) >= literal)


def _literal(value, src: DataFrame, column: str):
    if isinstance(value, date) and not isinstance(value, datetime):
        value = datetime.combine(value, datetime.min.time())
    return F.lit(value).cast("timestamp_ntz").cast(src.schema[column].dataType)


# ---- schema -------------------------------------------------------------------------------------

def sync_schema(target: DataFrame, batch: DataFrame, policy: str = "sync") -> tuple[DataFrame, DataFrame]:
    """Give both sides the union of their columns, or raise when the batch changes the schema."""
    have, brings = set(target.columns), set(batch.columns)
    if policy == "fail" and have != brings:
        raise ValueError(f"schema change: added {sorted(brings - have)}, removed {sorted(have - brings)}")
    fields = {f.name: f.dataType for f in target.schema.fields}
    fields.update({f.name: f.dataType for f in batch.schema.fields})

    def widen(df: DataFrame) -> DataFrame:
        present = set(df.columns)
        return df.select(
            *[(F.col(c) if c in present else F.lit(None)).cast(t).alias(c) for c, t in fields.items()]
        )

    return widen(target), widen(batch)


# ---- merge --------------------------------------------------------------------------------------

def latest_per_key(batch: DataFrame, key: str, newest_first: list[str]) -> DataFrame:
    """One row per key; rows without a key stay as they are. The rank limit is applied before the
    shuffle too, so each task sends at most one of the copies it holds, however many there are."""
    loose = F.when(F.col(key).isNull(), F.monotonically_increasing_id())
    newest = W.partitionBy(key, "_loose").orderBy(*[F.desc(c) for c in newest_first])
    ranked = batch.withColumn("_loose", loose).withColumn("_n", F.row_number().over(newest))
    return ranked.where(F.col("_n") == 1).drop("_n", "_loose")


def _content(key: str, columns: list[str]) -> Column:
    """What tells rows without a key apart: all they hold but the load stamp. NULL where there is a key."""
    told = sorted(c for c in columns if c not in (key, "_loaded_at"))
    return F.when(F.col(key).isNull(), F.sha2(F.to_json(F.struct(*told)), 256))


def not_replaced(target: DataFrame, fresh: DataFrame, key: str) -> DataFrame:
    """Target rows that the batch does not bring again: by key, or by content where there is no key.

    A batch repeats the lookback hours, so rows without a key come again as well; matched by content,
    they are kept as often as the batch has them, which is what one full build holds.
    """
    shared = [c for c in target.columns if c in set(fresh.columns)]
    gone = fresh.select(F.col(key).alias("_key"), _content(key, shared).alias("_gone")).distinct()
    kept = target.withColumn("_content", _content(key, shared))
    same = kept[key].eqNullSafe(gone["_key"]) & kept["_content"].eqNullSafe(gone["_gone"])
    return kept.join(gone, same, "left_anti").drop("_content")


def upsert(target: DataFrame, batch: DataFrame, key: str, newest_first: list[str]) -> DataFrame:
    """Target rows that the batch does not replace, plus the newest batch row per key."""
    fresh = latest_per_key(batch, key, newest_first)
    kept, fresh = sync_schema(not_replaced(target, fresh, key), fresh)
    return kept.unionByName(fresh)


def on_dates(partition_by: str, dates: list) -> Column:
    """Rows of the given dates, None among them meaning rows without a date."""
    known = [d for d in dates if d is not None]
    wanted = F.col(partition_by).isin(known) if known else F.lit(False)
    return wanted | F.col(partition_by).isNull() if None in dates else wanted


def upsert_table(
    spark: SparkSession,
    path: str,
    batch: DataFrame,
    key: str,
    newest_first: list[str],
    partition_by: str = "usage_date",
    key_implies_partition: bool = False,
    policy: str = "sync",
    sort_by: str | None = None,
) -> DataFrame:
    """Merge a batch into a table stored by date, rewriting only the dates it touches.

    The touched dates are those of the batch and, unless the key fixes the date, those where the target
    already holds one of its keys (found in the table's key index). Rows without a date are a date
    of their own. Merged rows are written once, beside the table and in its layout, and moved into place.
    The target is read under its noted schema, so a changed batch is seen: `fail` raises, `sync` keeps
    the columns of both. The touched dates are noted for the tables behind this one (`changed_dates`).
    One writer per table.
    """
    finish_pending(spark, path)
    if not table_stored(spark, path):
        out = write_table(latest_per_key(batch, key, newest_first), path, partition_by, sort_by)
        note_changes(spark, path, None)
        return out
    target = stored_table(spark, path)
    sync_schema(target, batch, policy)
    # Staged once: the batch is read for the dates, the keys and the rows.
    batch_path = scratch_path(spark, "batch")
    latest_per_key(batch, key, newest_first).write.parquet(batch_path)
    fresh = read_table(spark, batch_path, batch.schema)
    touched = fresh.select(partition_by)
    if not key_implies_partition:
        finish_pending(spark, keyindex.index_path(path))
        noted = keyindex.ensure_index(spark, path, target, key, partition_by, fresh)
        if noted:  # the index now holds the batch, too; what it was built from has fewer rows
            hit = target.select(key, partition_by).join(fresh.select(key), key, "left_semi").select(partition_by)
        else:
            hit = keyindex.dates_of_keys(spark, path, target, fresh, key, partition_by)
        touched = touched.unionByName(hit)
    # At most one value per calendar date.
    dates = [r[0] for r in touched.distinct().collect()]
    if not dates:
        return target
    kept, fresh = sync_schema(not_replaced(target.where(on_dates(partition_by, dates)), fresh, key), fresh)
    if not key_implies_partition and not noted:
        keyindex.append_keys(spark, path, fresh, key, partition_by)
    note_changes(spark, path, dates)
    replace_dates(spark, path, kept.unionByName(fresh), dates, partition_by, sort_by)
    if not key_implies_partition and (buckets := keyindex.crowded(spark, path)):
        index = keyindex.read_index(spark, path, target, key, partition_by, buckets).distinct().repartition("_bucket")
        replace_dates(spark, keyindex.index_path(path), index, buckets, "_bucket", None)
    return stored_table(spark, path)


# ---- change feed --------------------------------------------------------------------------------

_ALL = "all"


def _changes_note(path: str) -> str:
    return f"{path.rstrip('/')}/_changed.json"


def note_changes(spark: SparkSession, path: str, dates: list | None) -> None:
    """Add dates to those a table has changed since its readers last took them; None stands for all.

    Noted before the table changes, so dates are told even if the run dies before its readers ran.
    """
    noted = files.read_note(spark, _changes_note(path), [])
    if dates is not None and noted != _ALL:
        files.write_note(spark, _changes_note(path), sorted({*noted, *("" if d is None else str(d) for d in dates)}))
    elif noted != _ALL:
        files.write_note(spark, _changes_note(path), _ALL)


def changed_dates(spark: SparkSession, path: str) -> list | None:
    """Dates noted as changed, None among them for rows without a date; None for all dates."""
    noted = files.read_note(spark, _changes_note(path), [])
    if noted == _ALL:
        return None
    return [date.fromisoformat(d) if d else None for d in noted]


def take_changes(spark: SparkSession, path: str) -> None:
    """Forget the noted dates; to be called when all tables behind this one are up to date."""
    _delete(spark, _changes_note(path))


PENDING = StructType().add("merged_path", "string").add("dates", ArrayType(StringType()))
_NO_DATE = "__HIVE_DEFAULT_PARTITION__"  # the directory of rows without a partition value


def replace_dates(spark: SparkSession, path: str, merged: DataFrame, dates: list, partition_by: str, sort_by: str | None) -> None:
    """Put `merged` in the place of the given dates of a table.

    It is written beside the table and noted before anything of the table changes, so a run that dies in
    the middle of the replacement is finished by the next one.
    """
    merged_path = f"{path.rstrip('/')}.merged-{uuid.uuid4().hex}"
    laid_out(merged, partition_by, sort_by).write.partitionBy(partition_by).parquet(merged_path)
    save_schema(spark, path, merged.schema)  # columns that are new read as NULL until the rows are there
    folders = [f"{partition_by}={_NO_DATE if d is None else d}" for d in dates]
    note = spark.createDataFrame([(merged_path, folders)], PENDING)
    note.coalesce(1).write.mode("overwrite").json(_note_path(path))
    finish_pending(spark, path)


def _note_path(path: str) -> str:
    return f"{path.rstrip('/')}.pending"


def finish_pending(spark: SparkSession, path: str) -> None:
    """Move the noted folders of merged rows into a table; does nothing without a note.

    A noted folder without merged rows has lost all its rows to other dates. Folders that an earlier try
    has moved are told from those by a list that is made before the first move.
    """
    note_path = _note_path(path)
    if not table_stored(spark, f"{note_path}/_SUCCESS"):
        return
    note = spark.read.schema(PENDING).json(note_path).first()
    if note.dates == [_WHOLE]:
        if table_stored(spark, note.merged_path):
            _delete(spark, path)
            _move(spark, note.merged_path, path)
        _delete(spark, note_path)
        return
    listed = f"{note_path}/filled"
    if not table_stored(spark, f"{listed}/_SUCCESS"):
        filled = [f for f in note.dates if table_stored(spark, f"{note.merged_path}/{f}")]
        spark.createDataFrame([(f,) for f in filled], "folder string").coalesce(1).write.mode("overwrite").text(listed)
    filled = {r[0] for r in spark.read.text(listed).collect()}
    for folder in note.dates:
        if folder not in filled:
            _delete(spark, f"{path}/{folder}")
        elif table_stored(spark, f"{note.merged_path}/{folder}"):
            _delete(spark, f"{path}/{folder}")
            _move(spark, f"{note.merged_path}/{folder}", f"{path}/{folder}")
    _delete(spark, note_path)
    _delete(spark, note.merged_path)


_WHOLE = "*"  # stands for all folders of a table in a note


def replace_table(spark: SparkSession, df: DataFrame, path: str) -> DataFrame:
    """Replace a small unpartitioned table that `df` itself reads.

    Written beside it and noted, then moved into its place; a run that dies in between is finished by the next.
    """
    merged_path = f"{path.rstrip('/')}.merged-{uuid.uuid4().hex}"
    write_table(df, merged_path)
    if (noted := files.read_note(spark, _changes_note(path))) is not None:
        files.write_note(spark, _changes_note(merged_path), noted)
    spark.createDataFrame([(merged_path, [_WHOLE])], PENDING).coalesce(1).write.mode("overwrite").json(_note_path(path))
    finish_pending(spark, path)
    return stored_table(spark, path)


# ---- repair of older targets --------------------------------------------------------------------

def has_missing(spark: SparkSession, path: str, columns: list[str]) -> bool:
    """Whether a stored table lacks any of the columns, or a value in one: a scan that stops at the first."""
    target = stored_table(spark, path)
    if not set(columns) <= set(target.columns):
        return True
    return target.where(reduce(or_, [F.col(c).isNull() for c in columns])).limit(1).count() > 0


def repair_table(
    spark: SparkSession,
    path: str,
    fix: Callable[[DataFrame], DataFrame],
    columns: list[str],
    partition_by: str = "usage_date",
    sort_by: str | None = None,
) -> None:
    """Add missing columns to a stored table and fill their NULLs by `fix`, where it can.

    Only dates with a row that `fix` fills are rewritten, so a repaired table is left alone.
    """
    finish_pending(spark, path)
    target = stored_table(spark, path)
    types = {"usage_hour_ntz": "timestamp_ntz"}
    for column in columns:
        if column not in target.columns:
            target = target.withColumn(column, F.lit(None).cast(types.get(column, "bigint")))
    lacking = reduce(or_, [F.col(c).isNull() for c in columns])
    was = {f"_was_{c}": F.col(c).isNull() for c in columns}
    filled = reduce(or_, [F.col(f"_was_{c}") & F.col(c).isNotNull() for c in columns])
    before = target.where(lacking).withColumns(was).withColumn("_old_date", F.col(partition_by))
    found = fix(before).where(filled).select(F.explode(F.array("_old_date", partition_by))).distinct().collect()
    if dates := [r[0] for r in found]:  # at most one per calendar date
        keyindex.drop_index(spark, path)  # filled dates are not in it; the next merge builds it anew
        note_changes(spark, path, dates)
        replace_dates(spark, path, fix(target.where(on_dates(partition_by, dates))), dates, partition_by, sort_by)


def backfill(target: DataFrame, sources: tuple[str, ...] = ("end_time", "hour_end", "hour_start")) -> DataFrame:
    """Fill missing hour and date buckets from the first time column the target has."""
    present = set(target.columns)
    origin = next((c for c in sources if c in present), None)
    hour = F.col("usage_hour_ntz") if "usage_hour_ntz" in present else F.lit(None)
    day = F.col("usage_date") if "usage_date" in present else F.lit(None)
    if origin:
        hour = F.coalesce(hour, X.bucket(F.col(origin).cast("timestamp_ntz")))
        day = F.coalesce(day, X.day_of(F.col(origin).cast("timestamp_ntz")))
    return target.withColumn("usage_hour_ntz", hour.cast("timestamp_ntz")).withColumn("usage_date", day.cast("date"))


def backfill_warehouse_id(target: DataFrame, staged_metering: DataFrame) -> DataFrame:
    """Missing warehouse ids of hourly rows from metering on (name, hour); keys follow the id."""
    hour = (
        F.coalesce("usage_hour_ntz", X.bucket(F.col("hour_start").cast("timestamp_ntz")))
        if "hour_start" in target.columns
        else F.col("usage_hour_ntz")
    )
    ids = staged_metering.groupBy(
        F.col("warehouse_name"), F.coalesce("usage_hour_ntz", X.bucket(F.col("hour_end"))).alias("_hour")
    ).agg(F.max("warehouse_id").alias("_id"))
    filled = target.withColumn("_hour", hour).join(ids, ["warehouse_name", "_hour"], "left")
    warehouse_id = F.coalesce("warehouse_id", "_id")
    repaired = filled.withColumn("usage_hour_ntz", F.col("_hour")).withColumn("warehouse_id", warehouse_id)
    key = F.when(
        F.col("usage_hour_ntz").isNotNull() & F.col("warehouse_id").isNotNull(),
        X.surrogate_key(F.col("warehouse_id"), F.col("usage_hour_ntz")),
    )
    return repaired.withColumn("cost_hour_key", F.coalesce(key, F.col("cost_hour_key"))).select(*target.columns)


# ---- incremental marts --------------------------------------------------------------------------

def hourly_costs_incremental(
    staged_metering: DataFrame,
    staged_queries: DataFrame,
    target: DataFrame,
    cfg: Config,
    partition_by: str | None = None,
    changed: list | None = (),
) -> DataFrame:
    """Hourly rows to merge: one mark bounds both inputs before they are aggregated and joined.

    Dates that the inputs have `changed` (None: all) are computed again, too, however old they are.
    """
    mark = choose_watermark(target, HOURLY_WATERMARKS)
    top = high_water_mark(target, mark.column, partition_by) if mark else None
    bound = top - mark.lookback if top else EPOCH
    # The date is implied by the hour; naming it lets tables laid out by date skip directories.
    since = (F.col("usage_date") >= F.lit(bound.date())) & (F.col("usage_hour_ntz") >= F.lit(bound).cast("timestamp_ntz"))
    if changed is None:
        since = F.lit(True)
    elif changed:
        since = since | on_dates("usage_date", list(changed))
    return hourly_costs(staged_metering.where(since), staged_queries.where(since), cfg)
