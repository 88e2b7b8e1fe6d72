"""Tables refreshed from the first changed date on, instead of from all history.

By-date tables hold figures of single dates; only the changed dates are computed again. Windowed tables also
have running and moving figures per key (warehouse, database, user), which reach back over rows, not days,
so the rows before the first changed date matter as well. Snapshots carry them: per key the last rows, as
many as the windows reach back to, and the sum of the month so far, all before a given date. A refresh starts
at the last snapshot that no change has reached, reads its input from there, and puts the carried rows in
front of it; what is written is what one full build holds.

A table's snapshots lie in its folder. Those behind the start are deleted before anything changes, and new
ones are taken at the end, so a run that dies leaves fewer snapshots and the next one starts earlier.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from costmart.operators import incremental as inc
from costmart.session import stage_table
from costmart.sources import files
from costmart.sources.writers import write_table

DAY = "usage_date"
# Snapshots kept; a change from before them all costs a full build.
KEPT = 40


# ---- tables of single dates ---------------------------------------------------------------------

def is_complete(spark: SparkSession, path: str) -> bool:
    """Whether a table is there with its noted schema, which is written last and deleted first."""
    inc.finish_pending(spark, path)
    return files.exists(spark, f"{path.rstrip('/')}/_schema.json")


def refresh_dates(
    spark: SparkSession,
    path: str,
    make: Callable[[DataFrame], DataFrame],
    upstream: DataFrame,
    upstream_path: str,
    changed: list | None,
) -> DataFrame:
    """Compute the changed dates of a by-date table again; all of them where it is missing or all have changed."""
    if not is_complete(spark, path) or changed is None:
        inc.note_changes(spark, upstream_path, None)  # should the run die here, the next starts over
        write_table(make(upstream), path, DAY)
        inc.note_changes(spark, path, None)
    elif changed:
        inc.note_changes(spark, path, changed)
        inc.replace_dates(spark, path, make(upstream.where(inc.on_dates(DAY, changed))), changed, DAY, None)
    return files.stored_table(spark, path)


# ---- windows continued over snapshots -----------------------------------------------------------

@dataclass(frozen=True)
class Windowed:
    """A table with windows per `key` over `value`, reaching back over `back` rows."""

    key: str
    value: str
    back: int
    rows: Callable[[DataFrame], DataFrame]  # input to one row per key and date
    trends: Callable[[DataFrame], DataFrame]  # these, after `with_carried`, to the table


def wide(column: Column, like: DataFrame, name: str) -> Column:
    """With room for sums: a decimal of 38 digits and the column's scale."""
    return column.cast(f"decimal(38,{like.schema[name].dataType.scale})")


def with_carried(rows: DataFrame, carry: DataFrame | None, key: str, value: str) -> DataFrame:
    """Rows with those of a snapshot in front, marked `_carried`.

    `_month_value` is what adds up to the month's running sum: the value, and on the last carried row the sum
    of the snapshot's month before its date.
    """
    own = rows.withColumns({"_month_value": wide(F.col(value), rows, value), "_carried": F.lit(False)})
    if carry is None:
        return own
    before = carry.select(key, "month_sum", "month", F.size("tail").alias("_size"), F.posexplode("tail").alias("_pos", "_row"))
    last = (F.col("_pos") == F.col("_size") - 1) & (F.trunc("_row.day", "month") == F.col("month"))
    before = before.select(
        key,
        F.col("_row.day").alias(DAY),
        F.col("_row.value").alias(value),
        F.when(last, F.col("month_sum")).alias("_month_value"),
        F.lit(True).alias("_carried"),
    )
    return own.unionByName(before, allowMissingColumns=True)


def carry_out(rows: DataFrame, key: str, value: str, back: int, as_of: date) -> DataFrame:
    """The snapshot before `as_of` of rows made by `with_carried`: (key, tail, month, month_sum)."""
    day = F.lit(as_of)
    earlier = rows.where(F.col(DAY).isNull() | (F.col(DAY) < day))
    newest = W.partitionBy(key).orderBy(F.desc_nulls_last(DAY))
    ranked = earlier.withColumn("_n", F.row_number().over(newest))
    tail = F.when(F.col("_n") <= back, F.struct((-F.col("_n")).alias("n"), F.col(DAY).alias("day"), F.col(value).alias("value")))
    in_month = F.trunc(DAY, "month") == F.trunc(day, "month")
    return ranked.groupBy(key).agg(
        F.transform(F.array_sort(F.collect_list(tail)), lambda t: F.struct(t["day"].alias("day"), t["value"].alias("value"))).alias("tail"),
        F.trunc(day, "month").alias("month"),
        F.sum(F.when(in_month, F.col("_month_value"))).cast(rows.schema["_month_value"].dataType).alias("month_sum"),
    )


def _carry_path(path: str, as_of: date | None = None) -> str:
    return f"{path.rstrip('/')}/_carry" + (f"/as_of={as_of}" if as_of else "")


def snapshots(spark: SparkSession, path: str) -> list[date]:
    folder = _carry_path(path)
    found = [n for n in files.names(spark, folder) if n.startswith("as_of=") and files.exists(spark, f"{folder}/{n}/_SUCCESS")]
    return sorted(date.fromisoformat(n.removeprefix("as_of=")) for n in found)


def take_snapshots(spark: SparkSession, path: str, rows: DataFrame, table: Windowed, start: date | None) -> None:
    """Snapshots before the newest date and the one before it, so that the usual late rows find one."""
    newest = rows.where(~F.col("_carried")).agg(F.max(DAY)).first()[0]
    for as_of in (newest - timedelta(days=1), newest) if newest else ():
        if start is None or as_of > start:  # that before `start` is there already
            carry_out(rows, table.key, table.value, table.back, as_of).write.mode("overwrite").parquet(_carry_path(path, as_of))
    for old in snapshots(spark, path)[:-KEPT]:
        files.delete(spark, _carry_path(path, old))


def _stored_dates(spark: SparkSession, path: str, start: date) -> list[date]:
    found = [n.split("=")[1] for n in files.names(spark, path) if n.startswith(f"{DAY}=")]
    return [d for d in (date.fromisoformat(n) for n in found if n[0].isdigit()) if d >= start]


def refresh_windows(
    spark: SparkSession, path: str, table: Windowed, upstream: DataFrame, upstream_path: str, changed: list | None
) -> DataFrame:
    """Compute a windowed table again from the last snapshot before the first changed date."""
    whole = not is_complete(spark, path) or changed is None or None in changed
    if not whole and not changed:
        return files.stored_table(spark, path)
    start = None if whole else max((s for s in snapshots(spark, path) if s <= min(changed)), default=None)
    since = upstream if start is None else upstream.where(F.col(DAY) >= F.lit(start))
    carry = spark.read.parquet(_carry_path(path, start)) if start else None
    rows = with_carried(stage_table(table.rows(since), "window-rows"), carry, table.key, table.value)
    if start is None:
        inc.note_changes(spark, upstream_path, None)
        write_table(table.trends(rows), path, DAY)
        inc.note_changes(spark, path, None)
    else:
        for late in snapshots(spark, path):
            if late > start:
                files.delete(spark, _carry_path(path, late))
        new = [r[0] for r in rows.where(~F.col("_carried")).select(DAY).distinct().collect()]  # one per calendar date
        dates = sorted({*new, *_stored_dates(spark, path, start)})
        inc.note_changes(spark, path, dates)
        inc.replace_dates(spark, path, table.trends(rows), dates, DAY, None)
    take_snapshots(spark, path, rows, table, start)
    return files.stored_table(spark, path)
