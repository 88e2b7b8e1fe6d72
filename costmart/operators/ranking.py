"""Exact ranks and positions without a window over an unbounded group."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from costmart.session import checkpointed

LOW_BITS = 20
_NONE_LAST = -(2**63)
_NONE_FIRST = 2**63 - 1


def sortable(value: Column, scale: int = 0, nulls: str = "last") -> Column:
    """A number with `scale` decimals as a bigint that sorts alike; NULL goes to one end."""
    exact = (value * F.lit(10**scale).cast("decimal(20,0)")).cast("bigint") if scale else value.cast("bigint")
    return F.coalesce(exact, F.lit(_NONE_LAST if nulls == "last" else _NONE_FIRST))


def group_text(group: str) -> Column:
    """The group as text, so that rows without a group form one and find their rank again."""
    return F.coalesce(F.col(group).cast("string"), F.lit(""))


def descending_ranks(df: DataFrame, group: str, value: Column) -> DataFrame:
    """`rank()` within `group` by descending value: one row (_group, _value, _rank) per distinct value.

    No step sorts a whole group:

    1. count rows per distinct value, which collapses ties before the shuffle;
    2. split each value into high and low digits of a number; a window over one high digit holds at
       most 2**20 distinct values, whatever the number of rows;
    3. a window over the high digits of a group, each standing for 2**20 values: k of them in use need
       a group total above k**2 / 2 * 2**20, so a total of 10**15 allows some 45,000.
    """
    counts = (
        df.groupBy(group_text(group).alias("_group"), value.alias("_value"))
        .agg(F.count(F.lit(1)).alias("_n"))
        .withColumn("_high", F.shiftright("_value", LOW_BITS))
    )
    low = W.partitionBy("_group", "_high").orderBy(F.desc("_value")).rowsBetween(W.unboundedPreceding, -1)
    within = counts.withColumn("_ahead_low", F.coalesce(F.sum("_n").over(low), F.lit(0)))

    top = W.partitionBy("_group").orderBy(F.desc("_high")).rowsBetween(W.unboundedPreceding, -1)
    digits = (
        counts.groupBy("_group", "_high")
        .agg(F.sum("_n").alias("_n_high"))
        .withColumn("_ahead_high", F.coalesce(F.sum("_n_high").over(top), F.lit(0)))
        .drop("_n_high")
    )
    return within.join(digits, ["_group", "_high"]).select(
        "_group", "_value", (F.col("_ahead_low") + F.col("_ahead_high") + 1).alias("_rank")
    )


def add_rank(df: DataFrame, ranks: DataFrame, group: str, value: Column, alias: str) -> DataFrame:
    """Join ranks back on the value. A value shared by very many rows is a hot key on the left side
    only (the ranks are unique per value), which adaptive execution splits or broadcasts away."""
    return (
        df.withColumns({"_group": group_text(group), "_value": value})
        .join(ranks, ["_group", "_value"], "left")
        .withColumnRenamed("_rank", alias)
        .drop("_group", "_value")
    )


def dense_index(df: DataFrame, column: str, alias: str) -> DataFrame:
    """1-based position of every distinct value in sort order, as `dense_rank()` over all rows gives.

    Distinct values are range-partitioned and sorted per partition; a value's position is its place in
    its partition plus the sizes of the partitions before. The sorted values are checkpointed once, so
    both steps see the same partition borders. Partition sizes are one row per partition.
    """
    place_mask = (1 << 33) - 1
    ordered = (
        df.select(column)
        .where(F.col(column).isNotNull())
        .distinct()
        .repartitionByRange(column)
        .sortWithinPartitions(column)
        .withColumn("_slot", F.monotonically_increasing_id())
    )
    ordered = checkpointed(ordered).select(
        column,
        F.shiftright("_slot", 33).alias("_part"),
        F.col("_slot").bitwiseAND(F.lit(place_mask)).alias("_place"),
    )
    sizes = ordered.groupBy("_part").agg(F.count(F.lit(1)).alias("_size"))
    before = sizes.select(
        "_part", F.sum("_size").over(W.orderBy("_part").rowsBetween(W.unboundedPreceding, -1)).alias("_before")
    )
    return ordered.join(F.broadcast(before), "_part").select(
        column, (F.col("_place") + F.coalesce(F.col("_before"), F.lit(0)) + 1).alias(alias)
    )
