"""Where a table's keys are: a narrow index from key to date, in buckets by hash.

A merge must know the dates that hold keys of its batch. The index answers from the batch's buckets alone,
by key and date, so the log itself is not read. Every (key, date) of the table is in the index; a pair whose
row has since moved may be, too, and costs the rewriting of a date that would not have needed it. So pairs are
appended before the table changes, and a run that dies in between leaves a larger index, not a wrong one.
Buckets that have gathered many files are folded. How many buckets there are is fixed when an index is built, by
the keys it then has; one that has outgrown them is dropped, and the next merge builds it anew.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructType

from costmart.sources import files

LEAST_BUCKETS, MOST_BUCKETS = 16, 4096
KEYS_A_BUCKET = 2_000_000
# Files of a bucket, one per merge, before it is folded into one.
FOLD_FILES = 24


def index_path(path: str) -> str:
    return f"{path.rstrip('/')}/_keys"


def _buckets_note(path: str) -> str:
    return f"{index_path(path)}/_buckets.json"  # written last, so an index without it is not complete


def bucket_count(spark: SparkSession, path: str) -> int | None:
    return files.read_note(spark, _buckets_note(path))


def bucket_of(key: str, buckets: int) -> Column:
    return F.pmod(F.xxhash64(F.col(key)), F.lit(buckets)).cast("int")


def _pairs(rows: DataFrame, key: str, date: str, buckets: int) -> DataFrame:
    """Different (key, date) with their bucket, one task per bucket."""
    pairs = rows.where(F.col(key).isNotNull()).select(key, date).distinct()
    return pairs.withColumn("_bucket", bucket_of(key, buckets)).repartition("_bucket")


def append_keys(spark: SparkSession, path: str, rows: DataFrame, key: str, date: str) -> None:
    """Note where the keys of `rows` are going to be; to be called before the table holds them there."""
    pairs = _pairs(rows, key, date, bucket_count(spark, path))
    pairs.write.mode("append").partitionBy("_bucket").parquet(index_path(path))


def ensure_index(spark: SparkSession, path: str, table: DataFrame, key: str, date: str, rows: DataFrame | None = None) -> bool:
    """Build the index of a table that has none, by one scan of two columns; whether it did.

    `rows` that are about to be merged are noted by the same write, so they need not be appended.
    """
    if bucket_count(spark, path) is not None:
        return False
    buckets = min(MOST_BUCKETS, max(LEAST_BUCKETS, table.count() // KEYS_A_BUCKET))
    held = table.select(key, date)
    if rows is not None:
        held = held.unionByName(rows.select(key, date))
    _pairs(held, key, date, buckets).write.mode("overwrite").partitionBy("_bucket").parquet(index_path(path))
    files.write_note(spark, _buckets_note(path), buckets)
    return True


def drop_index(spark: SparkSession, path: str) -> None:
    files.delete(spark, index_path(path))


def read_index(spark: SparkSession, path: str, table: DataFrame, key: str, date: str, buckets: list[int]) -> DataFrame:
    """(key, date) of the given buckets; their folders are the only ones read."""
    schema = StructType([table.schema[key], table.schema[date]]).add("_bucket", IntegerType())
    return spark.read.schema(schema).parquet(index_path(path)).where(F.col("_bucket").isin(buckets))


def dates_of_keys(spark: SparkSession, path: str, table: DataFrame, keys: DataFrame, key: str, date: str) -> DataFrame:
    """Dates under which the table holds, or has held, any of `keys`."""
    wanted = keys.select(key).where(F.col(key).isNotNull()).withColumn("_bucket", bucket_of(key, bucket_count(spark, path)))
    buckets = sorted(r[0] for r in wanted.select("_bucket").distinct().collect())  # MOST_BUCKETS at most
    return read_index(spark, path, table, key, date, buckets).join(wanted, ["_bucket", key], "left_semi").select(date)


def crowded(spark: SparkSession, path: str, most: int = FOLD_FILES) -> list[int]:
    """Buckets with more files than `most`."""
    folders = [n for n in files.names(spark, index_path(path)) if n.startswith("_bucket=")]
    counts = {n: sum(f.endswith(".parquet") for f in files.names(spark, f"{index_path(path)}/{n}")) for n in folders}
    return sorted(int(n.split("=")[1]) for n, c in counts.items() if c > most)
