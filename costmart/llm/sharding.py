"""Operator 8: shards by jump consistent hashing, in DataFrame expressions only.

A key goes to a shard by its own pseudo-random jump sequence (Lamping and Veach, 2014): the last jump
below the shard count is the shard. No ring or table is kept. With one more shard the sequence is the
same, so a key either stays or moves to the new shard, and 1/(n+1) of the keys move.

Defined results: integer keys are used as they are, other keys by their XXH64 (seed 42), NULL keys as -1.
NULL and empty texts have size 1 and checksum 0. Repeated rows get the same shard and different slots.
An empty table gives no rows. Extra columns of the input are not read.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from costmart.llm.frames import numbered, table, text_or_empty
from costmart.session import stage_table

# Fixed value: the multiplier of the published generator, key * MULTIPLIER + 1 modulo 2^64.
MULTIPLIER = 2862933555777941757
_LOW, _HIGH = MULTIPLIER & 0xFFFFFFFF, MULTIPLIER >> 32


def _next_key(key: Column) -> Column:
    """key * MULTIPLIER + 1 modulo 2^64 in 16- and 32-bit parts, so that no product leaves a long."""

    def word(value: Column, shift: int = 0) -> Column:
        return F.shiftrightunsigned(value, shift).bitwiseAND(F.lit(0xFFFF))

    k0, k1, k2, k3 = (word(key, s) for s in (0, 16, 32, 48))
    middle = k1 * F.lit(_LOW)
    low = k0 * F.lit(_LOW) + F.shiftleft(word(middle), 16) + F.lit(1)
    high = (
        F.shiftrightunsigned(low, 32)
        + F.shiftrightunsigned(middle, 16)
        + key.bitwiseAND(F.lit(0xFFFFFFFF)) * F.lit(_HIGH)
        + k2 * F.lit(_LOW)
        + F.shiftleft(word(k3 * F.lit(_LOW)), 16)
    )
    return F.shiftleft(high, 32).bitwiseOR(low.bitwiseAND(F.lit(0xFFFFFFFF)))


def _jumps(state: Column, shards: int, steps: int) -> Column:
    """Follow up to `steps` jumps; `shard` is the last one below `shards`, `grown` below shards + 1."""

    def step(s: Column, _: Column) -> Column:
        key = _next_key(s["key"])
        reach = F.lit(float(1 << 31)) / (F.shiftrightunsigned(key, 33) + 1).cast("double")
        moved = F.struct(
            key.alias("key"),
            F.floor((s["jump"] + 1).cast("double") * reach).cast("long").alias("jump"),
            F.when(s["jump"] < shards, s["jump"]).otherwise(s["shard"]).alias("shard"),
            s["jump"].alias("grown"),
        )
        return F.when(s["jump"] <= shards, moved).otherwise(s)

    return F.aggregate(F.sequence(F.lit(1), F.lit(steps)), state, step)


def key_of(docs: DataFrame, name: str) -> Column:
    """A key column as a long: integers as they are, others by XXH64, NULL as -1."""
    kind = docs.schema[name].dataType.typeName()
    value = F.col(name).cast("long") if kind in ("byte", "short", "integer", "long") else F.xxhash64(name)
    return F.coalesce(F.when(F.col(name).isNotNull(), value), F.lit(-1).cast("long"))


def with_shards(rows: DataFrame, key: str, shards: int, shard: str = "shard", grown: str = "grown_shard") -> DataFrame:
    """Add the shard of a non-NULL long key among `shards`, and among one more."""
    if shards < 1:
        raise ValueError("at least one shard is needed")
    start = F.struct(
        F.col(key).alias("key"),
        F.lit(0).cast("long").alias("jump"),
        F.lit(-1).cast("long").alias("shard"),
        F.lit(-1).cast("long").alias("grown"),
    )
    # A key makes about ln(shards) jumps. The few that need more than the first round go on in a second.
    usual = min(shards + 1, 12 + 3 * math.ceil(math.log2(shards + 1)))
    rows = rows.withColumn("_jumps", _jumps(start, shards, usual))
    if usual < shards + 1:
        rest = F.when(F.col("_jumps.jump") <= shards, _jumps(F.col("_jumps"), shards, shards + 1))
        rows = rows.withColumn("_jumps", F.coalesce(rest, F.col("_jumps")))
    return rows.withColumns(
        {shard: F.col("_jumps.shard").cast("int"), grown: F.col("_jumps.grown").cast("int")}
    ).drop("_jumps")


def shard_documents(docs: DataFrame, shards: int, key: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard for every row.

    Only the narrow columns are stored and dealt; texts are read once and moved nowhere. Slots follow the
    key within a shard, then the checksum and the size.
    """
    utf8 = F.encode(text_or_empty(text), "UTF-8")
    narrow = docs.select(
        F.col(key).alias("doc_id"),
        (F.octet_length(utf8).cast("long") + 1).alias("size"),
        F.crc32(utf8).alias("text_crc32"),
        key_of(docs, key).alias("_key"),
    )
    narrow = stage_table(with_shards(narrow, "_key", shards).drop("_key"), "shards")
    rows = numbered(narrow, "shard", ["doc_id", "text_crc32", "size"], "slot")
    return rows.select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard")


SHARDS = 16


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_documents(table(spark, sf_dir, "documents"), SHARDS)


# The checksum is the reflected CRC-32 over the UTF-8 bytes, by a table of 256 remainders made from the
# polynomial 0xEDB88320. Jumps use 128-bit arithmetic modulo 2^64.
ORACLE = f"""
with recursive remainders(byte, step, value) as (
    select range, 0, range from range(256)
    union all
    select byte, step + 1, case when value & 1 = 1 then xor(value >> 1, 3988292384) else value >> 1 end
    from remainders where step < 8
), lookup as (
    select list(value order by byte) as words from remainders where step = 8
), jumps(doc_id, key, jump, place, grown) as (
    select doc_id, doc_id::hugeint & 18446744073709551615::hugeint, 0::bigint, -1::bigint, -1::bigint from documents
    union all
    select doc_id, next_key,
        floor((jump + 1)::double * (2147483648::double / ((next_key >> 33) + 1)::double))::bigint,
        case when jump < {SHARDS} then jump else place end, jump
    from (select *, (key * {MULTIPLIER}::hugeint + 1) % 18446744073709551616::hugeint as next_key from jumps
          where jump <= {SHARDS})
), placed as (
    select doc_id, place::integer as shard, grown::integer as grown_shard from jumps where jump > {SHARDS}
), sums as (
    select doc_id, (strlen(coalesce(text, '')) + 1)::bigint as size,
        xor(list_reduce(
            list_prepend(4294967295::bigint, list_transform(regexp_extract_all(hex(coalesce(text, '')), '..'),
                lambda pair: ('0x' || pair)::bigint)),
            lambda crc, byte: xor(crc >> 8, words[(xor(crc, byte) & 255) + 1])), 4294967295) as text_crc32
    from documents, lookup
)
select doc_id, size, text_crc32, 'key' as law, shard,
    row_number() over (partition by shard order by doc_id) - 1 as slot, grown_shard
from sums join placed using (doc_id)
"""
