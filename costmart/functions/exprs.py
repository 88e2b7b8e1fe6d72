"""Scalar expressions: time buckets, names, keys, and exact money arithmetic.

Money is decimal everywhere. Sums are exact, and every quotient is one integer division rounded half
up, so a result does not depend on how many partitions the input had.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY = "decimal(28,6)"

# Size labels in ascending order and their credits per hour.
SIZE_CREDITS = {
    "X-SMALL": 1,
    "SMALL": 2,
    "MEDIUM": 4,
    "LARGE": 8,
    "X-LARGE": 16,
    "2X-LARGE": 32,
    "3X-LARGE": 64,
    "4X-LARGE": 128,
}
# Other spellings of the labels above, hyphens and spaces removed.
SIZE_SPELLINGS = {
    "XSMALL": "X-SMALL",
    "SMALL": "SMALL",
    "MEDIUM": "MEDIUM",
    "LARGE": "LARGE",
    "XLARGE": "X-LARGE",
    "XXLARGE": "2X-LARGE",
    "2XLARGE": "2X-LARGE",
    "XXXLARGE": "3X-LARGE",
    "3XLARGE": "3X-LARGE",
    "4XLARGE": "4X-LARGE",
}
# Runtime class limits in milliseconds.
LONG_RUNNING_MS = 600_000
MEDIUM_RUNNING_MS = 60_000


def lookup(key: Column, table: dict, dtype: str) -> Column:
    """Constant table lookup; NULL for an unknown key."""
    pairs = [F.lit(x) for kv in table.items() for x in kv]
    return F.try_element_at(F.create_map(*pairs), key).cast(dtype)


# ---- time ---------------------------------------------------------------------------------------

def day_of(ts: Column) -> Column:
    return ts.cast("date")


def bucket(ts: Column, unit: str = "hour") -> Column:
    """Truncate a zone-less timestamp to hour, day or month and keep it zone-less.

    The built-in truncation goes through the session zone; building the bucket from calendar fields
    gives the same answer in every zone, daylight-saving gaps included.
    """
    day = ts.cast("date").cast("timestamp_ntz")
    if unit == "hour":
        return day + F.make_dt_interval(F.lit(0), F.hour(ts))
    if unit == "day":
        return day
    if unit == "month":
        return F.trunc(ts.cast("date"), "month").cast("timestamp_ntz")
    raise ValueError(f"unsupported bucket unit {unit!r}")


def month_of(day: Column) -> Column:
    return F.trunc(day, "month")


def shift(value: Column, n: int, unit: str) -> Column:
    """Move a date by days, or a zone-less timestamp by days or hours."""
    if unit == "date":
        return F.date_add(value, n)
    if unit == "day":
        return value + F.make_dt_interval(F.lit(n))
    if unit == "hour":
        return value + F.make_dt_interval(F.lit(0), F.lit(n))
    raise ValueError(f"unsupported shift unit {unit!r}")


def dow(day: Column) -> Column:
    """Day of week, Sunday = 1."""
    return F.dayofweek(day)


def spine(start: Column, first: int, last: int) -> Column:
    """Array of the dates start+first … start+last; explode it to get one row per date."""
    return F.transform(F.sequence(F.lit(first), F.lit(last)), lambda n: F.date_add(start, n))


def to_ntz(value: Column) -> Column:
    """Timestamp text or value to a zone-less timestamp; NULL when unreadable."""
    return F.coalesce(value.try_cast("timestamp_ntz"), value.try_cast("timestamp").cast("timestamp_ntz"))


def ntz_hour(value: Column) -> Column:
    return bucket(to_ntz(value), "hour")


def load_stamp(cfg) -> Column:
    return F.lit(cfg.load_time).cast("timestamp_ntz")


# ---- names and keys -----------------------------------------------------------------------------

def clean_name(value: Column) -> Column:
    return F.upper(F.trim(value))


def size_label(value: Column) -> Column:
    """Observed size text to the dimension's spelling: upper case, blanks to hyphens."""
    return F.upper(F.replace(value, F.lit(" "), F.lit("-")))


def canonical_size(value: Column) -> Column:
    """Any known spelling of a size to its label; NULL for unknown sizes."""
    squeezed = F.upper(F.replace(F.replace(value, F.lit("-"), F.lit("")), F.lit(" "), F.lit("")))
    return lookup(squeezed, SIZE_SPELLINGS, "string")


def size_credits(label: Column) -> Column:
    return lookup(label, SIZE_CREDITS, "int")


def runtime_category(elapsed_ms: Column) -> Column:
    return (
        F.when(elapsed_ms > LONG_RUNNING_MS, "long_running")
        .when(elapsed_ms > MEDIUM_RUNNING_MS, "medium_running")
        .otherwise("fast")
    )


def department_or_unassigned(department: Column) -> Column:
    return F.coalesce(F.nullif(F.trim(department), F.lit("")), F.lit("Unassigned"))


def showback_department(warehouse: Column, department: Column) -> Column:
    return F.when(F.upper(warehouse) == "CLOUD_SERVICES_ONLY", "Overhead").otherwise(
        department_or_unassigned(department)
    )


def meter_key(identifier: Column, hour: Column) -> Column:
    """`id|yyyy-MM-dd HH:mm:ss`, NULL when either part is missing."""
    text = F.concat_ws("|", identifier.cast("string"), F.date_format(hour, "yyyy-MM-dd HH:mm:ss"))
    return F.when(identifier.isNotNull() & hour.isNotNull(), text)


def surrogate_key(*columns: Column) -> Column:
    """Hash key over several columns in which NULL and the empty string stay different."""
    return F.md5(F.concat_ws("-", *[F.coalesce(c.cast("string"), F.lit("_null_")) for c in columns]))


# ---- NULL-strict comparison ---------------------------------------------------------------------

def _all_known(columns) -> Column:
    known = columns[0].isNotNull()
    for c in columns[1:]:
        known = known & c.isNotNull()
    return known


def strict_greatest(*columns: Column) -> Column:
    """Largest argument; NULL if any argument is NULL (the built-in skips NULLs)."""
    return F.when(_all_known(columns), F.greatest(*columns))


def strict_least(*columns: Column) -> Column:
    return F.when(_all_known(columns), F.least(*columns))


def clip(value: Column, low, high) -> Column:
    return strict_least(strict_greatest(value, F.lit(low)), F.lit(high))


def pick(condition: Column, a: Column, b: Column) -> Column:
    return F.when(condition, a).otherwise(b)


# ---- numbers ------------------------------------------------------------------------------------

def money(value: Column) -> Column:
    return value.cast(MONEY)


def whole(value: Column) -> Column:
    """An integer column as a decimal, so products with money keep full precision."""
    return value.cast("decimal(20,0)")


def exact_div(num: Column, den: Column, k: int, scale: int | None = None) -> Column:
    """num / den rounded half up to k decimals, exactly; NULL for a zero or missing divisor.

    Both arguments are integers or decimals with at most six decimals. `scale` widens the result type
    beyond k decimals where a contract asks for it. `div` yields a bigint, so quotients near its range go
    another way: what is left by the remainder divides without a rest. Beyond 38 digits Spark raises.
    """
    divisor = F.nullif(den, F.lit(0).cast("decimal(1,0)"))
    top = F.abs(num) * F.lit(Decimal(2 * 10**k)) + F.abs(divisor)
    bottom = F.abs(divisor) * F.lit(Decimal(2))
    # With these precisions the product below keeps its k decimals.
    usual = F.call_function("div", top, bottom).cast("decimal(19,0)")
    large = ((top - top % bottom) / bottom).cast(f"decimal({37 - k},0)")
    magnitude = F.when(top.cast("double") < bottom.cast("double") * F.lit(2.0**62), usual).otherwise(large)
    signed = F.when((num < 0) == (divisor < 0), magnitude).otherwise(-magnitude)
    return (signed * F.lit(Decimal(1).scaleb(-k))).cast(f"decimal(38,{scale or k})")


def nudge_round(value: Column, k: int) -> Column:
    """Round a double; the nudge settles decimal ties that binary fractions leave undecided."""
    return F.round(value + F.lit(1e-9), k)
