"""Schemas as plain Python, usable before a session exists."""

from pyspark.sql import DataFrame
from pyspark.sql.types import StructType


def schema_of(**columns: str) -> StructType:
    """Column names to JSON type names (`long`, `integer`, `decimal(18,3)`, `timestamp_ntz` …)."""
    schema = StructType()
    for name, dtype in columns.items():
        schema = schema.add(name, dtype)
    return schema


def cast_to(df: DataFrame, schema: StructType) -> DataFrame:
    """Exactly the schema's columns, in its order and types; a value that does not fit raises."""
    return df.selectExpr(*[f"cast(`{f.name}` as {f.dataType.simpleString()}) as `{f.name}`" for f in schema.fields])
