"""Files of a table's folder through the file system that Spark uses: existence, moves, small notes.

Names that start with an underscore are no data to Spark's readers, so a table's notes lie in its folder
and vanish with it when the table is overwritten.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


def _at(spark: SparkSession, path: str):
    found = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return found, found.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    found, system = _at(spark, path)
    return system.exists(found)


def delete(spark: SparkSession, path: str) -> None:
    found, system = _at(spark, path)
    system.delete(found, True)


def move(spark: SparkSession, source: str, target: str) -> None:
    found, system = _at(spark, source)
    if not system.rename(found, _at(spark, target)[0]):
        raise OSError(f"{source} could not be moved to {target}")


def names(spark: SparkSession, folder: str) -> list[str]:
    """Names in a folder; none where it does not exist."""
    found, system = _at(spark, folder)
    return [f.getPath().getName() for f in system.listStatus(found)] if system.exists(found) else []


def write_note(spark: SparkSession, path: str, value) -> None:
    """Put a small JSON value in the place of an earlier one. It is complete beside it before that goes."""
    beside = f"{path}.new"
    found, system = _at(spark, beside)
    stream = system.create(found, True)
    stream.write(bytearray(json.dumps(value).encode()))
    stream.close()
    delete(spark, path)
    move(spark, beside, path)


def read_note(spark: SparkSession, path: str, missing=None):
    """A note's value; that beside it where a run died between the deletion and the move."""
    for place in (path, f"{path}.new"):
        found, system = _at(spark, place)
        if system.exists(found):
            stream = system.open(found)
            text = spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
            stream.close()
            try:
                return json.loads(text)
            except ValueError:  # cut off while it was written; nothing had been noted before
                return missing
    return missing


# ---- the schema of a stored table ---------------------------------------------------------------

def _schema_note(path: str) -> str:
    return f"{path.rstrip('/')}/_schema.json"


def save_schema(spark: SparkSession, path: str, schema: StructType) -> None:
    write_note(spark, _schema_note(path), json.loads(schema.json()))


def stored_table(spark: SparkSession, path: str) -> DataFrame:
    """A stored table under its own schema: the union of its files' columns, whatever a batch holds.

    The schema is noted in the table's folder. Only a table without a note has its files' footers read,
    once, to write one.
    """
    noted = read_note(spark, _schema_note(path))
    if noted is None:
        schema = spark.read.option("mergeSchema", "true").parquet(path).schema
        save_schema(spark, path, schema)
    else:
        schema = StructType.fromJson(noted)
    return spark.read.schema(schema).parquet(path).select(*[f"`{f.name}`" for f in schema.fields])
