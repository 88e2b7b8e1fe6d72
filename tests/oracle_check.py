"""Runs registered queries on Spark and their SQL on DuckDB and compares names, types and values."""

from __future__ import annotations

import os
import sys
import time
from collections import Counter

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
    "labels conversations"
).split()
TYPES = {
    "string": "VARCHAR",
    "bigint": "BIGINT",
    "int": "INTEGER",
    "double": "DOUBLE",
    "boolean": "BOOLEAN",
    "date": "DATE",
    "timestamp_ntz": "TIMESTAMP",
}


def duck(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"create view {name} as select * from '{folder}/{name}.parquet'")
    return con


def compare(df, con, sql: str) -> list[str]:
    """Differences between a Spark frame and a SQL result; empty when they are equal."""
    problems = []
    names = sorted(df.columns)
    spark_types = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    relation = con.sql(sql)
    duck_types = {c: str(t) for c, t in zip(relation.columns, relation.types)}
    if names != sorted(duck_types):
        return [f"columns {names} against {sorted(duck_types)}"]
    for name in names:
        want = TYPES.get(spark_types[name], spark_types[name].upper())
        if want != duck_types[name] and not duck_types[name].endswith('"NULL"'):
            problems.append(f"type of {name}: {want} against {duck_types[name]}")
    ours = Counter(tuple(row[n] for n in names) for row in df.collect())
    theirs = Counter(tuple(dict(zip(relation.columns, row))[n] for n in names) for row in relation.fetchall())
    if ours != theirs:
        extra, missing = list((ours - theirs).elements()), list((theirs - ours).elements())
        problems.append(f"{sum(ours.values())} rows, {len(extra)} differ; ours {extra[:2]} theirs {missing[:2]}")
    return problems


def main(folder: str, patterns: list[str]) -> int:
    sys.path.insert(0, ".")
    from costmart import build_session
    from costmart.plans.catalog import ORACLES, QUERIES

    spark = build_session(master=os.environ.get("ORACLE_MASTER", "local[8]"), **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    con = duck(folder)
    failed = 0
    for name, run in QUERIES.items():
        if patterns and not any(name.startswith(p) for p in patterns):
            continue
        start = time.time()
        try:
            df = run(spark, folder)
            found = compare(df, con, ORACLES[name]) if name in ORACLES else [] if df.count() else ["no rows"]
        except Exception as error:  # noqa: BLE001 - report and go on with the next query
            found = [f"{type(error).__name__}: {str(error)[:600]}"]
        failed += bool(found)
        print(f"{'FAIL' if found else 'ok':4} {name} {time.time() - start:.1f}s {'; '.join(found)}", flush=True)
    print(f"{failed} failed")
    return failed


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv[1], sys.argv[2:]) else 0)
