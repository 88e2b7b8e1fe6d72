"""Operator 13: vector code compression by product codebooks, fitted by active-entry Lloyd rounds.

A vector's components become integers, and its parts get the number of the nearest entry of their
position's codebook. All distances are exact integers. A part keeps its entry and the distance to it. After an
update of the codebooks, most entries have not moved: a part whose own entry is where it was needs to be
compared with the moved entries only, as the others are as far as before, and none of them was nearer
(nor as near with a lower index). A part whose own entry moved is compared with all entries.

Every round is one pass over a stored table of vectors with their entries and distances. Each task sums up its
parts by entry (at most PARTS x ENTRIES rows), these partial sums are added by Spark, and the codebooks, whose
size depends on the vectors' length only, go to every task of the next round. Nothing is sampled.

Defined results: rows whose vector is NULL or has a NULL or non-finite component are dropped. So are vectors
of another length than that of the smallest vec_id kept, empty ones included. That length must be a multiple of
the number of parts, and components must lie within +-65536, or the query fails and says so. Fewer rows
than entries make smaller codebooks. NULL ids come last in the order, equal ids by their components;
repeated rows count each. NULL labels are one label. Extra columns are not read. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from costmart.llm.frames import table
from costmart.session import stage_table

PARTS = 4
ENTRIES = 256
ROUNDS = 4
SCALE = 1024
# Integer components beyond this might overflow a distance.
LARGEST = 1 << 26
# Vectors compared side by side.
ROWS = 1 << 12

_ints, _longs = pa.list_(pa.int32()), pa.list_(pa.int64())
_STATE = pa.schema(
    [
        ("vec_id", pa.int64()), ("label", pa.string()), ("vector", _ints), ("codes", _ints), ("distances", _longs),
        ("part", pa.int32()), ("entry", pa.int32()), ("used", pa.int64()), ("total", _longs),
    ]
)
STATE_SCHEMA = "vec_id long, label string, vector array<int>, codes array<int>, distances array<long>, part int, entry int, used long, total array<long>"


def squared(x: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Exact squared distances of the rows of x from the entries; in doubles where these are exact."""
    most = max(int(np.abs(x).max(initial=0)), int(np.abs(entries).max(initial=0)))
    if 4 * x.shape[1] * most * most < 1 << 53:
        f, e = x.astype(np.float64), entries.astype(np.float64)
        return (np.einsum("ij,ij->i", f, f)[:, None] - 2 * (f @ e.T) + np.einsum("ij,ij->i", e, e)).astype(np.int64)
    return np.stack([((x - e) ** 2).sum(axis=1) for e in entries], axis=1)


def nearest(x: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(index, squared distance) of the nearest entry, the lowest index of equals."""
    found = squared(x, entries)
    code = found.argmin(axis=1)
    return code, found[np.arange(len(x)), code]


def reassign(x: np.ndarray, entries: np.ndarray, moved: np.ndarray, code: np.ndarray, distance: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """New (index, squared distance) of parts from the last round's, and the number of comparisons made.

    `moved` holds the indexes of the entries that changed since, ascending.
    """
    code, distance = code.copy(), distance.copy()
    lost = np.isin(code, moved)
    if lost.any():
        code[lost], distance[lost] = nearest(x[lost], entries)
    kept = np.flatnonzero(~lost)
    if len(moved) and len(kept):
        which, near = nearest(x[kept], entries[moved])
        which = moved[which]
        better = (near < distance[kept]) | ((near == distance[kept]) & (which < code[kept]))
        code[kept[better]], distance[kept[better]] = which[better], near[better]
    return code, distance, int(lost.sum()) * len(entries) + len(kept) * len(moved)


def _matrix(column: pa.Array, kind: type) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(kind).reshape(len(column), -1)


def _round(state: DataFrame, books: np.ndarray, before: np.ndarray | None) -> DataFrame:
    """Assign all parts to the entries of `books`; `before` holds the books of the last round, if any."""
    parts, n_entries, size = books.shape
    shared = state.sparkSession.sparkContext.broadcast((books, before))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        books, before = shared.value
        moved = [np.flatnonzero((b != a).any(axis=1)) for a, b in zip(before, books)] if before is not None else None
        used, total = np.zeros((parts, n_entries), np.int64), np.zeros((parts, n_entries, size), np.int64)
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                rows = batch.slice(at, ROWS)
                x = _matrix(rows.column("vector"), np.int64).reshape(-1, parts, size)
                if moved is None:
                    found = [nearest(x[:, p], books[p]) for p in range(parts)]
                else:
                    codes, distances = _matrix(rows.column("codes"), np.int64), _matrix(rows.column("distances"), np.int64)
                    found = [reassign(x[:, p], books[p], moved[p], codes[:, p], distances[:, p])[:2] for p in range(parts)]
                for p, (code, _) in enumerate(found):
                    used[p] += np.bincount(code, minlength=n_entries)
                    np.add.at(total[p], code, x[:, p])
                codes, distances = (np.stack([f[k] for f in found], axis=1) for k in (0, 1))
                columns = {
                    "vec_id": rows.column("vec_id"), "label": rows.column("label"), "vector": rows.column("vector"),
                    "codes": pa.array(list(codes.astype(np.int32)), _ints), "distances": pa.array(list(distances), _longs),
                }
                yield pa.RecordBatch.from_arrays([columns.get(f.name, pa.nulls(rows.num_rows, f.type)) for f in _STATE], schema=_STATE)
        sums = [
            {"part": p, "entry": e, "used": int(used[p, e]), "total": total[p, e].tolist()}
            for p, e in zip(*(i.tolist() for i in np.nonzero(used)))
        ]
        if sums:
            yield pa.RecordBatch.from_pylist(sums, schema=_STATE)

    return stage_table(state.mapInArrow(run, STATE_SCHEMA), "codebook-round")


def _vectors(state: DataFrame) -> DataFrame:
    return state.filter("part IS NULL")


def update(state: DataFrame, books: np.ndarray) -> np.ndarray:
    """The mean of each entry's parts, rounded down; entries without parts stay."""
    sums = state.filter("part IS NOT NULL").select("part", "entry", "used", F.posexplode("total").alias("place", "value"))
    # The sum of very many large components can pass a long.
    sums = sums.groupBy("part", "entry", "place").agg(F.sum(F.col("value").cast("decimal(38,0)")).alias("value"), F.sum("used").alias("used"))
    out = books.copy()
    for r in sums.collect():  # one row per number of the codebooks
        out[r["part"], r["entry"], r["place"]] = int(r["value"]) // r["used"]
    return out


def integers(vectors: DataFrame) -> DataFrame:
    """vec_id, label, vector of integers, without the rows that have no finite vector."""
    x = F.col("embedding").cast("array<double>")
    bad = F.exists(x, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    kept = vectors.select(F.col("vec_id").cast("long"), F.col("label").cast("string"), x.alias("embedding")).filter(x.isNotNull() & ~bad & (F.size(x) > 0))
    whole = F.transform("embedding", lambda v: F.floor(v * SCALE))
    far = F.exists("vector", lambda v: F.abs(v) > LARGEST)
    kept = kept.select("vec_id", "label", whole.alias("vector"))
    checked = F.when(far, F.raise_error(F.lit("embedding: a component lies beyond +-65536"))).otherwise(F.col("vector"))
    return kept.select("vec_id", "label", checked.cast("array<int>").alias("vector"))


def fit(vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> tuple[np.ndarray, DataFrame]:
    """(codebooks, table of vec_id, label, codes, distances): `rounds` updates and a last assignment."""
    state = stage_table(integers(vectors), "vectors")
    first = state.orderBy(F.col("vec_id").asc_nulls_last(), "vector").limit(entries).collect()
    length = len(first[0]["vector"]) if first else parts
    if length % parts:
        raise ValueError(f"vectors of {length} components can't be cut into {parts} equal parts")
    # Other lengths are rare; the first rows are taken again among those of the right one.
    state = state.filter(F.size("vector") == length)
    if any(len(r["vector"]) != length for r in first):
        first = state.orderBy(F.col("vec_id").asc_nulls_last(), "vector").limit(entries).collect()
    books = np.array([r["vector"] for r in first], np.int64).reshape(len(first), parts, length // parts).transpose(1, 0, 2)
    if not first:
        return books, state.select("vec_id", "label", F.array().cast("array<int>").alias("codes"), F.array().cast("array<long>").alias("distances"))
    state = state.withColumns({"codes": F.lit(None).cast("array<int>"), "distances": F.lit(None).cast("array<long>")})
    before = None
    for _ in range(rounds):
        state = _round(_vectors(state) if before is not None else state, books, before)
        before, books = books, update(state, books)
    state = _round(_vectors(state), books, before)
    return books, _vectors(state).select("vec_id", "label", "codes", "distances")


def compress(vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> DataFrame:
    """One row per kept vector: its code, its error, that of its label, and the digest of the codebooks."""
    books, coded = fit(vectors, parts, entries, rounds)
    digest = hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()
    code = F.array_join(F.transform("codes", lambda c: F.lower(F.lpad(F.hex(c), 2, "0"))), "")
    error = F.aggregate("distances", F.lit(0).cast("long"), lambda a, d: a + d)
    rows = coded.select("vec_id", "label", code.alias("code"), error.alias("error"))
    # Partial sums before the shuffle; a label that very many rows share is hot on one side of the join only.
    by_label = rows.groupBy(F.col("label").alias("_label")).agg(F.sum("error").alias("label_error"))
    joined = rows.join(by_label, F.col("label").eqNullSafe(F.col("_label")))
    return joined.select("vec_id", "code", "error", "label_error", F.lit(digest).alias("codebooks_sha256"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compress(table(spark, sf_dir, "embeddings"))


def _oracle() -> str:
    """The same by plain Lloyd rounds: every part against every entry each time."""
    size = f"(length // {PARTS})"
    steps = [
        f"""
kept AS MATERIALIZED (
    SELECT row_number() OVER (ORDER BY vec_id NULLS LAST) AS r, vec_id, label, len(embedding) AS length, embedding FROM embeddings
    WHERE embedding IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda v: v IS NULL OR NOT isfinite(v))) = 0),
x AS MATERIALIZED (
    SELECT r, vec_id, label, i // {size} AS part, i % {size} AS pos, CAST(floor({SCALE} * CAST(embedding[i + 1] AS DOUBLE)) AS BIGINT) AS v
    FROM (SELECT *, unnest(range(length)) AS i FROM kept)),
p AS MATERIALIZED (SELECT r, part, list(v ORDER BY pos) AS v FROM x GROUP BY r, part),
b0 AS MATERIALIZED (SELECT part, r - 1 AS entry, v FROM p WHERE r <= {ENTRIES})"""
    ]
    for n in range(ROUNDS + 1):
        steps.append(
            f"""
a{n} AS MATERIALIZED (
    SELECT r, part, arg_min(entry, (d, entry)) AS entry, min(d) AS d
    FROM (SELECT r, p.part, entry, list_sum(list_transform(list_zip(p.v, b{n}.v), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) AS d
        FROM p JOIN b{n} ON p.part = b{n}.part) GROUP BY r, part)"""
        )
        if n < ROUNDS:
            steps.append(
                f"""
m{n} AS MATERIALIZED (
    SELECT part, entry, list(CAST(floor_of AS BIGINT) ORDER BY pos) AS v
    FROM (SELECT x.part, entry, pos, (sum(v) - ((sum(v) % count(*)) + count(*)) % count(*)) // count(*) AS floor_of
        FROM x JOIN a{n} ON x.r = a{n}.r AND x.part = a{n}.part GROUP BY x.part, entry, pos) GROUP BY part, entry),
b{n + 1} AS MATERIALIZED (SELECT b{n}.part, b{n}.entry, coalesce(m{n}.v, b{n}.v) AS v FROM b{n} LEFT JOIN m{n} ON m{n}.part = b{n}.part AND m{n}.entry = b{n}.entry)"""
            )
    return f"""
WITH {",".join(steps)},
coded AS (SELECT r, string_agg(printf('%02x', entry), '' ORDER BY part) AS code, CAST(sum(d) AS BIGINT) AS error FROM a{ROUNDS} GROUP BY r),
books AS (SELECT sha256(string_agg(array_to_string(v, ','), ',' ORDER BY part, entry)) AS s FROM b{ROUNDS})
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, s AS codebooks_sha256
FROM kept JOIN coded USING (r), books
"""


ORACLE = _oracle()
