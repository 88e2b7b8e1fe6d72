from __future__ import annotations

import hashlib
from collections import defaultdict

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from costmart.llm import codebooks as cb


def slow(rows, parts=4, entries=256, rounds=4):
    """Plain Lloyd rounds with Python integers."""
    rows = [(i, v, label) for i, v, label in rows if v and all(x is not None and np.isfinite(x) for x in v)]
    rows = [(i, [int(np.floor(1024 * float(x))) for x in v], label) for i, v, label in rows]
    rows.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    size = len(rows[0][1]) // parts
    rows = [r for r in rows if len(r[1]) == size * parts]
    cut = [[v[p * size : (p + 1) * size] for p in range(parts)] for _, v, _ in rows]
    books = [[list(c[p]) for c in cut[:entries]] for p in range(parts)]
    for n in range(rounds + 1):
        codes = [[min((sum((a - b) ** 2 for a, b in zip(c[p], e)), k) for k, e in enumerate(books[p])) for p in range(parts)] for c in cut]
        for p in range(parts if n < rounds else 0):
            for k in range(len(books[p])):
                own = [c[p] for c, found in zip(cut, codes) if found[p][1] == k]
                if own:
                    books[p][k] = [sum(x) // len(own) for x in zip(*own)]
    error, by_label = [sum(d for d, _ in f) for f in codes], defaultdict(int)
    for (_, _, label), e in zip(rows, error):
        by_label[label] += e
    digest = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    return [(i, "".join(f"{k:02x}" for _, k in f), e, by_label[label], digest) for (i, _, label), f, e in zip(rows, codes, error)]


def order(r):
    return tuple("" if v is None else str(v) for v in r)


def frame(spark, rows):
    clash = {c: F.lit("z") for c in ("vector", "codes", "part", "_label", "error", "used")}
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").withColumns(clash).repartition(3)


@pytest.mark.parametrize("spread", [0.003, 1.0, 9000.0])
def test_equals_plain_rounds(spark, spread):
    """Small spreads make many ties; the largest passes what doubles hold exactly."""
    rnd = np.random.default_rng(7)
    rows = [(int(n), [float(np.float32(x)) for x in rnd.normal(0, spread, 8)], int(n) % 3 if n % 5 else None) for n in rnd.permutation(90)]
    rows += [(3, rows[0][1], 1), (3, rows[0][1], 1), (None, rows[1][1], None), (200, None, 1), (201, [1.0, None] * 4, 1), (202, [float("nan")] * 8, 1)]
    rows += [(203, [float("inf")] * 8, 2), (-1, [], 1), (204, [0.5] * 4, 7), (205, rows[2][1], 9)]
    got = cb.compress(frame(spark, rows), entries=20)
    assert sorted(map(tuple, got.collect()), key=order) == sorted(slow(rows, entries=20), key=order)


def test_odd_tables(spark):
    few = [(n, [n / 8] * 4, None) for n in range(5)]
    got = cb.compress(frame(spark, few))
    assert sorted(map(tuple, got.collect()), key=order) == sorted(slow(few), key=order)
    none = cb.compress(frame(spark, few).limit(0))
    assert none.collect() == [] and none.columns == got.columns
    with pytest.raises(ValueError, match="4 equal parts"):
        cb.compress(frame(spark, [(1, [0.5] * 6, 1)]))
    with pytest.raises(Exception, match="beyond"):
        cb.compress(frame(spark, [(1, [1e30] * 4, 1)])).collect()


def test_active_entries_equal_full_scans_with_fewer_comparisons():
    rnd = np.random.default_rng(2)
    for top in (3, 40):  # many ties, few ties
        x, books = rnd.integers(-top, top, (500, 3)), rnd.integers(-top, top, (32, 3))
        code, distance = cb.nearest(x, books)
        for _ in range(20):
            after = books.copy()
            moved = np.sort(rnd.choice(32, 4, replace=False))
            after[moved] = rnd.integers(-top, top, (4, 3))
            code, distance, compared = cb.reassign(x, after, moved, code, distance)
            want = cb.nearest(x, after)
            assert (code == want[0]).all() and (distance == want[1]).all() and compared < 500 * 32 / 2
            books = after


def test_sql_on_the_given_table(spark):
    path = "/root/testdata/sf0.001"
    with duckdb.connect() as db:
        db.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{path}/embeddings.parquet'")
        want = db.execute(cb.ORACLE).fetchall()
    assert sorted(map(tuple, cb.query(spark, path).collect())) == sorted(want)
