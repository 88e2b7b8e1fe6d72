"""Operator 9: nearest neighbours by collision counting over query-centred windows.

Every vector is projected on the same `PROJECTIONS` random directions; a shard keeps one sorted array per
direction (Huang et al., query-aware LSH, 2015). For a query, a window around its own projection is read
from each array. Windows grow by a factor (virtual rehashing: the arrays stay as they are, and only what
the larger window adds is read). A vector that was met in `threshold` windows is verified: its exact
distance is computed. A vector at distance R falls into a window of half-width R with probability 0.68 in
each direction, so at radius R nearly all vectors within R have been verified; a shard stops when its
k-th best distance is at most the radius. Nothing is capped: a shard may verify all of its vectors.

Vectors are dealt to shards of bounded size by a hash of id and row, so copies of one vector spread; queries
go in blocks to every shard. Each (shard, block) is one task with bounded memory, and returns at most k
rows per query; the best k of all shards are the result.

Defined results: vectors that are NULL, zero or hold NULL or non-finite components, and rows without an
id, take no part. Only vectors of a query's dimension are its candidates. Rows with a query's id are its own
and no candidates. A repeated row is a candidate each time. Of several vectors with a query's id the smallest
is the query. An empty table gives no rows. Extra columns are ignored.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from costmart.llm.frames import table
from costmart.session import stage_table

PROJECTIONS = 96
# Half-width of a window in units of the radius; a vector at the radius is met with probability 0.68.
HALF_WIDTH = 1.0
# Windows that must hold a vector: this many standard deviations below the mean for one at the radius.
SLACK = 1.4
GROWTH = 1.15
# The first radius: this share of the nearest distance among about so many vectors of the shard.
START = 0.8
SOME = 512
SEED = 7
SHARD_ROWS = 8192
QUERY_BLOCK = 1024
RESULT_SCHEMA = "query_id long, vec_id long, score double"


def directions(dim: int, count: int = PROJECTIONS, seed: int = SEED) -> np.ndarray:
    """Random unit-variance directions, the same in every task."""
    return np.random.default_rng([seed, dim]).standard_normal((dim, count))


def threshold(count: int = PROJECTIONS) -> int:
    p = math.erf(HALF_WIDTH / math.sqrt(2))
    return max(1, math.floor(count * p - SLACK * math.sqrt(count * p * (1 - p))))


class Index:
    """Sorted projections of one shard."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray):
        self.ids, self.vectors = ids, vectors
        self.some = vectors[:: max(1, len(vectors) // SOME)]
        self.axes = directions(vectors.shape[1])
        projected = vectors @ self.axes
        self.order = np.argsort(projected, axis=0, kind="stable").T.copy()
        # One array holds all sorted projections, each moved to a range of its own, so that one binary
        # search finds the windows of a query in all of them.
        self.reach = float(np.abs(projected).max()) + 1.0
        self.moved = 3 * self.reach * np.arange(projected.shape[1])
        self.sorted = (np.take_along_axis(projected, self.order.T, axis=0).T + self.moved[:, None]).ravel()
        self.order = self.order.ravel()

    def windows(self, centre: np.ndarray, half: float) -> tuple[list[int], list[int]]:
        """Where each projection's window starts and ends in `order`."""
        low, high = (np.clip(centre + h, -self.reach, self.reach) + self.moved for h in (-half, half))
        return np.searchsorted(self.sorted, low).tolist(), np.searchsorted(self.sorted, high, side="right").tolist()

    def first_radius(self, query: np.ndarray) -> float:
        """Somewhat less than the nearest distance among a few of the shard's vectors."""
        apart = self.some - query
        apart = np.einsum("ij,ij->i", apart, apart)
        apart = apart[apart > 0]
        return START * float(np.sqrt(apart.min())) if apart.size else 1e-9

    def search(self, query_id: int, query: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """(vec_id, distance) of the k nearest found, nearest first, ties to the smaller id."""
        n, needed, radius = len(self.ids), threshold(self.axes.shape[1]), self.first_radius(query)
        centre = query @ self.axes
        met = np.zeros(n, np.int64)
        verified = self.ids == query_id  # its own rows
        low = high = None
        ids, found = np.empty(0, np.int64), np.empty(0)
        while True:
            start, end = self.windows(centre, HALF_WIDTH * radius)
            if low is None:
                parts = [self.order[a:b] for a, b in zip(start, end)]
            else:
                parts = [self.order[a:b] for a, b in zip(start, low)] + [self.order[a:b] for a, b in zip(high, end)]
            low, high = start, end
            met += np.bincount(np.concatenate(parts), minlength=n)
            new = np.flatnonzero((met >= needed) & ~verified)
            if new.size:
                verified[new] = True
                apart = self.vectors[new] - query
                distance = np.sqrt(np.einsum("ij,ij->i", apart, apart))
                ids, found = np.concatenate((ids, self.ids[new])), np.concatenate((found, distance))
                best = np.lexsort((ids, found))[:k]
                ids, found = ids[best], found[best]
            if (len(found) == k and found[-1] <= radius) or verified.all():
                return ids, found
            radius *= GROWTH


def usable(rows: DataFrame, vec_id: str, vector: str) -> DataFrame:
    """vec_id, vector as doubles, dim: the rows that take part."""
    finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return (
        rows.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(vector).cast("array<double>").alias("vector"))
        .filter("vec_id is not null and vector is not null")
        .filter(finite & F.exists("vector", lambda x: x != 0.0))
        .withColumn("dim", F.size("vector"))
    )


def nearest(rows: DataFrame, queries: DataFrame, k: int = 10, shard_rows: int = SHARD_ROWS, query_block: int = QUERY_BLOCK) -> DataFrame:
    """query_id, rank, vec_id, score of the k nearest found of every query.

    `rows` and `queries` are as `usable` makes them and stored. Each side is copied once per block of the
    other: this is the stated query set against all rows, in blocks.
    """
    shards = max(1, math.ceil(rows.count() / shard_rows))
    blocks = max(1, math.ceil(queries.count() / query_block))
    row = F.pmod(F.xxhash64("vec_id", F.monotonically_increasing_id()), F.lit(shards)).cast("int")
    left = rows.withColumn("shard", row).withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    right = queries.withColumn("block", F.pmod(F.xxhash64("vec_id"), F.lit(blocks)).cast("int"))
    right = right.withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1))))
    keys = ("dim", "shard", "block")

    def search(base: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
        if base.empty or asked.empty:
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []})
        index = Index(base["vec_id"].to_numpy(), np.stack(base["vector"].to_list()).astype(np.float64))
        points = np.stack(asked["vector"].to_list()).astype(np.float64)
        out = []
        for query_id, point in zip(asked["vec_id"].to_numpy(), points):
            ids, found = index.search(query_id, point, k)
            out.append(pd.DataFrame({"query_id": query_id, "vec_id": ids, "score": found}))
        return pd.concat(out)

    local = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInPandas(search, RESULT_SCHEMA)
    best = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return (
        local.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = stage_table(usable(table(spark, sf_dir, "embeddings"), "vec_id", "embedding"), "vectors")
    asked = rows.filter(F.col("vec_id") % 100 == 0).groupBy("vec_id").agg(F.min("vector").alias("vector"))
    return nearest(rows, stage_table(asked.withColumn("dim", F.size("vector")), "queries"))
