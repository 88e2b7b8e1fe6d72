"""Operator 1: near-duplicates by SimHash fingerprints, linked through BK-trees.

Texts are lower-cased (A-Z), cut into words at ASCII blanks and into shingles of four words; bit i of a
fingerprint is set when it is set in over half the shingles' XXH64 values (seed 42). Equal fingerprints
collapse to one row before anything else, so copies cost nothing further.

Two fingerprints within `radius` bits agree on at least `bands - radius` of `bands` bit groups. Each
distinct fingerprint goes, for every choice of that many groups, to the block of its bits there; the
number of bands follows from the number of fingerprints, so that blocks stay small. Blocks are gathered
into shards of bounded size. A shard is a forest of BK-trees, one per block: a child hangs on the edge
numbered by its Hamming distance to the parent, and a search follows only edges within the radius of its
distance to the node (triangle inequality). A block larger than `block_limit` is cut into pieces, and
every pair of pieces is a block of its own, so that no task holds more and no link is lost. From each
block only one edge per fingerprint to its local root leaves; alternating stars join the blocks.

Defined results: NULL, empty and blank texts have fingerprint 0 and are linked like any other; texts of one
to three words are one shingle. Rows with a NULL id are fingerprinted and linked, and get the smallest
non-NULL id of their group, NULL if it has none. Repeated rows are all returned. An empty table gives no
rows. Extra columns are not read by `query` and are kept by `stage`.

Trees are built where their block is searched and are not broadcast: all of them together grow with the
corpus, so no size bound could be shown for them.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from costmart.llm.components import components
from costmart.llm.frames import spare, table
from costmart.session import stage_table

SEED = 42
WORDS = 4
RADIUS = 4
# Fingerprints in a block that one tree may hold, and rows of small blocks that share a task.
BLOCK_LIMIT = 20_000
SHARD_ROWS = 60_000
BLOCK_MEAN = 2_000
_STEP = 1 << 14
_FRONTIER = 1 << 17


def fingerprint(text: str | None) -> int:
    """The unsigned 64-bit fingerprint of a whole text."""
    words = (text or "").encode().lower().split()  # bytes: lower-cases A-Z only, splits at ASCII blanks
    if not words:
        return 0
    flat = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    last = min(WORDS, len(words)) - 1
    first, end = starts[: len(words) - last].tolist(), ends[last:].tolist()
    digest, counts = xxhash.xxh64_digest, np.zeros(64, np.int64)
    for at in range(0, len(first), _STEP):
        hashes = b"".join([digest(flat[s:e], SEED) for s, e in zip(first[at : at + _STEP], end[at : at + _STEP])])
        bits = np.unpackbits(np.frombuffer(hashes, np.uint8).reshape(-1, 8), axis=1)
        counts += bits.sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(counts * 2 > len(first)).tobytes(), "big")


def _fingerprints(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for texts in batches:
        yield pd.Series(np.array([fingerprint(t) for t in texts], np.uint64).view(np.int64))


def fingerprints(text: Column) -> Column:
    """The fingerprint of a text column as a long with the same 64 bits."""
    return F.pandas_udf(_fingerprints, "long")(text.cast("string"))


def _firsts(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For sorted keys: the place of each run's first element, and that place for every element."""
    new = np.ones(len(keys), bool)
    new[1:] = keys[1:] != keys[:-1]
    starts = np.flatnonzero(new)
    return starts, starts[np.cumsum(new) - 1]


class Forest:
    """BK-trees over (block, fingerprint), built level by level for all blocks at once."""

    def __init__(self, block: np.ndarray, codes: np.ndarray):
        self.codes = codes
        order = np.argsort(block, kind="stable")
        root = np.empty(len(codes), np.int64)
        root[order] = order[_firsts(block[order])[1]]
        self.root = root
        rest = np.flatnonzero(root != np.arange(len(codes)))
        above, edges, children = root[rest], [], []
        while len(rest):
            key = above * 65 + np.bitwise_count(codes[rest] ^ codes[above])
            order = np.argsort(key, kind="stable")
            key, rest = key[order], rest[order]
            starts, first = _firsts(key)
            edges.append(key[starts])
            children.append(rest[starts])
            lower = np.ones(len(rest), bool)
            lower[starts] = False
            above, rest = rest[first][lower], rest[lower]
        edges = np.concatenate(edges) if edges else np.empty(0, np.int64)
        order = np.argsort(edges, kind="stable")
        self.edges = edges[order]
        self.children = (np.concatenate(children) if children else np.empty(0, np.int64))[order]

    def within(self, radius: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Pairs (member, smaller member of its block) at most `radius` bits apart, in bounded portions."""
        queries = np.arange(len(self.codes))
        stack = [(queries[at : at + _FRONTIER], self.root[at : at + _FRONTIER]) for at in range(0, len(queries), _FRONTIER)]
        while stack:
            query, node = stack.pop()
            apart = np.bitwise_count(self.codes[query] ^ self.codes[node]).astype(np.int64)
            hit = (apart <= radius) & (node < query)
            if hit.any():
                yield query[hit], node[hit]
            low = np.searchsorted(self.edges, node * 65 + np.maximum(apart - radius, 0))
            size = np.searchsorted(self.edges, node * 65 + np.minimum(apart + radius, 64), side="right") - low
            total = int(size.sum())
            if not total:
                continue
            child = self.children[np.repeat(low - np.cumsum(size) + size, size) + np.arange(total)]
            query = np.repeat(query, size)
            stack += [(query[at : at + _FRONTIER], child[at : at + _FRONTIER]) for at in range(0, total, _FRONTIER)]


def local_roots(block: np.ndarray, codes: np.ndarray, radius: int) -> np.ndarray:
    """For each member the least member (by place) that it reaches within its block."""
    root = np.arange(len(codes))
    for a, b in Forest(block, codes).within(radius):
        while True:
            ra, rb = root[a], root[b]
            apart = ra != rb
            if not apart.any():
                break
            np.minimum.at(root, np.maximum(ra[apart], rb[apart]), np.minimum(ra[apart], rb[apart]))
            while not np.array_equal(root, flat := root[root]):
                root = flat
    return root


def masks(bands: int, radius: int) -> list[int]:
    """Bit masks, one per choice of bands that two codes within the radius must agree on."""
    cuts = [64 * i // bands for i in range(bands + 1)]
    groups = [((1 << b) - 1) ^ ((1 << a) - 1) for a, b in zip(cuts, cuts[1:])]
    return [sum(c) - (1 << 64) * (sum(c) >> 63) for c in combinations(groups, bands - radius)]


def bands_for(codes: int, radius: int, block_mean: int = BLOCK_MEAN) -> int:
    """The fewest bands that keep blocks of evenly spread codes at `block_mean` on average."""
    need = math.log2(max(1, codes) / block_mean) if codes > block_mean else 0
    bands = radius + 1
    while (64 // bands) * (bands - radius) < need and bands < 16:
        bands += 1
    return bands


def links(codes: DataFrame, radius: int = RADIUS, bands: int | None = None, block_limit: int = BLOCK_LIMIT, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """Edges (node, other) that join the same groups as all pairs of codes within the radius.

    `codes` holds distinct longs `code` and is stored. At most one edge per code and block is made.
    """
    total = codes.count()
    chosen = masks(bands or bands_for(total, radius), radius)
    choice = F.explode(F.array(*[F.struct(F.lit(i).alias("choice"), F.col("code").bitwiseAND(F.lit(m)).alias("bits")) for i, m in enumerate(chosen)]))
    dealt = codes.select("code", choice.alias("c")).select("code", "c.choice", "c.bits")
    sizes = dealt.groupBy("choice", "bits").agg(F.count("*").alias("size"))
    # Blocks of one code have no pair. Large ones are cut into pieces; each pair of pieces meets once.
    sizes = stage_table(sizes.filter("size > 1"), "simhash-blocks")
    large = sizes.filter(F.col("size") > block_limit).withColumn("pieces", F.ceil(F.col("size") * 2 / block_limit).cast("int"))
    usual = dealt.join(sizes.filter(F.col("size") <= block_limit).drop("size"), ["choice", "bits"], "left_semi").select(
        "code", "choice", "bits", F.lit(-1).alias("a"), F.lit(-1).alias("b")
    )
    piece = F.pmod(F.xxhash64("code", F.lit(1)), F.col("pieces")).cast("int")
    cut = dealt.join(large.drop("size"), ["choice", "bits"]).withColumn("piece", piece)
    cut = cut.withColumn("with", F.explode(F.sequence(F.lit(0), F.col("pieces") - 1))).select(
        "code", "choice", "bits", F.least("piece", "with").alias("a"), F.greatest("piece", "with").alias("b")
    )
    shards = max(1, math.ceil(total * len(chosen) / shard_rows))
    # A cut block is a shard by itself; small blocks share one.
    shard = F.when(F.col("a") < 0, F.pmod(F.xxhash64("choice", "bits"), F.lit(shards))).otherwise(F.xxhash64("choice", "bits", "a", "b"))
    rows = usual.unionByName(cut).select("code", F.xxhash64("choice", "bits", "a", "b").alias("block"), shard.alias("shard"), (F.col("a") < 0).alias("usual"))

    def search(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["block", "code"], ignore_index=True)
        code = rows["code"].to_numpy()
        root = local_roots(rows["block"].to_numpy(), code.view(np.uint64), radius)
        linked = np.flatnonzero(root != np.arange(len(root)))
        return pd.DataFrame({"node": code[linked], "other": code[root[linked]]})

    return rows.groupBy("usual", "shard").applyInPandas(search, "node long, other long")


def groups(rows: DataFrame, code: str, doc_id: str, radius: int = RADIUS) -> DataFrame:
    """(code, component): for each distinct code the smallest id in its group. `rows` is narrow and stored."""
    distinct = stage_table(rows.groupBy(F.col(code).alias("code")).agg(F.min(doc_id).alias("least")), "simhash-codes")
    roots = components(links(distinct.select("code"), radius))
    joined = distinct.join(roots, distinct["code"] == roots["node"], "left").withColumn("root", F.coalesce("root", "code"))
    # Both sides stored: the join then has exchanges of its own, which adaptive execution splits where one
    # group is hot; the aggregation combines before its shuffle.
    joined = stage_table(joined.select("code", "root", "least"), "simhash-roots")
    least = stage_table(joined.groupBy("root").agg(F.min("least").alias("component")), "simhash-least")
    return joined.select("code", "root").join(least, "root").select("code", "root", "component")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", fingerprints(F.col("text")).alias("code"))
    docs = stage_table(docs, "simhash")
    found = groups(docs, "code", "doc_id").withColumnRenamed("code", "_code")
    return docs.join(found, docs["code"] == found["_code"]).select(
        "doc_id", F.lower(F.lpad(F.hex("code"), 16, "0")).alias("fingerprint"), F.col("component").alias("component_id")
    )


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group: the one with the smallest id (NULL ids last, then by text hash).

    Only narrow rows are grouped; whole rows meet the keys of those that stay, and are fingerprinted once.
    """
    key, root, least = spare(docs, "_key", "_root", "_least")
    order = F.struct(F.col("doc_id").isNull(), "doc_id", F.xxhash64("text"))
    narrow = stage_table(docs.select("doc_id", fingerprints(F.col("text")).alias("code"), order.alias("key")), "simhash")
    found = groups(narrow, "code", "doc_id").select("code", "root")
    # Copies collapse to one row before they meet their group.
    first = narrow.groupBy("code").agg(F.min("key").alias("key")).join(found, "code").groupBy("root").agg(F.min("key").alias("key"))
    first = stage_table(first.select(F.col("root").alias(root), F.col("key").alias(least)), "simhash-first")
    kept = docs.withColumn(key, order).join(first, F.col(key) == F.col(least))
    # Rows equal in id and text are one document given more than once.
    if narrow.groupBy("key").agg(F.count("*").alias("rows")).filter("rows > 1").head(1):
        kept = kept.dropDuplicates([root])
    return kept.select(docs.columns)
