"""Operator 2: packing documents into windows by a plan over the histogram of lengths.

A document's ids (with the end id) are cut into full windows and one rest. The histogram of piece lengths
is one aggregation. Over it, shallow combinations of lengths that fill a power of two are enumerated (one
or two pieces in full, three with the TRIPLES most frequent partners per longest piece), and non-negative
least squares gives the number of times to repeat each, so that combinations use up the histogram as nearly
as they can. Repeats are rounded down; what is left is packed greedily, longest first, one piece behind the
other, and a piece that passes the end of a sequence is cut there. So only the last sequence is padded,
whatever the lengths. The plan has at most a few thousand entries, as the histogram has one bin per length.
Pieces get a gapless number among those of their length, and the plan says which numbers go where.

Defined results: NULL and empty texts have only the end id. Repeated rows are packed each. NULL ids are
allowed. An empty table gives no pieces. Extra columns are not read.
"""

from __future__ import annotations

import zlib
from collections import defaultdict
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from costmart.llm.frames import numbered, table
from costmart.llm.words import encoder
from costmart.session import stage_table

WINDOW = 1024
END_ID = 0
# Triples enumerated per longest length; pairs and single pieces are enumerated in full.
TRIPLES = 12
ROUNDS = 2000

_PIECES = pa.schema(
    [("row", pa.int64()), ("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()), ("doc_tokens", pa.int64()), ("ids", pa.binary())]
)
PIECE_SCHEMA = "row long, doc_id long, start long, length long, ids_crc32 long, doc_tokens long, ids binary"


def narrow(ids: bytes | memoryview) -> bytes:
    """Ids of four bytes each in two each, where all fit."""
    wide = np.frombuffer(ids, "<u4")
    return wide.astype("<u2").tobytes() if wide.max(initial=0) < 1 << 16 else bytes(ids)


def crc_of(ids: bytes, length: int, low: int, high: int) -> int:
    """CRC-32 of a part of narrowed ids, as four bytes each."""
    wide = np.frombuffer(ids, "<u2" if len(ids) == 2 * length else "<u4")
    return zlib.crc32(wide[low:high].astype("<u4").tobytes())


def pieces_of(docs: DataFrame, tokenizer: str, window: int = WINDOW, end_id: int = END_ID) -> DataFrame:
    """Full windows and the rest of every document's ids, with their checksum; a rest with its ids, as it may be cut."""
    end = end_id.to_bytes(4, "little")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer).ids
        for batch in batches:
            rows: list[tuple] = []
            for row, doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
                ids = memoryview(encode(text.as_py() or "") + end)
                total = len(ids) // 4
                for start in range(0, total, window):
                    part = ids[4 * start : 4 * (start + window)]
                    rest = narrow(part) if len(part) < 4 * window else None
                    rows.append((row, doc_id, start, len(part) // 4, zlib.crc32(part), total, rest))
            yield pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*rows), _PIECES)], schema=_PIECES) if rows else pa.RecordBatch.from_pylist([], _PIECES)

    return docs.select(F.monotonically_increasing_id(), F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(cut, PIECE_SCHEMA)


def combinations(counts: np.ndarray) -> list[tuple[int, ...]]:
    """Combinations of one to three present lengths whose sum is the window, or one that is a power of two."""
    window = len(counts) - 1
    have = np.flatnonzero(counts)
    out = [(int(n),) for n in have if n == window or n & (n - 1) == 0]
    present = counts > 0
    out += [(int(n), window - int(n)) for n in have if 2 * n >= window and n < window and present[window - n]]
    for n in have:
        # The most frequent partners that leave a present third length.
        second = have[(have <= n) & (2 * have >= window - n) & (have < window - n)]
        second = second[present[window - n - second]]
        common = np.minimum(counts[second], counts[window - n - second])
        for m in second[np.argsort(-common, kind="stable")[:TRIPLES]]:
            out.append((int(n), int(m), window - int(n) - int(m)))
    return out


def repeats(found: list[tuple[int, ...]], counts: np.ndarray, rounds: int = ROUNDS) -> np.ndarray:
    """Non-negative least squares: how often each combination is used, by accelerated projected gradients.

    Minimizes |A x - counts|^2 over x >= 0, A holding how often a combination uses each length. Lengths
    are weighted by themselves, so that ids and not pieces are what is used up.
    """
    use = np.array([c + (0,) * (3 - len(c)) for c in found])
    weight = np.arange(len(counts)) / (len(counts) - 1)
    target = weight * counts
    # A bound on the largest eigenvalue of A'A: the product of the largest row and column sums of A.
    column = weight[use].sum(axis=1).max()
    row = (np.bincount(use.ravel(), minlength=len(counts)) * weight).max()
    step, x = 1.0 / (column * row), np.zeros(len(found))
    ahead, t = x, 1.0
    for _ in range(rounds):
        used = np.bincount(use.ravel(), np.repeat(ahead, 3), minlength=len(counts)) * weight
        gradient = ((used - target) * weight)[use].sum(axis=1)
        after = np.maximum(0.0, ahead - step * gradient)
        faster = (1 + np.sqrt(1 + 4 * t * t)) / 2
        ahead, x, t = after + (t - 1) / faster * (after - x), after, faster
    return x


class Place(NamedTuple):
    """The pieces of `length` with numbers first to end go to the sequences from `sequence` on, one each."""

    length: int
    first: int
    end: int
    sequence: int
    offset: int


class Plan(NamedTuple):
    """Places of the pieces that combinations use up, and where each length's other pieces lie in the stream."""

    window: int
    places: list[Place]
    stream: dict[int, tuple[int, int]]  # length: (first number, ids of the stream before it)
    sequences: int  # sequences before the stream

    def parts(self, length: int, number: int) -> Iterator[tuple[int, int, int, int]]:
        """(low, high, sequence, offset) of a piece's parts in the stream."""
        first, before = self.stream[length]
        at, low = before + (number - first) * length, 0
        while low < length:
            high = min(length, low + self.window - (at + low) % self.window)
            yield low, high, self.sequences + (at + low) // self.window, (at + low) % self.window
            low = high


def plan(counts: np.ndarray) -> Plan:
    """A place for every id of the pieces in the histogram, each exactly once."""
    left, window = counts.astype(np.int64).copy(), len(counts) - 1
    given: dict[int, int] = defaultdict(int)
    places: list[Place] = []
    sequences = 0

    def take(lengths: tuple[int, ...], times: int) -> None:
        nonlocal sequences
        times = min([times, *(int(left[n]) // lengths.count(n) for n in set(lengths))])
        if times <= 0:
            return
        offset = 0
        for n in lengths:
            places.append(Place(n, given[n], given[n] + times, sequences, offset))
            given[n] += times
            left[n] -= times
            offset += n
        sequences += times

    take((window,), int(left[window]))
    found = combinations(left)
    if found:
        wanted = np.floor(repeats(found, left)).astype(np.int64)
        for i in np.argsort(-wanted, kind="stable"):
            take(found[i], int(wanted[i]))
        for lengths in found:  # what rounding left and still fits exactly
            take(lengths, int(left.max()))
    stream, before = {}, 0
    for n in np.flatnonzero(left)[::-1].tolist():  # longest first
        stream[n] = given[n], before
        before += n * int(left[n])
    return Plan(window, places, stream, sequences)


def table_of(places: list[Place]) -> dict[int, tuple[np.ndarray, list[Place]]]:
    """For each length: where its ranges of numbers begin, and their places."""
    by_length: dict[int, list[Place]] = defaultdict(list)
    for p in places:
        by_length[p.length].append(p)
    return {n: (np.array([p.first for p in own]), own) for n, own in by_length.items()}  # given in order of numbers


_PARTS = ["start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
PACKED_SCHEMA = "doc_id long, " + ", ".join(f"{c} long" for c in _PARTS)


def pack(pieces: DataFrame, window: int = WINDOW) -> DataFrame:
    """doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset of every part of the stored `pieces`."""
    spark = pieces.sparkSession
    counts = np.zeros(window + 1, np.int64)
    for row in pieces.groupBy("length").agg(F.count("*").alias("n")).collect():  # one row per length
        counts[row["length"]] = row["n"]
    made = plan(counts)
    # The plan is bounded by the number of lengths, whatever the input.
    shared = spark.sparkContext.broadcast((made, table_of(made.places)))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made, found = shared.value
        for batch in batches:
            rows = []
            for number, row, doc_id, start, length, crc, total in zip(*(c.to_pylist() for c in batch.columns)):
                if length in made.stream and number >= made.stream[length][0]:
                    parts = made.parts(length, number)
                else:
                    firsts, own = found[length]
                    p = own[int(np.searchsorted(firsts, number, "right")) - 1]
                    parts = [(0, length, p.sequence + number - p.first, p.offset)]
                for low, high, sequence, offset in parts:
                    whole = high - low == length
                    rows.append((row, start, low, length, doc_id, start + low, high - low, crc if whole else None, total, sequence, offset))
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows)] if rows else [pa.array([], pa.int64())] * len(_PLACED), names=_PLACED)

    ranked = numbered(pieces.select("row", "doc_id", "start", "length", "ids_crc32", "doc_tokens"), "length", ["doc_id", "start"], "_number")
    placed = ranked.select("_number", "row", "doc_id", "start", "length", "ids_crc32", "doc_tokens").mapInArrow(place, ", ".join(f"{c} long" for c in _PLACED))
    columns = ["doc_id", *_PARTS]
    if not made.stream:
        return placed.select(*columns)
    # Parts need their own checksum; only they meet the ids of their pieces again.
    placed = stage_table(placed, "placed")
    rests = pieces.filter(F.col("length").isin(sorted(made.stream))).select(F.col("row").alias("_row"), F.col("start").alias("_start"), "ids")
    parts = placed.filter("ids_crc32 IS NULL").join(rests, (F.col("row") == F.col("_row")) & (F.col("piece") == F.col("_start")))

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            low, size, n, ids = (batch.column(c).to_pylist() for c in ("low", "size", "length", "ids"))
            crc = pa.array([crc_of(x, z, a, a + k) for a, k, z, x in zip(low, n, size, ids)], pa.int64())
            yield pa.RecordBatch.from_arrays([crc if c == "ids_crc32" else batch.column(c) for c in columns], names=columns)

    summed = parts.select(*_PLACED, "ids").mapInArrow(check, PACKED_SCHEMA)
    return placed.filter("ids_crc32 IS NOT NULL").select(*columns).unionByName(summed)


_PLACED = ["row", "piece", "low", "size", "doc_id", *_PARTS]


def pack_documents(docs: DataFrame, tokenizer: str | None = None) -> DataFrame:
    path = tokenizer or public_tokenizers.path("byte_bpe_50k.json")
    return pack(stage_table(pieces_of(docs, path), "pieces"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(table(spark, sf_dir, "documents"))


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pack_documents(docs)
