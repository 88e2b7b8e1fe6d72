"""Operator 10: token ids in files of independently coded blocks, by an adaptive context-mixing range coder.

Documents are dealt by range of id and sorted, encoded, and their ids laid end to end per partition. A
stretch of ids (a frame, one row of a Parquet file) is cut into blocks of `BLOCK` ids. Each block starts
from an empty model and carries a CRC-32 of its ids. A block lists the ids it uses; from there on it codes
places in that list:

- order 2 and order 1 each predict the id that last followed the same two ids, or the same id. How often
  predictions of the same confidence came true is counted; where both orders predict the same id, the two
  rates are mixed by a weight that moves to the order that did better;
- order 0 codes ids that no prediction gives: the list is ordered by frequency in classes of doubling size,
  and a distribution over the classes, counted so far and brought up to date every 32 ids, is followed by the
  place within the class.

The intervals of these distributions drive a 62-bit range coder with 32-bit words and carries: all that
codes one id narrows the range before a word is due, so a step writes or reads one word at most. All
arithmetic is on integers, so every machine decodes alike. Blocks are independent, so a task codes the
blocks of a frame side by side, one id of each at a time; a step costs much the same for few blocks as
for a thousand, so frames are long.

Defined results: NULL and empty texts have only the end id. Rows without id come first, as in Spark's
ascending order; repeated ids follow each other in no fixed order, each with its own start. An empty table
gives no rows. Extra columns are ignored. A block that does not match its checksum raises an error.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import public_tokenizers
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from costmart.llm.frames import table
from costmart.llm.words import encoder
from costmart.session import scratch_path, stage_table

END_ID = 1
BLOCK = 2048
FRAME = 1 << 23
_TOTAL = 1 << 15
_LEAST = 64
_MOST = _TOTAL - 512
_SLOTS = 2048
# The place of no id: tables start with it, at confidence 0.
_NONE = BLOCK << 3
# An id's class in its block: the bit length of its rank by frequency. Class k holds 2^(k-1) ranks.
_CLASS = np.array([i.bit_length() for i in range(BLOCK + 1)])
_CLASSES = BLOCK.bit_length()
_BITS = np.maximum(np.arange(_CLASSES) - 1, 0)  # of the place within each class
_BASE = np.where(np.arange(_CLASSES) > 0, 1 << _BITS, 0)  # its first place
_NAME_BITS = 21
# Coders hold 62 bits, of which the upper 32 are the next word.
_STATE, _WORD, _LOW = 1 << 62, 1 << 30, (1 << 30) - 1


class _Model:
    """The adaptive state of a number of blocks side by side; encoder and decoder update it alike.

    A prediction is stored as place << 3 | confidence, from 1 to 4 or 0 where there is none. What is kept
    for order 1 and order 2 has them as its two rows.
    """

    def __init__(self, blocks: int):
        self.blocks = np.int64(blocks)
        self.lane = np.arange(blocks)
        self.row = np.stack((self.lane * (BLOCK + 1), blocks * (BLOCK + 1) + self.lane * _SLOTS))
        self.next = np.full(blocks * (BLOCK + 1 + _SLOTS), _NONE, np.int16)
        # Rates at which predictions of each confidence came true.
        self.rate = np.tile(np.array([0, 4, 16, 24, 28, 0, 0, 0], np.int16) << 10, 2 * blocks)
        self.rates = np.arange(2 * blocks).reshape(2, blocks) << 3
        self.weight = np.full(blocks, 8, np.int8)
        self.seen = np.ones((_CLASSES, blocks), np.int64)
        self.classes = np.zeros((_CLASSES + 1, blocks), np.int64)
        self.classes[-1] = _TOTAL
        self.last = np.full(blocks, BLOCK)  # a place that no id has
        self.before = np.full(blocks, BLOCK)
        self.steps = 0

    def keep(self, blocks: int) -> None:
        """Go on with the first blocks alone."""
        for name in ("lane", "row", "rates", "weight", "last", "before"):
            setattr(self, name, getattr(self, name)[..., :blocks])

    def predict(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(order-2 candidate, its frequency, order-1 candidate, frequency of both) per block."""
        if self.steps & 31 == 0 or self.steps & (self.steps - 1) == 0:
            self._spread()
        self.steps += 1
        self.at = self.row.copy()
        self.at[0] += self.last
        self.at[1] += self.last * 1181 + self.before & _SLOTS - 1
        entry = self.next.take(self.at, mode="clip")
        self.place, self.sure = entry >> 3, entry & 7
        self.which = self.rates + self.sure
        self.old = self.rate.take(self.which, mode="clip")
        (p1, p2), (r1, r2) = self.place, self.old.astype(np.int64)
        self.same, gap = p1 == p2, r2 - r1
        self.better2 = gap > 0
        first = np.where(self.same, r1 + (self.weight * gap >> 4), r2)
        second = ((_TOTAL - first) * r1 >> 15) * ~self.same
        # An id that neither order gives keeps a chance of 1/128.
        return p2, first, p1, np.minimum(first + second, _TOTAL - 256)

    def update(self, place: np.ndarray) -> None:
        small = place.astype(np.int16)
        hit = self.place == small
        # Between the least and the most, so that every outcome keeps a chance.
        self.rate[self.which] = self.old + (hit * np.int16(_MOST - _LEAST) - (self.old - np.int16(_LEAST)) >> 5)
        right = (self.better2 == hit[1]).view(np.int8)
        self.weight = np.minimum(np.maximum(self.weight + (right + right - np.int8(1)) * self.same, np.int8(1)), np.int8(15))
        self.next[self.at] = (small << 3) | np.minimum(self.sure * hit + np.int16(1), np.int16(4))
        self.before, self.last = self.last, place

    def _spread(self) -> None:
        """The order-0 distribution as counted so far; every class keeps at least 1/2048."""
        share = (_TOTAL - 16 * _CLASSES << 32) // self.seen.sum(0)
        below = np.zeros(self.seen.shape[1], np.int64)
        for kind in range(_CLASSES - 1):
            below += self.seen[kind]
            self.classes[kind + 1] = (below * share >> 32) + 16 * (kind + 1)
        self.borders = self.classes[1:-1].astype(np.int16)

    def interval(self, kind: np.ndarray, rest: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(start, size) of a class per block, which is counted where `rest` is 1."""
        at = kind * self.blocks + self.lane
        classes, seen = self.classes.reshape(-1), self.seen.reshape(-1)
        start = classes.take(at, mode="clip")
        size = classes.take(at + self.blocks, mode="clip") - start
        seen[at] = seen.take(at, mode="clip") + rest
        return start, size


class _Writer:
    """Range coders side by side, by 32-bit words that may hold a carry until the end.

    A range is at least 2^30 before an id, and all that codes one id takes less than 30 bits of it, so that
    one word at most is due after each.
    """

    def __init__(self, blocks: int, steps: int):
        self.low = np.zeros(blocks, np.int64)
        self.range = np.full(blocks, _STATE, np.int64)
        # A row per word and a column per block.
        self.blocks, self.words = blocks, np.zeros((steps + 2) * blocks, np.int64)
        self.at = np.arange(blocks)
        self.ended: list[tuple[np.ndarray, np.ndarray]] = []

    def keep(self, blocks: int) -> None:
        self.ended.append((self.low[blocks:], self.at[blocks:]))
        self.low, self.range, self.at = self.low[:blocks], self.range[:blocks], self.at[:blocks]

    def emit(self) -> None:
        # Blocks that have no word to give write one that the next overwrites.
        self.words[self.at] = self.low >> 30
        short = (self.range < _WORD).astype(np.int64)
        bits = short << 5
        self.at = self.at + short * self.blocks
        self.low = (self.low & (_LOW | short - 1)) << bits
        self.range = self.range << bits

    def finish(self) -> list[bytes]:
        self.keep(0)
        parts = self.ended[::-1]
        low, at = np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])
        self.words[at] = low + _LOW >> 30  # one word that ends within the range
        used = at // self.blocks + 1
        words = self.words.reshape(-1, self.blocks)[: int(used.max())]
        for i in range(len(words) - 1, 0, -1):
            words[i - 1] += words[i] >> 32
        raw = words.astype("<u4").T.copy()
        return [raw[b, :n].tobytes() for b, n in enumerate(used.tolist())]


class _Reader:
    def __init__(self, coded: list[bytes]):
        # A row per word and a column per block. Blocks end with zeros, as many as may be read.
        self.blocks, longest = len(coded), max(map(len, coded)) // 4 + 3
        words = np.zeros((self.blocks, longest), "<u4")
        for b, raw in enumerate(coded):
            words[b, : len(raw) // 4] = np.frombuffer(raw, "<u4", len(raw) // 4)
        words = words.T.copy()
        self.code = words[0].astype(np.int64) << 30 | words[1] >> 2
        # What is read from here on: the last two bits of a word and thirty of the next.
        self.words = (words[1:-1] << 30 | words[2:] >> 2).reshape(-1)
        self.at = np.arange(self.blocks)
        self.end = np.arange(self.blocks) + (longest - 3) * self.blocks
        self.range = np.full(self.blocks, _STATE, np.int64)

    def keep(self, blocks: int) -> None:
        for name in ("code", "at", "end", "range"):
            setattr(self, name, getattr(self, name)[:blocks])

    def fill(self) -> None:
        short = (self.range < _WORD).astype(np.int64)
        bits = short << 5
        self.code = self.code << bits | self.words.take(self.at, mode="clip") * short
        self.at = np.minimum(self.at + short * self.blocks, self.end)  # broken blocks may run over
        self.range = self.range << bits


def _varints(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Seven bits a byte, least first, and the number of bytes of each; values are under 2^21."""
    parts = np.stack((values & 127 | 128, values >> 7 & 127 | 128, values >> 14), axis=1).astype(np.uint8)
    size = 1 + (values > 127) + (values > 16383)
    parts[np.arange(len(values)), size - 1] &= 127
    return parts[np.arange(3)[None, :] < size[:, None]], size


def _from_varints(raw: np.ndarray) -> np.ndarray:
    ends = np.flatnonzero(raw < 128)
    starts = np.concatenate(([0], ends[:-1] + 1))
    padded, value = np.concatenate((raw, [0, 0])).astype(np.int64), np.zeros(len(ends), np.int64)
    for i in range(3):
        value |= np.where(starts + i <= ends, (padded[starts + i] & 127) << 7 * i, 0)
    return value


def _within(first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(block, place) of the entries of lists laid end to end, from the entry at which each begins."""
    sizes = np.diff(first)
    owner = np.repeat(np.arange(len(sizes)), sizes)
    return owner, np.arange(first[-1]) - first[owner]


def _listed(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The lists of the blocks end to end, the entry at which each begins, and the place of every id [place, block].

    Frequent ids get small places; within a class ids ascend, so that their list is short.
    """
    blocks = -(-len(ids) // BLOCK)
    spare = blocks * BLOCK - len(ids)
    # Ids with their position, sorted per block; what fills up the last block sorts behind it.
    keyed = np.pad(ids, (0, spare), constant_values=(1 << _NAME_BITS) - 1).reshape(blocks, BLOCK)
    keyed = np.sort(keyed << 11 | np.arange(BLOCK, dtype=np.uint32), axis=1).ravel()[: len(ids)]
    name, at = keyed >> 11, keyed & BLOCK - 1
    opens = np.empty(len(ids), bool)
    opens[1:] = name[1:] != name[:-1]
    opens[::BLOCK] = True
    begins = np.flatnonzero(opens)
    runs, bits = len(begins), len(begins).bit_length()
    owner, counts = begins // BLOCK, np.diff(begins, append=len(ids))
    first = np.searchsorted(owner, np.arange(blocks + 1))
    _, rank = _within(first)
    mask = (1 << bits) - 1
    by_count = np.sort((owner << 12 | BLOCK - counts) << bits | np.arange(runs)) & mask
    by_class = np.sort((owner << 4 | _CLASS[rank]) << bits | by_count) & mask
    place = np.empty(runs, np.int16)
    place[by_class] = rank
    out = np.zeros((blocks, BLOCK), np.int16)
    out.ravel()[at + (np.arange(len(ids)) & -BLOCK)] = np.repeat(place, counts)
    return name[begins][by_class].astype(np.int64), first, out.T.copy()


def encode_blocks(ids: np.ndarray) -> tuple[list[bytes], list[int]]:
    """The coded blocks of a run of ids and the CRC-32 of each block's ids."""
    ids = np.ascontiguousarray(ids, "<u4")
    if len(ids) == 0:
        return [], []
    if int(ids.max()) >> _NAME_BITS:
        raise ValueError(f"ids must be under {1 << _NAME_BITS}")
    names, first, place = _listed(ids)
    blocks, steps, tail = place.shape[1], min(BLOCK, len(ids)), len(ids) % BLOCK
    model, out = _Model(blocks), _Writer(blocks, steps)
    kinds = _CLASS[:BLOCK]
    bits, offsets = _BITS[kinds], np.arange(BLOCK) - _BASE[kinds]
    for t in range(steps):
        if t == tail and t and blocks > 1:
            model.keep(blocks - 1)
            out.keep(blocks - 1)
        now = place[t, : len(out.low)].astype(np.int64)
        p2, first2, p1, both = model.predict()
        is2 = p2 == now
        rest = ~(is2 | (p1 == now))
        unit = out.range >> 15
        start = np.where(rest, both, first2 * ~is2)
        end = np.where(rest, _TOTAL, np.where(is2, first2, both))
        width = (end - start) * unit
        escapes, each = rest.astype(np.int64), width >> 15
        kind = kinds.take(now)
        first_of, size = model.interval(kind, escapes)
        inside = np.where(rest, size * each, width) >> bits.take(now) * escapes
        out.low = out.low + start * unit + (first_of * each + offsets.take(now) * inside) * escapes
        out.range = inside
        out.emit()
        model.update(now)
    steps = np.diff(names, prepend=0)
    _, places = _within(first)
    starts = places & places - 1 <= 0  # classes start at 0 and at powers of two
    steps[starts] = names[starts]
    listed, sizes = _varints(steps)
    listed, cuts = listed.tobytes(), np.concatenate(([0], np.cumsum(sizes)))[first].tolist()
    counts = np.diff(first).tolist()
    coded = [
        n.to_bytes(2, "little") + (z - a).to_bytes(2, "little") + listed[a:z] + words
        for n, a, z, words in zip(counts, cuts, cuts[1:], out.finish())
    ]
    return coded, [zlib.crc32(ids[b * BLOCK : (b + 1) * BLOCK]) for b in range(blocks)]


def _names(coded: list[bytes]) -> tuple[np.ndarray, list[bytes]]:
    """The ids by place, a row per block, and what follows the lists."""
    counts = [int.from_bytes(raw[:2], "little") for raw in coded]
    sizes = [int.from_bytes(raw[2:4], "little") for raw in coded]
    steps = _from_varints(np.frombuffer(b"".join(raw[4 : 4 + n] for raw, n in zip(coded, sizes)), np.uint8))
    owner, places = _within(np.concatenate(([0], np.cumsum(counts))))
    if len(owner) != len(steps) or max(counts) > BLOCK:
        raise ValueError("lists of ids do not match their checksum or size")
    starts = np.flatnonzero(places & places - 1 <= 0)
    total = np.cumsum(steps)
    total -= np.repeat((total - steps)[starts], np.diff(starts, append=len(steps)))
    names = np.zeros((len(coded), BLOCK), "<u4")
    names[owner, places] = total
    return names, [raw[4 + n :] for raw, n in zip(coded, sizes)]


def decode_blocks(coded: list[bytes], total: int, sums: list[int]) -> np.ndarray:
    """The ids of `total` coded places, checked against the blocks' sums."""
    if not total:
        return np.empty(0, "<u4")
    names, words = _names(coded)
    blocks, steps, tail = len(coded), min(BLOCK, total), total % BLOCK
    model, source = _Model(blocks), _Reader(words)
    place, ends = np.zeros((BLOCK, blocks), np.int16), (1 << _BITS) - 1
    for t in range(steps):
        if t == tail and t and blocks > 1:
            model.keep(blocks - 1)
            source.keep(blocks - 1)
        p2, first2, p1, both = model.predict()
        unit = source.range >> 15
        to2, to1 = first2 * unit, both * unit
        is2, rest = source.code < to2, source.code >= to1
        start = np.where(rest, to1, to2 * ~is2)
        code, width = source.code - start, np.where(rest, unit << 15, np.where(is2, to2, to1)) - start
        unit = width >> 15
        kind = (model.borders[:, : len(code)] <= np.minimum(code // unit, _TOTAL - 1).astype(np.int16)).view(np.int8)
        kind = kind.sum(0, dtype=np.int8).astype(np.int64)
        escapes = rest.astype(np.int64)
        start, size = model.interval(kind, escapes)
        code -= start * unit * escapes
        width = np.where(rest, size * unit, width) >> _BITS.take(kind) * escapes
        inside = np.minimum(code // width, ends.take(kind)) * escapes
        source.code, source.range = np.minimum(code - inside * width, width - 1), width  # less only in broken blocks
        now = np.where(rest, _BASE.take(kind) + inside, np.where(is2, p2, p1))
        source.fill()
        model.update(now)
        place[t, : len(now)] = now
    ids = np.concatenate([mine.take(at, mode="clip") for mine, at in zip(names, place.T.copy())])[:total]
    for b, expected in enumerate(sums):
        if zlib.crc32(ids[b * BLOCK : (b + 1) * BLOCK]) != expected:
            raise ValueError(f"block {b} does not match its checksum")
    return ids


FRAME_SCHEMA = (
    "part int, frame int, n_ids long, first_document long, document_ids array<long>, document_sizes array<long>, opens boolean, closes boolean, "
    "block_bytes array<int>, block_sums array<long>, blocks binary"
)
_FRAME = pa.schema([
    ("part", pa.int32()), ("frame", pa.int32()), ("n_ids", pa.int64()), ("first_document", pa.int64()),
    ("document_ids", pa.list_(pa.int64())), ("document_sizes", pa.list_(pa.int64())), ("opens", pa.bool_()), ("closes", pa.bool_()),
    ("block_bytes", pa.list_(pa.int32())), ("block_sums", pa.list_(pa.int64())), ("blocks", pa.binary()),
])


def write_tokens(docs: DataFrame, path: str, tokenizer: str, end_id: int = END_ID, frame: int = FRAME) -> None:
    """Write the ids of all documents, each with the end id, in ascending order of doc_id.

    Texts are shuffled once, by range over (doc_id, row), so that a repeated id is spread; ids stay in the task
    that makes them. A document longer than a frame goes on in the next one.
    """
    end = end_id.to_bytes(4, "little")
    partitions = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    rows = rows.withColumn("row", F.monotonically_increasing_id())
    rows = rows.repartitionByRange(partitions, "doc_id", "row").sortWithinPartitions("doc_id", "row").select("doc_id", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, part = encoder(tokenizer).ids, TaskContext.get().partitionId()
        held, names, sizes = bytearray(), [], []
        number = first = 0
        opens = True

        def flush(closes: bool) -> pa.RecordBatch:
            coded, sums = encode_blocks(np.frombuffer(held, "<u4"))
            return pa.RecordBatch.from_pylist([{
                "part": part, "frame": number, "n_ids": len(held) // 4, "first_document": first, "document_ids": names,
                "document_sizes": sizes, "opens": opens, "closes": closes, "block_bytes": list(map(len, coded)),
                "block_sums": sums, "blocks": b"".join(coded),
            }], _FRAME)

        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                ids = memoryview(encode(text.as_py() or "") + end)
                while True:
                    room = 4 * frame - len(held)
                    names.append(doc_id)
                    sizes.append(min(len(ids), room) // 4)
                    held += ids[:room]
                    ids = ids[room:]
                    if len(held) < 4 * frame:
                        break
                    yield flush(not ids)
                    first += len(names) - bool(ids)
                    held, names, sizes, number, opens = bytearray(), [], [], number + 1, not ids
                    if not ids:
                        break
        if names:
            yield flush(True)

    rows.mapInArrow(run, FRAME_SCHEMA).write.option("compression", "none").parquet(path)


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every document, from the files alone."""
    frames = spark.read.schema(FRAME_SCHEMA).parquet(path)
    # One row per frame, without the blocks: how many ids come before it.
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = frames.groupBy("part").agg(F.sum("n_ids").alias("n"))
    parts = parts.select("part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    within = Window.partitionBy("part").orderBy("frame").rowsBetween(Window.unboundedPreceding, -1)
    starts = frames.select("part", "frame", F.coalesce(F.sum("n_ids").over(within), F.lit(0)).alias("inside"))
    starts = starts.join(parts, "part").select("part", "frame", (F.col("before") + F.col("inside")).alias("frame_start"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for f in (batch.slice(i, 1).to_pylist()[0] for i in range(batch.num_rows)):
                ends = np.cumsum(f["block_bytes"])
                coded = [f["blocks"][e - n : e] for e, n in zip(ends, f["block_bytes"])]
                ids = memoryview(decode_blocks(coded, f["n_ids"], f["block_sums"]).tobytes())
                rows, at, last = [], 0, len(f["document_ids"]) - 1
                for i, (doc_id, n) in enumerate(zip(f["document_ids"], f["document_sizes"])):
                    whole = (i > 0 or f["opens"]) and (i < last or f["closes"])
                    rows.append((f["part"], f["frame"], f["first_document"] + i, doc_id, at, n, zlib.crc32(ids[4 * at : 4 * (at + n)]), whole))
                    at += n
                yield pa.RecordBatch.from_arrays([pa.array(list(c), t.type) for c, t in zip(zip(*rows), _PIECE)], schema=_PIECE)

    # Stored, so that the blocks are decoded once though two branches read the pieces.
    pieces = stage_table(frames.mapInArrow(run, PIECE_SCHEMA), "token-pieces").join(starts, ["part", "frame"])
    pieces = pieces.withColumn("start", F.col("frame_start") + F.col("at"))
    whole = pieces.filter("whole").select("doc_id", "start", F.col("n").alias("n_tokens"), F.col("crc").alias("ids_crc32"))
    # Documents that go over several frames: their sums are joined in order, without their ids.
    cut = pieces.filter("not whole").groupBy("part", "document").agg(
        F.first("doc_id").alias("doc_id"),
        F.min("start").alias("start"),
        F.sum("n").alias("n_tokens"),
        F.sort_array(F.collect_list(F.struct("start", "n", "crc"))).alias("pieces"),
    )
    joined = F.pandas_udf(_joined_sums, "long")(F.col("pieces.n"), F.col("pieces.crc"))
    return whole.unionByName(cut.select("doc_id", "start", "n_tokens", joined.alias("ids_crc32")))


PIECE_SCHEMA = "part int, frame int, document long, doc_id long, at long, n long, crc long, whole boolean"
_PIECE = pa.schema([
    ("part", pa.int32()), ("frame", pa.int32()), ("document", pa.int64()), ("doc_id", pa.int64()),
    ("at", pa.int64()), ("n", pa.int64()), ("crc", pa.int64()), ("whole", pa.bool_()),
])


def join_sums(first: int, second: int, length: int) -> int:
    """The CRC-32 of two byte strings from theirs and the second's length: CRC is affine in its start."""
    out = second
    zeros = bytes(min(length, 1 << 20))
    a, b = first, 0
    while length:
        n = min(length, len(zeros))
        a, b, length = zlib.crc32(zeros[:n], a), zlib.crc32(zeros[:n], b), length - n
    return out ^ a ^ b


def _joined_sums(sizes: pd.Series, sums: pd.Series) -> pd.Series:
    out = []
    for n, crc in zip(sizes, sums):
        total = 0
        for size, piece in zip(n, crc):
            total = join_sums(total, int(piece), 4 * int(size))
        out.append(total)
    return pd.Series(out, dtype="int64")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "tokens")
    write_tokens(table(spark, sf_dir, "documents"), path, public_tokenizers.path("word_bpe_49k.json"))
    return read_tokens(spark, path)
