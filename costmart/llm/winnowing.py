"""Operator 12: benchmark decontamination by winnowing.

An item of ten words or more must be found wherever ten of them occur in a row; a shorter one, with t words,
only as a whole. For a span of t words, k = t/2 rounded up: every span of t words holds t - k + 1 runs of k
words, and keeps the one of least hash, the rightmost of equals. Two equal spans keep the same run, so
every shared span of t words shares a fingerprint; that is the guarantee, and only about two of t - k + 2
runs are kept.

Items are cut into windows of t words, in a table of different windows and one of fingerprints. The
fingerprints' semi-join with those of the documents is a bit filter of bounded size that goes to every
task: documents' fingerprints that it drops match none. What passes is extended to all windows of t words
around the run, and these are joined with the items' windows by their words, which decides exactly.
A filter too small for very many items lets more pass, and changes no result. Windows of the two
sides meet as one row per place and different window, so a passage that many documents and items share
makes no pairs of documents and items; only an item's ids are listed per document, which is asked for.

Words come from the bytes of many texts at once: a polynomial hash over the bytes, as a running sum.

Defined results: NULL and empty texts have no words; a document without hits has the digest of the empty
string. Repeated documents get a row each. Rows of the benchmark with equal item_id are one item, those
without an id hit words but are not counted or listed. Without items nothing is hit. Extra columns are
not read. Word hashes may collide, which costs time only.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from costmart.llm.frames import table
from costmart.session import stage_table

WINDOW = 10
# Bytes of text hashed side by side.
READ = 1 << 20
# The bit filter has 32 to 64 bits a fingerprint within these limits; the upper one is 16 MB.
LEAST_BITS, MOST_BITS = 13, 27

_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
_IN_WORD = np.array([48 <= c <= 57 or 65 <= c <= 90 or 97 <= c <= 122 or c >= 128 for c in range(256)])
_FOLD = np.frombuffer(_LOWER, np.uint8).astype(np.uint64) + np.uint64(1)
_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))


def _mixed(x: np.ndarray) -> np.ndarray:
    """Every bit of the result depends on every bit of x."""
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(32))


class _Powers:
    """Powers of the base and of its inverse, as many as the longest block so far needs."""

    def __init__(self) -> None:
        self.up = self.down = np.ones(1, np.uint64)

    def of(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = max(n, READ + (READ >> 2))
            steps = np.full(size, _BASE), np.full(size, _INVERSE)
            for s in steps:
                s[0] = 1
            self.up, self.down = (np.multiply.accumulate(s) for s in steps)
        return self.up[:n], self.down[:n]


_POWERS = _Powers()


def _hash_block(data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    inside = _IN_WORD[data]
    edge = np.diff(inside.view(np.int8), prepend=np.int8(0), append=np.int8(0))
    starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    up, down = _POWERS.of(len(data))
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_FOLD[data] * up, out=sums[1:])
    return starts, ends, _mixed((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64))


def hash_words(data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and hash of every word in UTF-8 bytes, in blocks that end between words."""
    found, at = [], 0
    while at < len(data):
        end = min(len(data), at + READ)
        while end < len(data) and _IN_WORD[data[end]]:
            outside = np.flatnonzero(~_IN_WORD[data[end : end + READ]])
            end = end + int(outside[0]) if len(outside) else min(len(data), end + READ)
        starts, ends, hashes = _hash_block(data[at:end])
        found.append((starts + at, ends + at, hashes))
        at = end
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64)
    return tuple(np.concatenate(c) for c in zip(*found))


def fingerprints(hashes: np.ndarray, last: np.ndarray, t: int) -> tuple[np.ndarray, np.ndarray]:
    """(position, hash) of the runs kept for spans of t words; last[i] is the end of the text of word i."""
    k = (t + 1) // 2
    n = len(hashes) - t + 1
    if n < 1:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    runs = len(hashes) - k + 1
    total = np.full(runs, t, np.uint64)
    for j in range(k):
        total = total * _BASE + hashes[j : j + runs]
    grams = _mixed(total)
    width = t - k + 1
    best, at = grams[width - 1 : width - 1 + n].copy(), np.full(n, width - 1)
    for j in range(width - 2, -1, -1):
        less = grams[j : j + n] < best
        best[less] = grams[j : j + n][less]
        at[less] = j
    whole = np.flatnonzero(np.arange(n) + t <= last[:n])
    kept = np.unique(whole + at[whole])
    return kept, grams[kept]


def _groups(batch: pa.RecordBatch) -> Iterator[tuple[int, list[bytes]]]:
    """Texts of a batch, as bytes, in groups of about READ bytes: (number of the first, texts)."""
    first, group, size = 0, [], 0
    for n, cell in enumerate(batch.column(batch.num_columns - 1)):
        text = cell.as_buffer().to_pybytes() if cell.is_valid else b""
        if group and size + len(text) > READ:
            yield first, group
            first, group, size = n, [], 0
        group.append(text)
        size += len(text) + 1
    if group:
        yield first, group


class _Texts:
    """The words of a group of texts."""

    def __init__(self, texts: list[bytes]):
        self.data = b" ".join(texts)
        self.starts, self.ends, self.hashes = hash_words(np.frombuffer(self.data, np.uint8))
        borders = np.cumsum([0, *(len(t) + 1 for t in texts)])
        self.first = np.searchsorted(self.starts, borders)  # first word of each text, and the end
        self.counts = np.diff(self.first)
        self.text_of = np.repeat(np.arange(len(texts)), self.counts)
        self.last = self.first[1:][self.text_of]
        self.data = self.data.translate(_LOWER)

    def window(self, at: int, t: int) -> str:
        starts, ends = self.starts[at : at + t].tolist(), self.ends[at : at + t].tolist()
        return b" ".join([self.data[s:e] for s, e in zip(starts, ends)]).decode()


def _passes(bits: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Which hashes the filter lets through: all three of their bits are set."""
    mask, out = np.uint64(8 * len(bits) - 1), np.ones(len(hashes), bool)
    for shift in (0, 18, 37):
        place = hashes >> np.uint64(shift) & mask
        out &= (bits[(place >> np.uint64(3)).astype(np.int64)] >> (place & np.uint64(7)).astype(np.uint8) & np.uint8(1)).astype(bool)
    return out


_ITEMS = pa.schema([("item_id", pa.string()), ("t", pa.int32()), ("window", pa.string()), ("hash", pa.int64())])


def _item_windows(items: DataFrame, window: int) -> DataFrame:
    """(item_id, t, window) of every window of every item, and (t, hash) of every fingerprint."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).to_pylist()
            for first, texts in _groups(batch):
                found = _Texts(texts)
                for n, (start, count) in enumerate(zip(found.first.tolist(), found.counts.tolist())):
                    if not count:
                        continue
                    t = min(window, count)
                    words = found.hashes[start : start + count]
                    kept = fingerprints(words, np.full(count, count), t)[1].view(np.int64).tolist()
                    rows = [{"item_id": ids[first + n], "t": t, "window": found.window(s, t)} for s in range(start, start + count - t + 1)]
                    yield pa.RecordBatch.from_pylist(rows + [{"t": t, "hash": h} for h in kept], schema=_ITEMS)

    rows = items.select(F.col("item_id").cast("string"), F.col("text").cast("string").cast("binary"))
    return stage_table(rows.mapInArrow(run, "item_id string, t int, window string, hash long"), "item-windows")


def bit_filter(hashes: DataFrame) -> np.ndarray:
    """A filter of bounded size over the column `hash`, put together from one small row per 64 bits."""
    different = hashes.select("hash").distinct()
    n = max(1, different.count())
    size = min(MOST_BITS, max(LEAST_BITS, (32 * n - 1).bit_length()))
    mask = F.lit((1 << size) - 1)
    places = F.array(*(F.shiftrightunsigned("hash", s).bitwiseAND(mask) for s in (0, 18, 37)))
    bits = different.select(F.explode(places).alias("place"))
    bit = F.expr("shiftleft(1L, CAST(place & 63 AS INT))")
    words = bits.groupBy(F.shiftright("place", 6).alias("word")).agg(F.bit_or(bit).alias("bits")).toArrow()  # 2^(size - 6) rows at most
    out = np.zeros(1 << (size - 6), np.int64)
    out[words.column("word").to_numpy()] = words.column("bits").to_numpy()
    return out.view(np.uint8)


_PLACES = pa.schema(
    [("row", pa.int64()), ("doc_id", pa.int64()), ("n_words", pa.int64()), ("t", pa.int32()), ("start", pa.int64()), ("window", pa.string())]
)
PLACE_SCHEMA = "row long, doc_id long, n_words long, t int, start long, window string"


def _document_windows(docs: DataFrame, lengths: list[int], bits: np.ndarray) -> DataFrame:
    """A row with n_words per document, and one per window around a run that the filter lets through."""
    shared = docs.sparkSession.sparkContext.broadcast(bits)

    def near(found: _Texts, t: int, bits: np.ndarray) -> np.ndarray:
        at, hashes = fingerprints(found.hashes, found.last, t)
        at = at[_passes(bits, hashes)]
        # All windows of t words that hold the run of k words, within the run's text.
        starts = np.unique((at[:, None] - np.arange(t - (t + 1) // 2 + 1)).ravel())
        low, high = starts >= 0, starts < len(found.hashes)
        starts = starts[low & high]
        return starts[(starts + t <= found.last[starts])]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = shared.value
        for batch in batches:
            rows, ids = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for first, texts in _groups(batch):
                found, n = _Texts(texts), len(texts)
                counts = pa.array(found.counts, pa.int64())
                empty = [pa.nulls(n, f.type) for f in _PLACES][3:]
                yield pa.RecordBatch.from_arrays([pa.array(rows[first : first + n]), pa.array(ids[first : first + n], pa.int64()), counts, *empty], schema=_PLACES)
                for t in lengths:
                    places = near(found, t, bits)
                    for i in range(0, len(places), 10_000):
                        part = places[i : i + 10_000]
                        of = found.text_of[part]
                        m = len(part)
                        yield pa.RecordBatch.from_arrays(
                            [
                                pa.array([rows[first + o] for o in of.tolist()], pa.int64()), pa.nulls(m, pa.int64()), pa.nulls(m, pa.int64()),
                                pa.array([t] * m, pa.int32()), pa.array(part - found.first[of], pa.int64()),
                                pa.array([found.window(s, t) for s in part.tolist()], pa.string()),
                            ],
                            schema=_PLACES,
                        )

    rows = docs.select(F.monotonically_increasing_id(), F.col("doc_id").cast("long"), F.col("text").cast("string").cast("binary"))
    return stage_table(rows.mapInArrow(run, PLACE_SCHEMA), "document-windows")


def find(docs: DataFrame, items: DataFrame, window: int = WINDOW) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(documents with row, doc_id, n_words; places hit with row, start, t; items met with row, item_id)."""
    cut = _item_windows(items, window)
    lengths = sorted(r["t"] for r in cut.select("t").distinct().collect())  # ten at most
    found = _document_windows(docs, lengths, bit_filter(cut.filter("hash IS NOT NULL")))
    of_items = stage_table(cut.filter("window IS NOT NULL").select("window", "t", "item_id").distinct(), "windows-of-items")
    places = found.filter("window IS NOT NULL").select("row", "start", "window", "t")
    hits = stage_table(places.join(of_items.select("window", "t").distinct(), ["window", "t"]), "hits")
    met = hits.select("row", "window", "t").distinct().join(of_items.filter("item_id IS NOT NULL"), ["window", "t"])
    return found.filter("n_words IS NOT NULL").select("row", "doc_id", "n_words"), hits.select("row", "start", "t"), met.select("row", "item_id").distinct()


def covered(hits: DataFrame) -> DataFrame:
    """(row, n_hit): words in the union of a document's windows; their number is bounded by its words."""
    before = Window.partitionBy("row").orderBy("start", "t").rowsBetween(Window.unboundedPreceding, -1)
    end = F.col("start") + F.col("t")
    reached = F.coalesce(F.max(end).over(before), F.lit(0))
    new = hits.select("row", F.greatest(F.lit(0), end - F.greatest("start", reached)).alias("new"))
    return new.groupBy("row").agg(F.sum("new").alias("n_hit"))


def decontaminate(docs: DataFrame, items: DataFrame, window: int = WINDOW) -> DataFrame:
    """One row per document: its words, those hit by a window of the items, and these items."""
    all_docs, hits, met = find(docs, items, window)
    listed = met.groupBy("row").agg(F.count("*").alias("n_items"), F.array_join(F.array_sort(F.collect_list("item_id")), ",").alias("items"))
    marked = all_docs.join(covered(hits), "row", "left").join(listed, "row", "left")
    n_hit = F.coalesce("n_hit", F.lit(0))
    return marked.select(
        "doc_id",
        "n_words",
        n_hit.cast("long").alias("n_hit"),
        F.coalesce("n_items", F.lit(0)).cast("long").alias("n_items"),
        F.sha2(F.coalesce("items", F.lit("")).cast("binary"), 256).alias("items_sha256"),
        (n_hit > 0).alias("contaminated"),
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


_WORDS_SQL = (
    r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
    r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
)
ORACLE = f"""
WITH d AS MATERIALIZED (SELECT row_number() OVER () AS r, doc_id, {_WORDS_SQL} AS w FROM documents),
i AS MATERIALIZED (SELECT item_id, {_WORDS_SQL} AS w FROM benchmark),
iw AS MATERIALIZED (
    SELECT DISTINCT item_id, t, array_to_string(w[s : s + t - 1], ' ') AS win
    FROM (SELECT item_id, w, t, unnest(range(1, len(w) - t + 2)) AS s FROM (SELECT item_id, w, least({WINDOW}, len(w)) AS t FROM i WHERE len(w) > 0))
),
dw AS MATERIALIZED (
    SELECT r, t, s, array_to_string(w[s : s + t - 1], ' ') AS win
    FROM (SELECT r, w, t, unnest(range(1, len(w) - t + 2)) AS s FROM d, (SELECT DISTINCT t FROM iw))
),
hits AS MATERIALIZED (SELECT r, t, s, win FROM dw SEMI JOIN iw USING (t, win)),
hit_words AS (SELECT r, count(DISTINCT p) AS n FROM (SELECT r, unnest(range(s, s + t)) AS p FROM hits) GROUP BY r),
met AS (SELECT DISTINCT r, CAST(item_id AS VARCHAR) AS item FROM hits JOIN iw USING (t, win) WHERE item_id IS NOT NULL),
listed AS (SELECT r, count(*) AS n, string_agg(item, ',' ORDER BY item) AS items FROM met GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(hit_words.n, 0) AS BIGINT) AS n_hit,
    CAST(coalesce(listed.n, 0) AS BIGINT) AS n_items, sha256(coalesce(items, '')) AS items_sha256, coalesce(hit_words.n, 0) > 0 AS contaminated
FROM d LEFT JOIN hit_words USING (r) LEFT JOIN listed USING (r)
"""
