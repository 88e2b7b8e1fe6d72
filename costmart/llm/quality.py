"""Operator 6: quality rules whose cutoffs come with a bound on false rejection.

Each text is measured once: word, symbol, repeated-line and repeated-word counts. A rule rejects a text
when its measure reaches a cutoff. Cutoffs are learned per stratum (language) and rule from labelled
texts: for each cutoff of a fixed grid, the good texts that it would reject are counted over all labels.
From the most lenient cutoff on, the exact binomial tail P(X <= rejected | n, risk) is the p-value of
"false rejection is above the risk"; testing stops at the first cutoff that fails (fixed sequence), and
the level is divided by the number of strata times rules (Bonferroni). So with probability of at
least 1 - `delta` no rule rejects more than its share of `risk` of the good texts of any stratum. Among the
certified cutoffs the one with the best balance of bad against good rejections is used, the most lenient
on ties; where none is certified or useful the rule stays off.

Defined results: NULL and empty texts have no words and fail the base rule. NULL strata are a stratum of
their own. Several labels of one document count as its lowest. Repeated rows are judged alike; an empty
label table leaves the base rule alone. Extra columns are kept by `judge` under their own names.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from costmart.llm.frames import spare, table
from costmart.session import stage_table

RISK = 0.05
DELTA = 0.05
MIN_WORDS = 50
# A rejected good text costs as much as this many rejected bad ones.
GOOD_COST = 10
# Cutoffs from lenient to strict, in thousandths.
GRID = tuple(range(1000, 40, -40))
RULES = ("symbols", "duplicate_lines", "repeated_words", "capitals", "exclamations")
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
_EXTRA = ("n_lines", "n_capitals", "n_exclamations")

_SPACES = b" \t\n\x0b\x0c\r"
_SYMBOLS = b"#*$%&|<>"
_CAPITALS = bytes(range(ord("A"), ord("Z") + 1))
MEASURE_SCHEMA = ", ".join(f"{c} long" for c in (*COUNTS, *_EXTRA))


def repeated_words(words: list[bytes]) -> int:
    """Words covered by a 3-word window that occurs at least twice."""
    n = len(words) - 2
    if n < 2:
        return 0
    seen: dict[bytes, int] = {}
    ids = np.fromiter((seen.setdefault(w, len(seen)) for w in words), np.int64, len(words))
    if len(seen) == len(words):
        return 0
    pairs = np.unique(ids[:-1] * len(seen) + ids[1:], return_inverse=True)[1]
    inverse, counts = np.unique(pairs[:-1] * len(seen) + ids[2:], return_inverse=True, return_counts=True)[1:]
    again = counts[inverse] > 1
    covered = np.zeros(len(words), bool)
    for shift in range(3):
        covered[shift : shift + n] |= again
    return int(covered.sum())


def measure_text(text: str | None) -> tuple[int, ...]:
    """The counts of one whole text, in the order of MEASURE_SCHEMA."""
    raw = (text or "").encode()
    words = raw.split()  # bytes split at exactly the six ASCII blanks
    lines = [x for x in raw.split(b"\n") if x.translate(None, _SPACES)]
    return (
        len(words),
        len(text or "") - (len(raw) - len(raw.translate(None, _SPACES))),
        len(raw) - len(raw.translate(None, _SYMBOLS)),
        len(lines) - len(set(lines)),
        repeated_words(words),
        len(lines),
        len(raw) - len(raw.translate(None, _CAPITALS)),
        raw.count(b"!"),
    )


def _measure_batches(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
    for texts in batches:
        yield pd.DataFrame([measure_text(t) for t in texts], columns=[*COUNTS, *_EXTRA], dtype="int64")


def measured(text: Column) -> Column:
    """The counts of a text column as a struct."""
    return F.pandas_udf(_measure_batches, MEASURE_SCHEMA)(text.cast("string"))


def _values(m: str) -> dict[str, Column]:
    """Each rule's measure in whole thousandths; NULL where there is nothing to measure."""

    def share(part: str, whole: str) -> Column:
        return F.when(F.col(f"{m}.{whole}") > 0, F.expr(f"{m}.{part} * 1000 div {m}.{whole}"))

    return {
        "symbols": share("n_symbols", "n_words"),
        "duplicate_lines": share("n_dup_lines", "n_lines"),
        "repeated_words": share("n_repeat_words", "n_words"),
        "capitals": share("n_capitals", "word_chars"),
        "exclamations": share("n_exclamations", "n_words"),
    }


def base_failed(m: str) -> Column:
    return (F.col(f"{m}.n_words") < MIN_WORDS) | (F.col(f"{m}.n_repeat_words") * 100 > F.col(f"{m}.n_words") * 50)


def _stratum(name: str) -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit("\0none"))


def binomial_tail(k: int, n: int, p: float) -> float:
    """P(X <= k) for X ~ Binomial(n, p), exact up to rounding: the incomplete beta function at 1 - p."""
    if k >= n:
        return 1.0
    a, b, x = n - k, k + 1, 1.0 - p
    front = math.exp(math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b) + a * math.log(x) + b * math.log1p(-x))
    if x > (a + 1) / (a + b + 2):
        return 1.0 - front * _fraction(b, a, 1.0 - x) / b
    return front * _fraction(a, b, x) / a


def _fraction(a: float, b: float, x: float) -> float:
    """The continued fraction of the incomplete beta function, by Lentz's method."""
    tiny = 1e-300
    c, d = 1.0, 1.0 / ((1.0 - (a + b) * x / (a + 1)) or tiny)
    total = d
    for m in range(1, 100_000):
        for top in (m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m)), -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))):
            d = 1.0 / ((1.0 + top * d) or tiny)
            c = (1.0 + top / c) or tiny
            total *= c * d
        if abs(c * d - 1.0) < 1e-15:
            break
    return total


def select_cutoff(good: list[int], bad: list[int], n_good: int, risk: float, level: float) -> int | None:
    """The cutoff to use, from counts of texts whose measure reaches each cutoff of the grid, lenient first."""
    best, score = None, 0
    for cutoff, g, b in zip(GRID, good, bad, strict=True):
        if n_good == 0 or binomial_tail(g, n_good, risk) > level:
            break
        if (gain := b - GOOD_COST * g) > score:
            best, score = cutoff, gain
    return best


def cutoffs(docs: DataFrame, labels: DataFrame, stratum: str = "lang", risk: float = RISK, delta: float = DELTA) -> DataFrame:
    """One row per stratum with a map from rule to cutoff, from measured documents and their labels.

    `docs` holds doc_id, the stratum and the measures `m`. Counts are aggregated over all labelled rows;
    what is gathered per (stratum, rule) is one number per cutoff and label.
    """
    one = labels.groupBy("doc_id").agg(F.min("quality").alias("quality")).filter("quality is not null")
    values = _values("m")
    rule = F.explode(F.array(*[F.struct(F.lit(r).alias("rule"), v.alias("value")) for r, v in values.items()]))
    # The place of the first cutoff that the measure reaches; the grid falls in equal steps.
    step = GRID[0] - GRID[1]
    reached = F.when(
        F.col("r.value") >= GRID[-1], F.greatest(F.lit(0), F.ceil((F.lit(GRID[0]) - F.col("r.value")) / step))
    ).otherwise(len(GRID))
    counts = (
        docs.join(one, "doc_id")
        .filter(~base_failed("m"))
        .select(_stratum(stratum).alias("stratum"), "quality", rule.alias("r"))
        .groupBy("stratum", F.col("r.rule").alias("rule"), "quality", F.coalesce(reached, F.lit(len(GRID))).cast("int").alias("place"))
        .agg(F.count("*").alias("n"))
    )
    counts = stage_table(counts, "quality-counts")
    tests = max(1, counts.select("stratum", "rule").distinct().count())

    def choose(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        total = {q: np.zeros(len(GRID) + 1, np.int64) for q in (0, 1)}
        for quality, place, n in zip(rows["quality"], rows["place"], rows["n"]):
            total[int(quality > 0)][place] += n
        good, bad = (np.cumsum(total[q])[:-1].tolist() for q in (1, 0))
        cutoff = select_cutoff(good, bad, int(total[1].sum()), risk / len(RULES), delta / tests)
        return pd.DataFrame({"stratum": [key[0]], "rule": [key[1]], "cutoff": [cutoff]}).dropna()

    chosen = counts.groupBy("stratum", "rule").applyInPandas(choose, "stratum string, rule string, cutoff long")
    return stage_table(
        chosen.groupBy("stratum").agg(F.map_from_entries(F.collect_list(F.struct("rule", "cutoff"))).alias("cutoffs")),
        "quality-cutoffs",
    )


def judge(docs: DataFrame, chosen: DataFrame, text: str = "text", stratum: str = "lang") -> DataFrame:
    """All columns of docs, then struct `quality_counts`, base_failed and kept (their names made free).

    The table of cutoffs has one row per stratum and is joined without a hint: Spark broadcasts it by its
    measured size and splits a hot stratum otherwise.
    """
    m, failed, kept, strata, limits = spare(docs, "quality_counts", "base_failed", "kept", "_stratum", "_cutoffs")
    rows = docs.withColumn(m, measured(F.col(text))).withColumn(strata, _stratum(stratum))
    limit = chosen.select(F.col("stratum").alias(f"{strata}key"), F.col("cutoffs").alias(limits))
    rows = rows.join(limit, F.col(strata) == F.col(f"{strata}key"), "left").withColumn(failed, base_failed(m))
    rejects = F.lit(False)
    for rule, value in _values(m).items():
        rejects = rejects | F.coalesce(value >= F.col(limits)[rule], F.lit(False))
    return rows.withColumn(kept, ~F.col(failed) & ~rejects).drop(strata, f"{strata}key", limits)


def learn(docs: DataFrame, labels: DataFrame, text: str = "text", stratum: str = "lang") -> DataFrame:
    """Cutoffs from the labelled documents; only narrow rows meet the labels, texts are not shuffled."""
    rows = docs.select("doc_id", stratum, measured(F.col(text)).alias("m"))
    return cutoffs(rows, labels, stratum)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang", "text")
    counted = stage_table(docs.select("doc_id", "lang", measured(F.col("text")).alias("m")), "quality-measures")
    chosen = cutoffs(counted, table(spark, sf_dir, "labels"))
    rejects = F.lit(False)
    for rule, value in _values("m").items():
        rejects = rejects | F.coalesce(value >= F.col("cutoffs")[rule], F.lit(False))
    rows = counted.withColumn("stratum", _stratum("lang")).join(chosen, "stratum", "left").withColumn("base_failed", base_failed("m"))
    return rows.select("doc_id", *[f"m.{c}" for c in COUNTS], "base_failed", (~F.col("base_failed") & ~rejects).alias("kept"))


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the rules keep, with their columns as they are."""
    kept = spare(docs, "quality_counts", "base_failed", "kept")[2]
    return judge(docs, learn(docs, table(spark, sf_dir, "labels"))).filter(kept).select(docs.columns)
