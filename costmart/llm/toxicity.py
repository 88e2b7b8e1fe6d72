"""Operator 4: toxic spans by a linear-chain conditional random field.

Labels are per document, so token labels are derived first. On a bounded sample of labelled documents,
features of words (the word, its first three to seven letters) are counted in toxic and other
documents; seeds are chosen by greedy cover, each explaining toxic documents that no earlier seed explains.
In toxic documents, words with a seed feature are toxic tokens; every other token is not. On half of
the sample a CRF with two states is fitted to these token labels by gradient ascent on the conditional
likelihood. On the other half the marginals are turned into a document score by a small logistic model.
Features, seeds and evidence come from whole texts, on the executors; the chain is fitted to stretches of
words from all over the texts, chosen by hash, as many as SAMPLE_SEGMENTS.

A text is scored as one chain over all its words. Words without a known feature have constant potentials,
so a run of k of them is the k-th power of one matrix, and forward-backward only stops at words with
features: exact marginals, in time and memory proportional to the words. A text with a word that is rather toxic
than not is walked once more, word by word; a span is a run of such words, those without features included.

Defined results: NULL and empty texts have no tokens and get the score of a text without evidence. Without
toxic labels the score is 0 everywhere. Several labels of one document count as toxic if one is. A NULL id
counts as the empty text in the fold rule. Repeated rows are scored alike. Extra columns are kept by `score`.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from costmart.llm.frames import spare, table
from costmart.session import stage_table

# Bounds of the fit: labelled documents per class, features of the model, stretches that the chain is fitted
# to. They hold for the fit alone; every text is scored whole.
SAMPLE_PER_CLASS = 3000
MAX_FEATURES = 20_000
SAMPLE_SEGMENTS = 20_000
MIN_DOCS = 5
MIN_LIFT = 4.0
SEED_LIFT = 6.0
FOLDS = 5
CONTEXT = 4
SEGMENT = 64
_WORD = re.compile(r"[^\W\d_]+")
_CACHE = 1 << 17
SCORE_SCHEMA = "score double, spans array<struct<start: long, end: long, probability: double>>"


def features(word: str) -> list[str]:
    """The lower-cased word and its proper prefixes of three to seven letters."""
    w = word.lower()
    return ["=" + w, *[w[:k] for k in range(3, 8) if len(w) > k]]


@dataclass
class Model:
    """Weights of a fitted CRF and of the document score; picklable, a few thousand numbers."""

    weights: dict[str, float] = field(default_factory=dict)
    bias: float = -4.0
    enter: float = 0.0
    leave: float = 0.0
    stay: float = 0.0
    document: tuple[float, ...] = (-20.0, 0.0, 0.0, 0.0)
    fitted: bool = False

    def __post_init__(self):
        self._known: dict[str, float | None] = {}
        self._powers: dict[int, tuple] = {}

    def __getstate__(self):
        return {k: v for k, v in self.__dict__.items() if not k.startswith("_")}

    def __setstate__(self, state):
        self.__dict__.update(state)
        self.__post_init__()

    def _matrix(self, u: float) -> tuple[float, float, float, float]:
        return 1.0, math.exp(self.enter + self.bias + u), math.exp(self.leave), math.exp(self.stay + self.bias + u)

    def _power(self, k: int) -> tuple[float, float, float, float]:
        """The k-th power of the matrix of a word without features, up to a factor."""
        if (found := self._powers.get(k)) is None:
            if len(self._powers) > 1 << 14:
                self._powers.clear()
            out, base, n = np.eye(2), np.array(self._matrix(0.0)).reshape(2, 2), k
            while n:
                if n & 1:
                    out = out @ base
                    out /= out.max()
                base = base @ base
                base /= base.max()
                n >>= 1
            found = self._powers[k] = tuple(out.ravel().tolist())
        return found

    def weight(self, word: str) -> float | None:
        """The weight of a word's features, None if it has none; looked up once per worker."""
        try:
            return self._known[word]
        except KeyError:
            if len(self._known) > _CACHE:
                self._known.clear()
            have = [self.weights[f] for f in features(word) if f in self.weights]
            found = self._known[word] = sum(have) if have else None
            return found

    def marginals(self, words: list[str]) -> tuple[list[int], list[float]]:
        """Places of words with features, and the probability that each is toxic given the whole chain."""
        at = [i for i, w in enumerate(map(self.weight, words)) if w is not None]
        if not at:
            return [], []
        u = [self._known.get(words[i]) for i in at]
        u = [self.weight(words[i]) if x is None else x for i, x in zip(at, u)]
        forward = []
        a0, a1, last = 1.0, 0.0, -1
        for i, x in zip(at, u):
            if (k := i - last - 1) > 0:
                m = self._power(k)
                a0, a1 = a0 * m[0] + a1 * m[2], a0 * m[1] + a1 * m[3]
            m = self._matrix(x)
            a0, a1 = a0 * m[0] + a1 * m[2], a0 * m[1] + a1 * m[3]
            total = a0 + a1
            a0, a1, last = a0 / total, a1 / total, i
            forward.append((a0, a1))
        out = [0.0] * len(at)
        b0, b1, following = 1.0, 1.0, len(words)
        for j in range(len(at) - 1, -1, -1):
            if (k := following - at[j] - 1) > 0:
                m = self._power(k)
                b0, b1 = m[0] * b0 + m[1] * b1, m[2] * b0 + m[3] * b1
            f0, f1 = forward[j]
            out[j] = f1 * b1 / (f0 * b0 + f1 * b1)
            m = self._matrix(u[j])
            b0, b1 = m[0] * b0 + m[1] * b1, m[2] * b0 + m[3] * b1
            total = b0 + b1
            b0, b1, following = b0 / total, b1 / total, at[j]
        return at, out

    def chain(self, words: list[str]) -> list[float]:
        """The probability of every word that it is toxic."""
        known = self._known
        steps = [self._matrix((known[w] if w in known else self.weight(w)) or 0.0) for w in words]
        forward, a0, a1 = [], 1.0, 0.0
        for m in steps:
            a0, a1 = a0 * m[0] + a1 * m[2], a0 * m[1] + a1 * m[3]
            total = a0 + a1
            a0, a1 = a0 / total, a1 / total
            forward.append((a0, a1))
        out, b0, b1 = [0.0] * len(words), 1.0, 1.0
        for i in range(len(words) - 1, -1, -1):
            f0, f1 = forward[i]
            out[i] = f1 * b1 / (f0 * b0 + f1 * b1)
            m = steps[i]
            b0, b1 = m[0] * b0 + m[1] * b1, m[2] * b0 + m[3] * b1
            total = b0 + b1
            b0, b1 = b0 / total, b1 / total
        return out

    def spans(self, text: str) -> list[tuple[int, int, float]]:
        """Runs of words that are rather toxic than not: offsets, and the surest word's probability."""
        found = list(_WORD.finditer(text))
        out: list[tuple[int, int, float]] = []
        last = None
        for i, (m, p) in enumerate(zip(found, self.chain([m.group() for m in found]))):
            if p >= 0.5:
                if last == i - 1 and out:
                    out[-1] = (out[-1][0], m.end(), max(out[-1][2], p))
                else:
                    out.append((m.start(), m.end(), p))
                last = i
        return out

    def evidence(self, probabilities: list[float], words: int) -> tuple[float, ...]:
        """What the document score sees: expected toxic tokens, the surest one, their density."""
        total = sum(probabilities)
        return 1.0, math.log1p(total), max(probabilities, default=0.0), min(1.0, 50.0 * total / max(words, 1))

    def score(self, text: str | None) -> tuple[float, list[tuple[int, int, float]]]:
        words = _WORD.findall(text or "")
        at, probabilities = self.marginals(words)
        if not self.fitted:
            return 0.0, []
        z = sum(w * x for w, x in zip(self.document, self.evidence(probabilities, len(words))))
        score = 1.0 / (1.0 + math.exp(-max(-40.0, min(40.0, z))))
        return score, self.spans(text) if max(probabilities, default=0.0) >= 0.5 else []


def fit_chain(segments: list[list[tuple[np.ndarray, int]]], size: int, rounds: int = 120) -> tuple[np.ndarray, tuple[float, ...]]:
    """Feature weights and (bias, enter, leave, stay) of a CRF on segments of (feature ids, label) tokens.

    Adam on the L2-penalized conditional log-likelihood; gradients are observed minus expected counts by
    forward-backward, for all segments at once.
    """
    n, length = len(segments), max(map(len, segments))
    labels, real = np.zeros((n, length), np.int64), np.zeros((n, length), bool)
    token, feature = [], []
    for s, segment in enumerate(segments):
        for t, (ids, label) in enumerate(segment):
            labels[s, t], real[s, t] = label, True
            token += [s * length + t] * len(ids)
            feature.extend(ids)
    token, feature = np.array(token, np.int64), np.array(feature, np.int64)
    before = np.pad(labels[:, :-1], ((0, 0), (1, 0)))
    observed = np.array([labels[real].sum(), *((real & (before == a) & (labels == b)).sum() for a, b in ((0, 1), (1, 0), (1, 1)))], float)
    weights, chain = np.zeros(size), np.array([-3.0, 0.0, 0.0, 0.0])
    moments = [np.zeros(size + 4), np.zeros(size + 4)]
    toxic_of = labels.ravel()[token].astype(float)
    seen = np.bincount(feature, toxic_of, minlength=size)
    for round_ in range(1, rounds + 1):
        u = np.bincount(token, weights[feature], minlength=n * length).reshape(n, length)
        one = np.where(real, chain[0] + u, 0.0)
        moves = np.array([[0.0, chain[1]], [chain[2], chain[3]]])
        forward, norm = np.zeros((length, n, 2)), np.zeros((length, n))
        state = np.tile([1.0, 0.0], (n, 1))
        steps = []
        for t in range(length):
            step = np.exp(moves[None] + np.stack([np.zeros(n), one[:, t]], 1)[:, None, :])
            step[~real[:, t]] = np.eye(2)
            state = np.einsum("ni,nij->nj", state, step)
            norm[t] = state.sum(1)
            state = state / norm[t][:, None]
            forward[t] = state
            steps.append(step)
        back, expected = np.ones((n, 2)), np.zeros((n, length))
        pairs = np.zeros((2, 2))
        for t in range(length - 1, -1, -1):
            expected[:, t] = forward[t, :, 1] * back[:, 1] * real[:, t]
            earlier = forward[t - 1] if t else np.tile([1.0, 0.0], (n, 1))
            joint = earlier[:, :, None] * steps[t] * back[:, None, :] / norm[t][:, None, None]
            pairs += joint[real[:, t]].sum(0)
            back = np.einsum("nij,nj->ni", steps[t], back) / norm[t][:, None]
        gradient = np.concatenate([
            seen - np.bincount(feature, expected.ravel()[token], minlength=size) - 0.5 * weights,
            observed - [expected.sum(), pairs[0, 1], pairs[1, 0], pairs[1, 1]] - 0.1 * chain,
        ])
        moments[0] = 0.9 * moments[0] + 0.1 * gradient
        moments[1] = 0.99 * moments[1] + 0.01 * gradient**2
        step_ = 0.15 * (moments[0] / (1 - 0.9**round_)) / (np.sqrt(moments[1] / (1 - 0.99**round_)) + 1e-8)
        weights, chain = weights + step_[:size], chain + step_[size:]
    return weights, tuple(chain.tolist())


def fit_logistic(x: np.ndarray, y: np.ndarray, penalty: float = 0.05) -> tuple[float, ...]:
    """Penalized logistic regression by Newton steps; both classes weigh as they occur."""
    w = np.zeros(x.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -40, 40)))
        hessian = (x * (p * (1 - p))[:, None]).T @ x + penalty * np.eye(len(w))
        step = np.linalg.solve(hessian, x.T @ (y - p) - penalty * w)
        w += np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-8:
            break
    return tuple(w.tolist())


def fold(doc_id: str = "doc_id") -> Column:
    """crc32 of the id as text, modulo the number of folds; fold 0 is held out."""
    return (F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % FOLDS).cast("int")


def sample(docs: DataFrame, labels: DataFrame, per_class: int = SAMPLE_PER_CLASS) -> DataFrame:
    """(doc_id, toxic, half, text) of at most `per_class` labelled documents a class, by smallest id hash."""
    one = labels.filter("toxic is not null and doc_id is not null").groupBy("doc_id").agg((F.max("toxic") > 0).cast("int").alias("toxic"))
    one = one.filter(fold() != 0).withColumn("hash", F.xxhash64("doc_id"))
    one = docs.select("doc_id").join(one, "doc_id", "left_semi").distinct().join(one, "doc_id")
    chosen = [one.filter(F.col("toxic") == c).orderBy("hash", "doc_id").limit(per_class) for c in (1, 0)]
    # At most 2 * per_class ids, so a broadcast of proven size; texts stay where they are.
    ids = stage_table(chosen[0].unionByName(chosen[1]).select("doc_id", "toxic", F.pmod(F.col("hash"), F.lit(2)).cast("int").alias("half")), "toxicity-ids")
    found = docs.select("doc_id", F.col("text").cast("string").alias("text")).join(F.broadcast(ids), "doc_id")
    return stage_table(found.dropDuplicates(["doc_id"]), "toxicity-sample")


def learn(docs: DataFrame, labels: DataFrame) -> Model:
    """Fit on the bounded sample. Counting and feature look-up run on the executors."""
    chosen = sample(docs, labels)
    totals = {r["toxic"]: r["n"] for r in chosen.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    if not totals.get(1) or not totals.get(0):
        return Model()

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counters = (Counter(), Counter())
        for batch in batches:
            for toxic, text in zip(batch["toxic"], batch["text"]):
                words = set(_WORD.findall(text or ""))
                counters[toxic].update({f for w in words for f in features(w)})
        for toxic, counter in enumerate(counters):
            yield pd.DataFrame({"feature": list(counter), "toxic": toxic, "n": list(counter.values())}, columns=["feature", "toxic", "n"])

    counts = (
        chosen.mapInPandas(count, "feature string, toxic int, n long")
        .groupBy("feature")
        .agg(F.sum(F.when(F.col("toxic") == 1, F.col("n")).otherwise(0)).alias("n1"), F.sum(F.when(F.col("toxic") == 0, F.col("n")).otherwise(0)).alias("n0"))
        .filter(F.col("n1") >= MIN_DOCS)
    )
    lift = (F.col("n1") / totals[1]) / ((F.col("n0") + 1) / totals[0])
    known = counts.withColumn("lift", lift).filter(F.col("lift") >= MIN_LIFT).orderBy(F.desc("n1"), "feature").limit(MAX_FEATURES).collect()
    if not known:
        return Model()
    names = [r["feature"] for r in known]
    place = {f: i for i, f in enumerate(names)}
    lifts = np.array([r["lift"] for r in known])

    def held(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            ids = [sorted({place[f] for w in set(_WORD.findall(t or "")) for f in features(w) if f in place}) for t in batch["text"]]
            yield pd.DataFrame({"ids": ids})

    # The model's features that each toxic text of the sample holds: MAX_FEATURES numbers at most.
    explained = chosen.filter("toxic = 1").select("text").mapInPandas(held, "ids array<int>").collect()
    seeds = cover([set(r["ids"]) for r in explained], lifts)

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for doc_id, toxic, text in zip(batch["doc_id"], batch["toxic"], batch["text"]):
                for n, segment in enumerate(segments_of(_WORD.findall(text or ""), place, seeds if toxic else set())):
                    flat = [i for ids, _ in segment for i in ids]
                    rows.append((doc_id, n, flat, [len(ids) for ids, _ in segment], [label for _, label in segment]))
            yield pd.DataFrame(rows, columns=["doc_id", "n", "ids", "sizes", "labels"])

    stretches = chosen.filter("half = 0").select("doc_id", "toxic", "text")
    stretches = stretches.mapInPandas(cut, "doc_id long, n int, ids array<int>, sizes array<int>, labels array<int>")
    rows = stretches.orderBy(F.xxhash64("doc_id", "n"), "doc_id", "n").limit(SAMPLE_SEGMENTS).collect()
    segments = [_unpacked(r) for r in rows]
    if not any(label for s in segments for _, label in s):
        return Model()
    weights, (bias, enter, leave, stay) = fit_chain(segments, len(names))
    model = Model({f: float(w) for f, w in zip(names, weights) if abs(w) > 1e-3}, bias, enter, leave, stay)

    def judge(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            words = [_WORD.findall(t or "") for t in batch["text"]]
            yield pd.DataFrame({"toxic": batch["toxic"], "x": [list(model.evidence(model.marginals(w)[1], len(w))) for w in words]})

    judged = chosen.filter("half = 1").select("doc_id", "toxic", "text").mapInPandas(judge, "toxic int, x array<double>").collect()
    judged.sort(key=lambda r: (r["x"], r["toxic"]))  # sums of the fit don't depend on the order of rows
    if len({r["toxic"] for r in judged}) < 2:
        return Model()
    model.document = fit_logistic(np.array([r["x"] for r in judged]), np.array([r["toxic"] for r in judged], float))
    model.fitted = True
    return model


def cover(documents: list[set[int]], lifts: np.ndarray) -> set[int]:
    """Features chosen one by one for the toxic documents that they explain and earlier ones don't."""
    left = [d for d in documents if d]
    strong = lifts >= SEED_LIFT
    chosen: set[int] = set()
    least = max(MIN_DOCS, len(left) // 500)
    while left:
        counts = Counter(f for d in left for f in d if strong[f])
        if not counts:
            break
        # Documents explained, each counting for how much likelier the feature makes toxicity.
        best = max(counts, key=lambda f: (counts[f] * math.log(lifts[f]), -f))
        if counts[best] < least:
            break
        chosen.add(best)
        left = [d for d in left if best not in d]
    # Features that are as sure as the chosen ones are seeds too: their words need no other explanation.
    support = Counter(f for d in documents for f in d)
    sure = min((lifts[f] for f in chosen), default=np.inf)
    return chosen | {f for f in support if lifts[f] >= max(sure, SEED_LIFT) and support[f] >= 4 * least}


def segments_of(words: list[str], place: dict[str, int], seeds: set[int]) -> list[list[tuple[list[int], int]]]:
    """Stretches of a whole text around words with features, as (feature ids, label); one plain stretch without."""
    out: list = []
    last = None
    for at, word in enumerate(words):
        ids = [place[f] for f in features(word) if f in place]
        if not ids:
            continue
        gap = min(CONTEXT, at) if last is None else at - last - 1
        if last is None or gap > 2 * CONTEXT or len(out[-1]) + gap + 1 > SEGMENT:
            if last is not None:
                out[-1] += [([], 0)] * min(CONTEXT, gap)
            out.append([([], 0)] * min(CONTEXT, gap))
        else:
            out[-1] += [([], 0)] * gap
        out[-1].append((ids, int(not seeds.isdisjoint(ids))))
        last = at
    if last is None:
        return [[([], 0)] * min(SEGMENT, len(words))] if words else []
    out[-1] += [([], 0)] * min(CONTEXT, len(words) - last - 1)
    return out


def _unpacked(row) -> list[tuple[np.ndarray, int]]:
    ids, end = np.array(row["ids"], np.int64), np.cumsum(row["sizes"])
    return [(ids[e - n : e], label) for e, n, label in zip(end, row["sizes"], row["labels"])]


def scored(text: Column, model: Model) -> Column:
    """score and spans (character offsets and probability of each toxic word) of a text column."""

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            rows = [model.score(t) for t in texts]
            spans = [[{"start": a, "end": b, "probability": p} for a, b, p in s] for _, s in rows]
            yield pd.DataFrame({"score": [float(s) for s, _ in rows], "spans": spans}, columns=["score", "spans"])

    return F.pandas_udf(run, SCORE_SCHEMA)(text.cast("string"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = learn(docs, table(spark, sf_dir, "labels"))
    rows = docs.select("doc_id", (fold() == 0).alias("held_out"), scored(F.col("text"), model).alias("s"))
    return rows.select("doc_id", "held_out", "s.score", (F.col("s.score") >= 0.5).cast("int").alias("predicted"), "s.spans")


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that are not predicted to be toxic."""
    (s,) = spare(docs, "_toxicity")
    model = learn(docs, table(spark, sf_dir, "labels"))
    return docs.withColumn(s, scored(F.col("text"), model)).filter(F.col(f"{s}.score") < 0.5).select(docs.columns)
