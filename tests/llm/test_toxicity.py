import random
import zlib

import numpy as np

from costmart.llm import toxicity as T


def corpus(spark, n=600):
    """Every fourth text holds a few words of one bad family; the rest share harmless words with it."""
    rnd = random.Random(3)
    plain = ["".join(rnd.choice("abdeilnorst") for _ in range(rnd.randint(3, 8))) for _ in range(300)]
    bad = ["vexor", "vexord", "vexorin", "gruntle", "gruntling", "gruntly"]
    rows, labels = [], []
    for i in range(n):
        words = [rnd.choice(plain) for _ in range(rnd.randint(20, 120))]
        toxic = i % 4 == 0
        for _ in range(rnd.randint(2, 5) if toxic else 0):
            words.insert(rnd.randrange(len(words)), rnd.choice(bad))
        rows.append((i, " ".join(words)))
        labels.append((i, int(toxic)))
    return spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, toxic int"), dict(labels)


def test_held_out_documents_are_told_apart(spark):
    docs, labels, truth = corpus(spark)
    model = T.learn(docs, labels)
    held = [r for r in docs.collect() if zlib.crc32(str(r.doc_id).encode()) % 5 == 0]
    assert len(held) > 50
    for r in held:
        score, spans = model.score(r.text)
        assert (score >= 0.5) == bool(truth[r.doc_id])
        if truth[r.doc_id]:
            assert all(r.text[a:b].startswith(("vexor", "grunt")) for a, b, _ in spans) and spans


def test_labels_of_held_out_documents_are_not_used(spark):
    docs, labels, _ = corpus(spark)
    flipped = labels.selectExpr("doc_id", "case when crc32(cast(doc_id as string)) % 5 = 0 then 1 - toxic else toxic end as toxic")
    assert T.learn(docs, labels) == T.learn(docs, flipped)


def test_runs_of_plain_words_are_exact():
    model = T.Model({"=bad": 6.0, "bad": 1.0, "=odd": 2.0}, -4.0, 0.3, -0.7, 0.5, (0.0, 1.0, 0.0, 0.0), True)
    words = ["x"] * 37 + ["bad", "odd"] + ["y"] * 3 + ["badly"] + ["z"] * 150 + ["bad"]
    at, found = model.marginals(words)
    state, forward = np.array([1.0, 0.0]), []
    weights = [model.weight(w) or 0.0 for w in words]
    for u in weights:
        state = state @ np.array(model._matrix(u)).reshape(2, 2)
        state /= state.sum()
        forward.append(state)
    back, want = np.ones(2), {}
    for t in range(len(words) - 1, -1, -1):
        want[t] = forward[t][1] * back[1] / (forward[t] @ back)
        back = np.array(model._matrix(weights[t])).reshape(2, 2) @ back
        back /= back.sum()
    assert np.allclose(found, [want[i] for i in at], atol=1e-12)


def test_odd_rows(spark, odd, none):
    docs, labels, _ = corpus(spark, 200)
    model = T.learn(docs, labels)
    for text in (r.text for r in odd.collect()):
        score, spans = model.score(text)
        assert 0 <= score < 0.5 and spans == []
    nothing = labels.limit(0)
    assert T.learn(docs, nothing).score("vexor vexor") == (0.0, [])
    assert T.learn(none, labels).score("vexor") == (0.0, [])
    twice = spark.createDataFrame([(0, 0), (0, 1), (None, 1), (1, None)], "doc_id long, toxic int")
    assert T.sample(docs, twice).count() <= 1


def slow_chain(model, words):
    """Marginals of all words by plain matrices."""
    moves = [np.array(model._matrix(sum(model.weights.get(f, 0.0) for f in T.features(w)))).reshape(2, 2) for w in words]
    forward, state = [], np.array([1.0, 0.0])
    for m in moves:
        state = state @ m
        state = state / state.sum()
        forward.append(state)
    back, out = np.ones(2), []
    for f, m in zip(reversed(forward), reversed(moves)):
        out.append(f[1] * back[1] / (f @ back))
        back = m @ back
        back = back / back.sum()
    return out[::-1]


def test_a_word_between_toxic_ones_belongs_to_their_span():
    model = T.Model({"=bad": 8.0}, -3.0, 0.0, -1.0, 2.5, (0.0, 1.0, 0.0, 0.0), True)
    text = "aa bad xx bad yy" + " zz" * 40 + " bad"
    words = text.split()
    want = slow_chain(model, words)
    assert np.allclose(model.chain(words), want, atol=1e-12) and want[2] >= 0.5
    _, spans = model.score(text)
    assert spans[0][0] <= 3 and text[spans[0][0] : spans[0][1]].startswith(("aa bad xx bad", "bad xx bad")) and len(spans) == 2


def test_whole_texts_are_learnt_from(spark):
    """Toxic words that only stand behind a thousand words with features are found, and their texts told."""
    rnd = random.Random(8)
    rows, labels = [], []
    for i in range(400):
        words = [rnd.choice(["alpha", "beta", "gamma", "delta"]) for _ in range(60)] + ["vexing" if rnd.random() < 0.5 else "calm"] * 2
        if i % 4 == 0:
            words = words * 25 + ["gruntle", "vexor", "gruntle"]
        rows.append((i, " ".join(words)))
        labels.append((i, int(i % 4 == 0)))
    docs, marks = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, toxic int")
    model = T.learn(docs, marks)
    assert model.fitted
    for i, text in rows:
        score, spans = model.score(text)
        assert (score >= 0.5) == (i % 4 == 0)
        assert all(a > 1000 for a, _, _ in spans)


def test_query_equals_a_slow_chain(spark, odd, tmp_path):
    docs, labels, truth = corpus(spark)
    rows = [(r.doc_id, r.text) for r in docs.collect()] + [(None, "vexor vexor"), (900, None), (901, ""), (5, "twice"), (5, "twice")]
    clash = {"score": T.F.lit(1), "spans": T.F.lit("x"), "toxic": T.F.lit(0), "half": T.F.lit(2)}
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns(clash)
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    model = T.learn(docs.select("doc_id", "text"), labels)
    assert model.fitted
    got = T.query(spark, str(tmp_path))
    assert got.columns == ["doc_id", "held_out", "score", "predicted", "spans"]
    found = sorted(((r.doc_id, r.held_out, r.score, r.predicted, r.spans) for r in got.collect()), key=lambda r: (str(r[0]), r[2]))
    want = []
    for doc_id, text in rows:
        spots = list(T._WORD.finditer(text or ""))
        words = [m.group() for m in spots]
        chain = slow_chain(model, words)
        with_features = [p for w, p in zip(words, chain) if any(f in model.weights for f in T.features(w))]
        x = (1.0, np.log1p(sum(with_features)), max(with_features, default=0.0), min(1.0, 50 * sum(with_features) / max(1, len(words))))
        score = 1 / (1 + np.exp(-np.clip(np.dot(model.document, x), -40, 40)))
        runs, last = [], None
        for i, p in enumerate(chain):
            if p >= 0.5:
                if last == i - 1 and runs:
                    runs[-1][1:] = [spots[i].end(), max(runs[-1][2], p)]
                else:
                    runs.append([spots[i].start(), spots[i].end(), p])
                last = i
        crc = zlib.crc32(("" if doc_id is None else str(doc_id)).encode())
        want.append((doc_id, crc % 5 == 0, score, int(score >= 0.5), runs))
    want.sort(key=lambda r: (str(r[0]), r[2]))
    for a, b in zip(found, want, strict=True):
        assert a[:2] == b[:2] and abs(a[2] - b[2]) < 1e-9 and a[3] == b[3]
        assert [(s.start, s.end) for s in a[4]] == [(s, e) for s, e, _ in b[4]]
        assert np.allclose([s.probability for s in a[4]], [p for *_, p in b[4]], atol=1e-9)
    assert sum(truth.values()) == sum(r[3] for r in found if r[0] is not None and r[0] < 600)
