from __future__ import annotations

import hashlib
import random
import re

import duckdb
import numpy as np
from pyspark.sql import functions as F

from costmart.llm import winnowing as wn

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def slow(docs, items, window=10):
    cut = {}
    for item_id, text in items:
        w = words(text)
        t = min(window, len(w))
        for s in range(len(w) - t + 1 if w else 0):
            cut.setdefault((t, tuple(w[s : s + t])), set()).add(item_id)
    out = []
    for doc_id, text in docs:
        w, hit, met = words(text), set(), set()
        for t in {t for t, _ in cut}:
            for s in range(len(w) - t + 1):
                if (found := cut.get((t, tuple(w[s : s + t])))) is not None:
                    hit |= set(range(s, s + t))
                    met |= found
        listed = sorted(str(i) for i in met if i is not None)
        out.append((doc_id, len(w), len(hit), len(listed), hashlib.sha256(",".join(listed).encode()).hexdigest(), bool(hit)))
    return out


def same(got, want):
    order = lambda r: tuple("" if v is None else str(v) for v in r)
    assert sorted(map(tuple, got.collect()), key=order) == sorted(want, key=order)


def frames(spark, docs, items):
    clash = {c: F.lit(3) for c in ("row", "t", "start", "window", "hash", "n_hit", "items", "n_words")}
    return (
        spark.createDataFrame(docs, "doc_id long, text string").withColumns(clash).repartition(3),
        spark.createDataFrame(items, "item_id long, text string").withColumns(clash),
    )


def test_equals_brute_force(spark):
    rnd = random.Random(3)
    vocabulary = ["a", "b", "Über", "straße", "x1", "日本", "ÀÉ", "the"] + [f"w{n}" for n in range(30)]
    some = lambda n: " ".join(rnd.choice(vocabulary) for _ in range(n))
    items = [(n, some(rnd.choice([12, 25, 60]))) for n in range(12)]
    items += [(20, "a b"), (21, "WORD"), (21, some(11)), (22, ""), (23, None), (None, some(15)), (24, "same " * 30), (25, "?! \x00 -"), (26, items[3][1])]
    items += [(27, " ".join(items[4][1].split()[2:11]))]
    docs = []
    for n in range(60):
        text = some(rnd.randrange(40))
        for _ in range(rnd.randrange(3)):
            w = (rnd.choice(items)[1] or "").split()
            low = rnd.randrange(len(w) + 1)
            text += rnd.choice([" ", "\n", "--"]) + rnd.choice([" ", ", ", "\x00"]).join(w[low : low + rnd.choice([5, 9, 10, 11, 40])]).upper() + " " + some(3)
        docs.append((n, text))
    docs += [(100, None), (101, ""), (102, "... \n"), (None, items[0][1]), (7, docs[7][1]), (7, docs[7][1]), (103, "same " * 5000), (104, "x" * 3_000_000 + " word"), (105, "SAME")]
    d, i = frames(spark, docs, items)
    same(wn.decontaminate(d, i), slow(docs, items))
    same(wn.decontaminate(d, i.limit(0)), slow(docs, []))
    assert wn.decontaminate(d.limit(0), i).collect() == []
    with duckdb.connect() as db:
        for name, rows in (("documents", docs[:-3]), ("benchmark", items)):
            db.execute(f"CREATE TABLE {name} ({'doc_id' if name == 'documents' else 'item_id'} BIGINT, text VARCHAR)")
            db.executemany(f"INSERT INTO {name} VALUES (?, ?)", [r for r in rows if "\x00" not in (r[1] or "")])
        plain = [r for r in docs[:-3] if "\x00" not in (r[1] or "")]
        order = lambda r: tuple("" if v is None else str(v) for v in r)
        assert sorted(db.execute(wn.ORACLE).fetchall(), key=order) == sorted(slow(plain, [r for r in items if "\x00" not in (r[1] or "")]), key=order)


def test_a_full_filter_changes_nothing(spark, monkeypatch):
    monkeypatch.setattr(wn, "MOST_BITS", 13)
    monkeypatch.setattr(wn, "bit_filter", lambda hashes: np.full(1 << 10, 255, np.uint8))
    docs, items = [(1, "q " + " ".join(map(str, range(30)))), (2, "4 5 6")], [(5, " ".join(map(str, range(8, 22)))), (6, "5")]
    same(wn.decontaminate(*frames(spark, docs, items)), slow(docs, items))


def test_every_shared_span_shares_a_fingerprint():
    rnd = np.random.default_rng(1)
    for t in (1, 2, 3, 7, 10):
        a, b = (rnd.integers(0, 5, 400).astype(np.uint64) * np.uint64(7919) for _ in range(2))
        kept = [dict(zip(*map(list, wn.fingerprints(x, np.full(400, 400), t)))) for x in (a, b)]
        spans = {tuple(a[i : i + t]): i for i in range(400 - t + 1)}
        for j in range(400 - t + 1):
            if (i := spans.get(tuple(b[j : j + t]))) is not None:
                offsets = [{p - s: h for p, h in k.items() if s <= p <= s + t - (t + 1) // 2} for k, s in ((kept[0], i), (kept[1], j))]
                assert set(offsets[0].items()) & set(offsets[1].items())
        assert t == 1 or len(kept[0]) < 400


def test_words_are_hashed_across_blocks(monkeypatch):
    monkeypatch.setattr(wn, "READ", 16)
    text = "one two  Three-" + "long" * 20 + " ünï two \n two"
    data = np.frombuffer(text.encode(), np.uint8)
    starts, ends, hashes = wn.hash_words(data)
    got = [bytes(data[s:e]).decode() for s, e in zip(starts, ends)]
    assert [w.lower() for w in got] == words(text)
    assert len({h for w, h in zip(got, hashes) if w == "two"}) == 1 and len(set(hashes.tolist())) == len(set(words(text)))
