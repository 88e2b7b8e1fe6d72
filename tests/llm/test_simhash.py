import random
import re

import numpy as np
import xxhash
from conftest import DATA

from costmart.llm import simhash as S
from costmart.llm.components import components


def signed(code: int) -> int:
    return code - 2**64 if code >= 2**63 else code


def brute(codes: list[int], radius: int = 4) -> dict[int, int]:
    parent = {c: c for c in codes}

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    array = np.array(codes, np.uint64)
    for i, c in enumerate(array):
        for j in np.flatnonzero(np.bitwise_count(array[i + 1 :] ^ c) <= radius):
            a, b = sorted((find(codes[i]), find(codes[i + 1 + int(j)])))
            parent[b] = a
    return {c: find(c) for c in codes}


def groups_of(roots: dict) -> set[frozenset]:
    found: dict = {}
    for code, root in roots.items():
        found.setdefault(root, set()).add(code)
    return {frozenset(g) for g in found.values()}


def slow_fingerprint(text):
    lowered = re.sub("[A-Z]", lambda m: chr(ord(m[0]) + 32), text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lowered)
    shingles = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_links_join_the_same_groups_as_all_pairs(spark):
    rnd = random.Random(1)
    codes = {rnd.getrandbits(64) for _ in range(600)}
    for size in (5, 60, 250):  # dense clusters and chains around a few centres
        centre = rnd.getrandbits(64)
        for _ in range(size):
            code = centre
            for _ in range(rnd.randint(1, 7)):
                code ^= 1 << rnd.randrange(64)
            codes.add(code)
    codes = sorted(codes)
    want = groups_of(brute(codes))
    frame = spark.createDataFrame([(signed(c),) for c in codes], "code long")
    for options in ({}, {"bands": 7}, {"block_limit": 40, "shard_rows": 400}):
        roots = {c: c for c in codes} | {r.node % 2**64: r.root % 2**64 for r in components(S.links(frame, **options)).collect()}
        assert groups_of(roots) == want


def test_masks_cover_every_near_pair():
    rnd = random.Random(2)
    for bands in (5, 6, 8):
        chosen = S.masks(bands, 4)
        for _ in range(300):
            flip = sum(1 << b for b in rnd.sample(range(64), 4))
            assert any(flip & (m % 2**64) == 0 for m in chosen)
    assert S.bands_for(10**4, 4) == 5 and S.bands_for(10**11, 4) > 5


def test_chains_of_components(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(200)] + [(500, 501), (501, 502), (7, 7)], "node long, other long")
    roots = {r.node: r.root for r in components(edges).collect()}
    assert roots == {i: 0 for i in range(201)} | {500: 500, 501: 500, 502: 500}
    assert components(edges.limit(0)).count() == 0


def test_query_equals_brute_force(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet").collect()
    code = {d.doc_id: slow_fingerprint(d.text) for d in docs}
    root = brute(sorted(set(code.values())))
    least: dict = {}
    for i in sorted(code):
        least.setdefault(root[code[i]], i)
    found = S.query(spark, DATA).collect()
    assert {r.doc_id: (r.fingerprint, r.component_id) for r in found} == {i: (f"{c:016x}", least[root[c]]) for i, c in code.items()}


def test_stage_keeps_one_of_each_group(spark):
    """A third of the rows are one text, some of them with one id; further texts lie within and beyond the radius."""
    rnd = random.Random(5)
    base = [f"w{rnd.randrange(900)}" for _ in range(400)]
    texts = [" ".join(base)] * 40
    for changes in (1, 1, 2, 4, 20, 200):
        for _ in range(8):
            other = list(base)
            for _ in range(changes):
                other[rnd.randrange(400)] = f"x{rnd.randrange(900)}"
            texts.append(" ".join(other))
    rows = [(i, t, "a") for i, t in enumerate(texts)] + [(3, texts[3], "b")] * 12
    rnd.shuffle(rows)
    docs = spark.createDataFrame(rows, "doc_id long, text string, _key string")
    code = {i: slow_fingerprint(t) for i, t in enumerate(texts)}
    root = brute(sorted(set(code.values())))
    least: dict = {}
    for i in sorted(code):
        least.setdefault(root[code[i]], i)
    kept = S.stage(spark, docs, DATA)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(least.values()) and 2 < len(least) < 48


def test_odd_rows(spark, odd, none):
    kept = S.stage(spark, odd, DATA)
    assert kept.columns == odd.columns
    # Empty and blank texts are one group; the repeated row stays once.
    ids = [r.doc_id for r in kept.collect()]
    assert ids.count(1) == 1 and {2, 3, 4}.intersection(ids) == {2} and len(ids) == 6
    assert S.stage(spark, none, DATA).count() == 0
    for text in (r.text for r in odd.collect()):
        assert S.fingerprint(text) == slow_fingerprint(text)
