import random
import zlib
from collections import defaultdict

from conftest import DATA
from oracle_check import compare, duck

from costmart.llm import sharding as S


def jump(key: int, shards: int) -> int:
    """The published loop, on Python's integers."""
    key %= 2**64
    place, following = -1, 0
    while following < shards:
        place = following
        key = (key * S.MULTIPLIER + 1) % 2**64
        following = int((place + 1) * (float(1 << 31) / float((key >> 33) + 1)))
    return place


def test_equals_the_published_function(spark):
    rnd = random.Random(5)
    keys = [rnd.getrandbits(64) - 2**63 for _ in range(300)] + [0, 1, -1, 2**63 - 1, -(2**63)]
    frame = spark.createDataFrame([(k,) for k in keys], "k long")
    for shards in (1, 2, 16, 3000):
        for r in S.with_shards(frame, "k", shards).collect():
            assert (r.shard, r.grown_shard) == (jump(r.k, shards), jump(r.k, shards + 1))


def test_odd_rows(odd, none):
    rows = S.shard_documents(odd, 4).collect()
    assert len(rows) == odd.count()
    slots = defaultdict(list)
    for r in rows:
        slots[r.shard].append(r.slot)
        assert r.grown_shard in (r.shard, 4)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    texts = {r.doc_id: r.text or "" for r in odd.collect() if r.doc_id}
    for r in rows:
        if r.doc_id:
            raw = texts[r.doc_id].encode()
            assert (r.size, r.text_crc32) == (len(raw) + 1, zlib.crc32(raw))
    assert len({(r.shard,) for r in rows if r.doc_id is None}) == 1
    assert S.shard_documents(none, 4).count() == 0


def test_a_hot_id_is_numbered_without_gaps(spark):
    frame = spark.createDataFrame([(7, "x")] * 500 + [(i, "y") for i in range(500)], "doc_id long, text string")
    rows = S.shard_documents(frame, 2).collect()
    for shard in (0, 1):
        mine = [r for r in rows if r.shard == shard]
        assert sorted(r.slot for r in mine) == list(range(len(mine)))
        assert [r.doc_id for r in sorted(mine, key=lambda r: r.slot)] == sorted(r.doc_id for r in mine)


def test_matches_sql(spark):
    assert compare(S.query(spark, DATA), duck(DATA), S.ORACLE) == []


def test_plan_has_no_python(spark):
    plan = S.query(spark, DATA)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan
