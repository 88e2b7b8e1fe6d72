import numpy as np
from conftest import DATA

from costmart.llm import ann as A


def exact(ids, vectors, q, k=10):
    apart = np.sqrt(((vectors - vectors[ids == q][0]) ** 2).sum(1))
    apart[ids == q] = np.inf
    order = np.lexsort((ids, apart))[:k]
    return ids[order], apart[order]


def test_recall_and_scores_over_several_shards(spark):
    rng = np.random.default_rng(1)
    vectors = rng.standard_normal((3000, 48))
    vectors /= np.linalg.norm(vectors, axis=1)[:, None]
    vectors[1000:2000] = vectors[0]  # a third are copies of one vector
    ids = np.arange(3000)
    frame = spark.createDataFrame([(int(i), v.tolist()) for i, v in zip(ids, vectors)], "vec_id long, embedding array<double>")
    rows = A.usable(frame, "vec_id", "embedding")
    found = A.nearest(rows, rows.where("vec_id % 100 = 0"), shard_rows=700, query_block=13).collect()
    hits = 0
    for q in range(0, 3000, 100):
        mine = sorted((r for r in found if r.query_id == q), key=lambda r: r["rank"])
        want, apart = exact(ids, vectors, q)
        assert [r["rank"] for r in mine] == list(range(1, 11))
        assert [(r.score, r.vec_id) for r in mine] == sorted((r.score, r.vec_id) for r in mine)
        hits += len({r.vec_id for r in mine} & set(want.tolist()))
        if q == 0:
            assert [r.vec_id for r in mine] == list(range(1000, 1010)) and mine[-1].score == 0
    assert hits >= 0.95 * 300


def test_query_recall(spark):
    table = spark.read.parquet(f"{DATA}/embeddings.parquet").orderBy("vec_id").collect()
    ids, vectors = np.array([r.vec_id for r in table]), np.array([r.embedding for r in table], float)
    found = A.query(spark, DATA).collect()
    for q in ids[ids % 100 == 0]:
        mine = {r.vec_id: r.score for r in found if r.query_id == q}
        want, apart = exact(ids, vectors, q)
        assert len(set(mine) & set(want.tolist())) >= 9
        assert all(abs(mine[int(i)] - d) < 1e-12 for i, d in zip(want, apart) if int(i) in mine)


def test_odd_rows(spark):
    rows = [
        (0, [1.0, 2.0]), (0, [1.0, 2.0]), (1, None), (2, [0.0, 0.0]), (3, [float("nan"), 1.0]), (4, [None, 1.0]),
        (5, [1.0, 2.0]), (6, [1.0, 2.0, 3.0]), (None, [1.0, 1.0]), (7, [float("inf"), 1.0]), (100, [3.0, 3.0]), (8, []),
    ]
    usable = A.usable(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), "vec_id", "embedding")
    assert sorted(r.vec_id for r in usable.collect()) == [0, 0, 5, 6, 100]
    asked = usable.where("vec_id in (0, 100)").dropDuplicates(["vec_id"])
    found = sorted((r.query_id, r["rank"], r.vec_id) for r in A.nearest(usable, asked).collect())
    assert found == [(0, 1, 5), (0, 2, 100), (100, 1, 0), (100, 2, 0), (100, 3, 5)]
    assert A.nearest(usable.limit(0), asked.limit(0)).count() == 0
