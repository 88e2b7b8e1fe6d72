import sys

import corpus_pipeline
from conftest import DATA
from llm.test_packing import check
from llm.test_quality import slow
from llm.test_simhash import brute, slow_fingerprint

from costmart.session import stage_table


def test_stages_equal_brute_force(spark):
    """200 documents are too few to certify a cutoff or to fit a toxicity model, so all texts that pass the base
    rule go on; of each group of near-duplicates the smallest id stays, and each id is packed once."""
    docs = [(d.doc_id, d.text) for d in spark.read.parquet(f"{DATA}/documents.parquet").collect()]
    kept = []
    for doc_id, text in docs:
        words, _, _, _, repeated = slow(text)
        if words >= 50 and 100 * repeated <= 50 * words:
            kept.append((doc_id, text))
    code = {i: slow_fingerprint(t) for i, t in kept}
    root = brute(sorted(set(code.values())))
    first: dict = {}
    for i in sorted(code):
        first.setdefault(root[code[i]], i)
    stay = [(i, t) for i, t in kept if first[root[code[i]]] == i]
    assert 0 < len(stay) < len(docs)
    check(corpus_pipeline.run(spark, DATA).collect(), stay)


def test_stages_keep_columns_and_take_odd_rows(spark, odd, none):
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality_rules", "toxicity", "near_duplicates", "packing"]
    for docs in (odd, none):
        for _, stage in corpus_pipeline.STAGES[:-1]:
            out = stage_table(stage(spark, docs, DATA), "stage-test")
            assert out.columns == docs.columns and out.count() <= docs.count()
        assert corpus_pipeline.STAGES[-1][1](spark, none, DATA).count() == 0


def test_entry_works_without_the_package(monkeypatch):
    import __spark_entry__

    assert "pipeline" in __spark_entry__.queries()
    monkeypatch.setitem(sys.modules, "corpus_pipeline", None)
    left = __spark_entry__.queries()
    assert "pipeline" not in left and "m02_fct_daily_costs" in left
