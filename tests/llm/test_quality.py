import re
from collections import Counter
from math import comb

from conftest import DATA

from costmart.llm import quality as Q


def slow(text):
    """The counts of the contract, word by word."""
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = Counter(zip(words, words[1:], words[2:]))
    covered = {i + d for i, w in enumerate(zip(words, words[1:], words[2:])) if windows[w] > 1 for d in range(3)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered)


def test_counts_equal_brute_force(spark, odd):
    texts = [r.text for r in odd.collect()] + [r.text for r in spark.read.parquet(f"{DATA}/documents.parquet").limit(60).collect()]
    texts += ["a b c a b c", "a a a a", "a a a", "x\n\nx\n x\nx", "\x1c a\x85b \xa0"]
    for text in texts:
        assert Q.measure_text(text)[:5] == slow(text)


def test_tail_is_exact():
    for k, n, p in ((0, 10, 0.1), (3, 50, 0.05), (10, 100, 0.02), (49, 50, 0.5), (12, 2000, 0.01), (5, 5, 0.2)):
        want = sum(comb(n, i) * p**i * (1 - p) ** (n - i) for i in range(k + 1))
        assert abs(Q.binomial_tail(k, n, p) - want) < 1e-9
    assert Q.binomial_tail(0, 10**8, 1e-6) < 1e-40


def test_cutoffs_stop_at_the_first_that_is_not_certified():
    n = len(Q.GRID)
    bad = list(range(10, 10 + n))
    assert Q.select_cutoff([0] * n, bad, 2000, 0.01, 0.001) == Q.GRID[-1]
    good = [0] * 5 + [1000] + [0] * (n - 6)  # counts are cumulative in use; here only the order matters
    assert Q.select_cutoff(good, bad, 2000, 0.01, 0.001) == Q.GRID[4]
    assert Q.select_cutoff([0] * n, bad, 100, 0.01, 0.001) is None  # too few to certify
    assert Q.select_cutoff([0] * n, [0] * n, 2000, 0.01, 0.001) is None  # nothing to gain


def test_learns_a_rule_where_labels_support_it(spark):
    prose = " ".join(f"word{i}" for i in range(60))
    junk = " ".join(f"word{i}###" for i in range(60))
    rows = [(i, prose + f" {i}", "en") for i in range(900)] + [(i, junk + f" {i}", "en") for i in range(900, 1000)]
    rows += [(i, junk + f" {i}", "de") for i in range(1000, 1010)]  # a stratum without labels
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(i, int(i < 900)) for i in range(1000)], "doc_id long, quality int")
    chosen = Q.learn(docs, labels)
    assert [r.stratum for r in chosen.collect()] == ["en"]
    judged = Q.judge(docs, chosen)
    assert {r.doc_id for r in judged.where("kept").collect()} == {*range(900), *range(1000, 1010)}


def test_odd_rows(spark, odd, none):
    labels = spark.createDataFrame([(1, 1), (1, 0), (2, None), (None, 1)], "doc_id long, quality int")
    judged = Q.judge(odd, Q.learn(odd, labels))
    assert judged.count() == odd.count() and "kept__" in judged.columns  # kept and KEPT_ are taken
    assert all(r.base_failed and not r.kept__ for r in judged.collect() if (r.text or "").strip() == "")
    assert Q.judge(none, Q.learn(none, labels)).count() == 0
    assert Q.judge(odd, Q.learn(odd, labels.limit(0))).count() == odd.count()


def test_query_equals_brute_force(spark):
    rows = {r.doc_id: r for r in Q.query(spark, DATA).collect()}
    docs = spark.read.parquet(f"{DATA}/documents.parquet").collect()
    assert len(rows) == len(docs)
    for d in docs:
        r, want = rows[d.doc_id], slow(d.text)
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == want
        assert r.base_failed == (want[0] < 50 or 100 * want[4] > 50 * want[0])
        assert not (r.kept and r.base_failed)
