import zlib

import numpy as np
import public_tokenizers
from conftest import DATA
from tokenizers import Tokenizer

from costmart.llm import packing as P

FILE = public_tokenizers.path("byte_bpe_50k.json")


def check(pieces, docs):
    """Every id in one piece, sequences without gaps, sums equal; returns the padded share."""
    reference = Tokenizer.from_file(FILE)
    sequences, of_doc = {}, {}
    for r in pieces:
        sequences.setdefault(r.sequence_id, []).append(r)
        of_doc.setdefault((r.doc_id, r.doc_tokens), []).append(r)
    padding = total = 0
    for rows in sequences.values():
        at = 0
        for r in sorted(rows, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert 0 < at <= 1024
        padding += 0 if at & (at - 1) == 0 else 1024 - at
        total += at
    order = lambda x: tuple(-1 if v is None else v for v in x)
    want: dict = {}
    for doc_id, text in docs:
        ids = np.array([*reference.encode(text or "", add_special_tokens=False).ids, 0], "<u4")
        want.setdefault((doc_id, len(ids)), []).append(ids)
    assert want.keys() == of_doc.keys()
    for key, texts in want.items():
        # Each id in one piece: the pieces of repeated rows make up as many chains from 0 to the end.
        ends = sorted(r.start + r.length for r in of_doc[key])
        starts = sorted([r.start for r in of_doc[key]] + [key[1]] * len(texts))
        assert starts == sorted([0] * len(texts) + ends), key
        for r in of_doc[key]:
            assert any(zlib.crc32(ids[r.start : r.start + r.length].tobytes()) == r.ids_crc32 for ids in texts), key
    return padding / max(1, padding + total)


def test_whole_table_is_packed(spark):
    docs = [(d.doc_id, d.text) for d in spark.read.parquet(f"{DATA}/documents.parquet").collect()]
    assert check(P.query(spark, DATA).collect(), docs) < 0.01


def test_odd_rows(odd, none):
    docs = [(r.doc_id, r.text) for r in odd.collect()]
    check(P.pack_documents(odd).collect(), docs)
    assert P.pack_documents(none).count() == 0


def laid_out(made, counts):
    """Every id of every piece once, sequences without gaps; returns the padded share."""
    ids = {n: np.zeros((counts[n], n), np.int8) for n in np.flatnonzero(counts)}
    ends: dict = {}
    for p in made.places:
        ids[p.length][p.first : p.end] += 1
        for s in range(p.sequence, p.sequence + p.end - p.first):
            ends.setdefault(s, []).append((p.offset, p.length))
    for n, (first, _) in made.stream.items():
        for number in range(first, counts[n]):
            for low, high, sequence, offset in made.parts(n, number):
                ids[n][number, low:high] += 1
                ends.setdefault(sequence, []).append((offset, high - low))
    assert all((x == 1).all() for x in ids.values())
    padding = total = 0
    for parts in ends.values():
        at = 0
        for offset, size in sorted(parts):
            assert offset == at
            at += size
        assert at <= 1024
        total += at
        padding += 0 if at & (at - 1) == 0 else 1024 - at
    assert sorted(ends) == list(range(len(ends)))
    return padding / (padding + total)


def test_plans_use_every_id_once_and_pad_the_last_sequence_only():
    rng = np.random.default_rng(0)
    spread = np.bincount(rng.integers(1, 1025, 8_000), minlength=1025)
    hot = spread + np.bincount([700] * 4000, minlength=1025)
    odd = np.bincount([700] * 10 + [5] * 3, minlength=1025)
    for counts in (spread, hot, odd, *(np.bincount([n] * 999, minlength=1025) for n in (1, 3, 512, 513, 700, 1000, 1023, 1024))):
        share = laid_out(P.plan(counts), counts)
        total = int((np.arange(1025) * counts).sum())
        assert share <= 1024 / total


def test_plans_are_bounded_by_the_lengths():
    rng = np.random.default_rng(1)
    spread = np.bincount(rng.integers(1, 1025, 20_000), minlength=1025)
    sizes = [len(P.plan(spread * times).places) for times in (1, 1000, 10**6)]
    assert max(sizes) < 20_000
    assert len(P.plan(np.bincount([700], minlength=1025) * 10**12).stream) == 1


def test_least_squares_prefers_exact_fillings():
    counts = np.zeros(1025, np.int64)
    counts[[600, 424, 200, 400]] = 10, 10, 5, 5
    made = P.plan(counts)
    assert made.sequences >= 10  # filled by whole pieces
    laid_out(made, counts)


def test_hot_rests_are_cut(spark):
    """A third of the rows have one text; their rest fits badly, and so do others."""
    docs = [(n, "the same text again and again " * 130) for n in range(40)] + [(100 + n, "word " * (n * 17 % 900 + 1)) for n in range(80)]
    docs += [(3, docs[3][1]), (None, docs[50][1])]
    rows = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    pieces = P.pack_documents(rows).collect()
    assert check(pieces, docs) < 0.01
    assert any(r.start % 1024 for r in pieces)
    assert P.crc_of(P.narrow(np.array([1, 70_000, 3], "<u4").tobytes()), 3, 1, 3) == zlib.crc32(np.array([70_000, 3], "<u4").tobytes())
