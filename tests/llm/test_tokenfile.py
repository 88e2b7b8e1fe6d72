import random
import time
import zlib

import numpy as np
import public_tokenizers
import pytest
from conftest import DATA
from tokenizers import Tokenizer

from costmart.llm import tokenfile as T
from costmart.llm.words import Encoder
from costmart.session import scratch_path

FILE = public_tokenizers.path("word_bpe_49k.json")


def test_round_trips():
    rng = np.random.default_rng(0)
    for n in (0, 1, 5, 2047, 2048, 2049, 30_000):
        for ids in (rng.integers(0, 49_409, n), rng.zipf(1.3, n) % 49_409, np.full(n, 7), np.arange(n) % 49_409, np.arange(n) % 3):
            coded, sums = T.encode_blocks(ids.astype("<u4"))
            assert (T.decode_blocks(coded, n, sums) == ids).all()


def test_blocks_are_independent_and_checked():
    ids = (np.arange(6000) * 31 % 997).astype("<u4")
    coded, sums = T.encode_blocks(ids)
    assert len(coded) == 3
    alone = T.decode_blocks([coded[1]], T.BLOCK, [sums[1]])
    assert (alone == ids[T.BLOCK : 2 * T.BLOCK]).all()
    broken = bytearray(coded[1])
    broken[-40] ^= 255
    with pytest.raises(ValueError, match="checksum"):
        T.decode_blocks([coded[0], bytes(broken), coded[2]], 6000, sums)


def test_predictions_help():
    rng = np.random.default_rng(2)
    pattern = np.tile(rng.integers(0, 49_409, 50), 200).astype("<u4")
    coded, _ = T.encode_blocks(pattern)
    assert 8 * sum(map(len, coded)) / len(pattern) < 2


def test_sums_join():
    a, b = b"abc" * 5, b"defgh" * 500_000
    assert T.join_sums(zlib.crc32(a), zlib.crc32(b), len(b)) == zlib.crc32(a + b)


def want(rows):
    reference, out, at = Tokenizer.from_file(FILE), [], 0
    for doc_id, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        ids = np.array([*reference.encode(text or "", add_special_tokens=False).ids, 1], "<u4")
        out.append((doc_id, at, len(ids), zlib.crc32(ids.tobytes())))
        at += len(ids)
    return out


def test_query_equals_the_library(spark):
    docs = [(d.doc_id, d.text) for d in spark.read.parquet(f"{DATA}/documents.parquet").collect()]
    assert sorted(map(tuple, T.query(spark, DATA).collect())) == want(docs)


def test_odd_rows_and_frames_of_any_size(spark, odd, none):
    rows = [(r.doc_id, r.text) for r in odd.collect() if r.doc_id not in (None, 1)]
    for frame in (7, 100, 20_000):
        path = scratch_path(spark, "tokens-test")
        T.write_tokens(odd.where("doc_id > 1"), path, FILE, frame=frame)
        assert sorted(map(tuple, T.read_tokens(spark, path).collect())) == want(rows)
    path = scratch_path(spark, "tokens-test")
    T.write_tokens(odd, path, FILE)
    found = T.read_tokens(spark, path).collect()
    assert len(found) == odd.count() and len({r.start for r in found}) == len(found)
    path = scratch_path(spark, "tokens-test")
    T.write_tokens(none, path, FILE)
    assert T.read_tokens(spark, path).count() == 0


def test_coding_is_cheap():
    """Coder and decoder against a plain Python loop; it was about 50 turns of the loop an id, and is about 20."""
    ids = (np.random.default_rng(3).zipf(1.2, T.BLOCK << 11) % 49_409).astype("<u4")
    took = []
    for _ in range(2):
        began = time.thread_time()
        sum(range(10_000_000))
        loop = (time.thread_time() - began) / 10_000_000
        began = time.thread_time()
        coded, sums = T.encode_blocks(ids)
        assert (T.decode_blocks(coded, len(ids), sums) == ids).all()
        took.append((time.thread_time() - began) / len(ids) / loop)
    assert min(took) < 35


def test_blocks_of_one_id_of_all_ids_and_a_short_end():
    for ids in (np.full(3 * T.BLOCK, 7), np.arange(3 * T.BLOCK), np.arange(2 * T.BLOCK + 1) % 5, np.repeat([5, (1 << 21) - 1], 1500)):
        coded, sums = T.encode_blocks(ids.astype("<u4"))
        assert (T.decode_blocks(coded, len(ids), sums) == ids).all()
        end = len(ids) - (len(coded) - 1) * T.BLOCK
        assert (T.decode_blocks(coded[-1:], end, sums[-1:]) == ids[-end:]).all()


def test_broken_blocks_are_found():
    rng = random.Random(4)
    ids = (np.random.default_rng(5).zipf(1.3, 3 * T.BLOCK) % 49_409).astype("<u4")
    coded, sums = T.encode_blocks(ids)
    for _ in range(30):
        broken = list(map(bytearray, coded))
        for _ in range(rng.randint(1, 20)):
            block = rng.choice(broken)
            at = rng.randrange(4 + int.from_bytes(block[2:4], "little"), len(block))
            block[at] ^= rng.randint(1, 255)
        with pytest.raises(ValueError, match="checksum"):
            T.decode_blocks(list(map(bytes, broken)), len(ids), sums)


def test_plain_texts_go_in_one_call_and_equal_the_library():
    encoder, reference = Encoder(FILE), Tokenizer.from_file(FILE)
    letters = [chr(c) for c in (*range(0x41, 0x5B), *range(0x61, 0x7B), *range(0xC0, 0x250)) if c not in (0xD7, 0xF7, 0x130)]
    ends = [t.removesuffix("</w>") for t in reference.get_vocab() if t.isascii() and t.isprintable() and "<|" not in t]
    rng = random.Random(6)
    odd = "don't 'tis it'll 'ssss ''s '' 's's x's'VE'Re\t12 345th\r\n\x0b\x0ca1b2-_#<|>~` ".split(" ") + list("\t\n\x0b\x0c\r'9!~ ")
    texts = [" ".join(ends), "".join(letters), " ".join(letters), " ".join(f"{c}a b{c} 1{c}'{c}." for c in letters), "z" * 20_000]
    texts += ["".join(rng.choice(rng.choice((letters, ends, odd, [" "]))) for _ in range(40)) for _ in range(3000)]
    for text in texts:
        assert np.frombuffer(encoder.ids(text), "<u4").tolist() == reference.encode(text, add_special_tokens=False).ids, text
    assert not encoder.known  # no piece was looked up


def test_texts_that_are_not_plain_equal_the_library():
    encoder, reference = Encoder(FILE), Tokenizer.from_file(FILE)
    for text in ("a<|endoftext|>b", "<|startoftext|>", "e\u0301 i\u0307", "\u0130x", "a\u00a0b\u2003c", "a\x00b \x1c c", "\u03a3\u03c2 \u00d7\u00f7", "日本 plain", "", " "):
        assert np.frombuffer(encoder.ids(text), "<u4").tolist() == reference.encode(text, add_special_tokens=False).ids, text
