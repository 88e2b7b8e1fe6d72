import hashlib
import random

import public_tokenizers
import pytest
from conftest import DATA
from tokenizers import Tokenizer

from costmart.llm import bpe as B

FILE = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def both():
    return B.Tokenizer(FILE), Tokenizer.from_file(FILE)


def want(reference, text):
    ids = reference.encode(text or "", add_special_tokens=False).ids
    decoded = reference.decode(ids, skip_special_tokens=False)
    return len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(decoded.encode()).hexdigest()


def test_equals_the_library_on_odd_texts(both, odd):
    own, reference = both
    rnd = random.Random(3)
    letters = [*" \n\t  abAB1'é.,<|>ßΣςİ字🎉ẞǅ", "é", "\x1c", "\x85", " ", "​", "﻿", "<|endoftext|>", "<|startoftext|>", "'s", "I'VE", "ﬁ"]
    texts = ["".join(rnd.choice(letters) for _ in range(rnd.randint(0, 25))) for _ in range(3000)] + [r.text for r in odd.collect()]
    for text in texts:
        assert own.digest(text or "") == want(reference, text)
        assert list(own.encode(text or "")) == reference.encode(text or "", add_special_tokens=False).ids


def test_lookahead_is_sufficient_for_endless_words(both):
    own, reference = both
    rnd = random.Random(4)
    assert own.merges.lookahead < 1000
    for letters in ("ab", "a", "thein", "aeiou", "erinstan"):
        for size in (300, 4000):
            word = "".join(rnd.choice(letters) for _ in range(size))
            assert list(own.encode(word)) == reference.encode(word, add_special_tokens=False).ids
            symbols = list(own._symbols(word))
            assert list(own.merges.stream(symbols, hold=own.merges.lookahead + 2)) == own.merges.merge(symbols)


def test_lookahead_of_a_small_list():
    # "a" before "bc" is decided only once "bcd" is known: two letters behind the end of "a".
    merges = B.Merges([("b", "c"), ("a", "b")])
    assert merges.lookahead == 2
    assert merges.merge(list("abc")) == ["a", "bc"] and merges.merge(list("abd")) == ["ab", "d"]


def test_query_equals_the_library(spark, odd, none, both):
    docs = {d.doc_id: d.text for d in spark.read.parquet(f"{DATA}/documents.parquet").collect()}
    found = {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in B.query(spark, DATA).collect()}
    assert found == {i: want(both[1], t) for i, t in docs.items()}
    assert B.encode_documents(odd).count() == odd.count() and B.encode_documents(none).count() == 0


def test_every_word_goes_through_the_transducer(spark):
    """Symbols taken in are the bytes of the different words, and each text's ids are what came out."""
    texts = [r.text for r in spark.read.parquet(f"{DATA}/documents.parquet").select("text").collect()]
    own = B.Tokenizer(FILE)
    before = B.Transducer.steps
    for text in texts:
        own.digest(text)
    taken = B.Transducer.steps - before
    words = {m.group() for t in texts for w in B._ascii_words(t) for m in own.pattern.finditer(own.normalize(w))}
    assert taken >= sum(len(w.encode()) for w in words) > 0
    own.digest(texts[0])
    assert B.Transducer.steps - before == taken  # known words are not run again


@pytest.mark.parametrize("letters", ["ab", "thein", "aé字ß", "12", "a1", "!?#", "ab'", "Σσ", "가각", "é"])
def test_endless_texts_take_constant_memory(both, letters, monkeypatch):
    import tracemalloc

    own, reference = both
    rnd = random.Random(6)
    monkeypatch.setattr(B, "READ", 512)
    text = "".join(rnd.choice(letters) for _ in range(9000)) + " end"
    assert own.digest(text) == want(reference, text)
    assert list(own.encode(text)) == reference.encode(text, add_special_tokens=False).ids
    if letters == "thein":
        peaks = []
        for size in (100_000, 400_000):
            long = "".join(rnd.choices(letters, k=size))
            tracemalloc.start()
            own.digest(long)
            peaks.append(tracemalloc.get_traced_memory()[1])
            tracemalloc.stop()
            run, most = B.Transducer(own.merges), 0
            for at in range(0, len(long), 1000):
                list(run.feed(own._letters(long[at : at + 1000])))
                most = max(most, len(run.buffer))
            assert most <= run.hold == 4 * run.far
        assert peaks[1] < peaks[0] + 600_000  # the slice of the text itself, and no ids


def test_byte_decoder_is_incremental():
    path = public_tokenizers.path("byte_bpe_50k.json")
    reference, own = Tokenizer.from_file(path), B.decoder(path)
    assert own.byte_level
    for text in ("Ünïcödé 字典 🎉🎉 ẞ é", "\x00\x7f ​", "🎉" * 50, "plain", ""):
        ids = reference.encode(text, add_special_tokens=False).ids
        pieces = list(own.decode(ids))
        assert "".join(pieces) == text and "�" not in "".join(pieces)
        assert not text.startswith("🎉") or "" in pieces[:-1]  # an id within a character gives nothing yet
    ids = reference.encode("🎉", add_special_tokens=False).ids
    broken = [*ids[:-1], 50256, *ids[:-1]]
    assert "".join(own.decode(broken)) == "�<|endoftext|>�" == reference.decode(broken, skip_special_tokens=False).replace("��", "�")
