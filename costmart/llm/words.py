"""Encoding by a public tokenizer, with the pieces between blanks looked up instead of encoded again.

The vocabularies here split text before merging, and never within what lies between the start of a run
of blanks and the start of the next. So a text can be cut there, and each piece encoded once per worker.
That holds for ASCII blanks next to other characters; texts with other blanks or with control
characters that some libraries count as blanks are encoded as a whole.
"""

from __future__ import annotations

import json
import os
import re
from array import array
from functools import lru_cache

import numpy as np

from costmart.llm.bpe import byte_letters

# Pieces that each of the two generations of a worker's cache keeps.
CACHE_PIECES = 1 << 18
_LONGEST = 64

_PIECE = re.compile("[\t-\r ]*[^\t-\r ]+|[\t-\r ]+")
_OTHER_BLANK = re.compile("[\x1c-\x1f\x85\xa0\u1680\u180e\u2000-\u200f\u2028\u2029\u202f\u205f\u3000\ufeff]")
_SPECIAL = re.compile(r"<\|(?:start|end)oftext\|>")
# Plain pieces: one blank at most, Latin letters in composed form, then marks that no pattern joins to letters.
_LETTERS = "A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u012f\u0131-\u024f"
_PLAIN = re.compile(f"( ?[{_LETTERS}]+)([.,!?;:|#*$%&]*)")
# Plain texts: such letters, printable ASCII and blanks. What stands between letters and blanks there, one
# expression for marks alone (it starts with a set of characters, which is searched fast), one with digits and endings.
_NOT_PLAIN = re.compile(f"[^\t-\r -~{_LETTERS}]")
_MARKS = re.compile(r"([!-@\[-`{-~][!-@\[-`{-~]*)")
_NOT_SIMPLE = re.compile(f"[^\n !-&(-/:-~{_LETTERS}]")  # plain texts without digits, quotes and rare blanks
_PARTS = re.compile(r"('(?:s|t|re|ve|m|ll|d)|[0-9]|[!-/:-@\[-`{-~]+)")
_RARE_BLANK = re.compile("[\t-\r]")


_ASCII_BLANK = "\t\n\x0b\x0c\r "
_LONG = 1000  # longer pieces go alone


def ranked_encoding(model: dict):
    """A byte-level BPE model as ranks for tiktoken, several times as fast, where ids are in the order of merges."""
    merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
    if any(model["vocab"].get(a + b) != 256 + n for n, (a, b) in enumerate(merges)):
        return None
    import public_tokenizers
    import tiktoken

    byte = {c: b for b, c in enumerate(byte_letters())}
    ranks = {bytes(byte[c] for c in token): i for token, i in model["vocab"].items()}
    return tiktoken.Encoding("ranked", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def ended_encoding(model: dict):
    """A byte-level BPE model that marks ends of words, as ranks for tiktoken, where ids are in the order of merges.

    A word ends in NUL, which joins the byte before it ahead of all merges. What is between words is left out.
    """
    merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
    vocab, end = model["vocab"], model["end_of_word_suffix"]
    if not end or len(vocab) != 512 + len(merges) or any(vocab.get(a + b) != 512 + n for n, (a, b) in enumerate(merges)):
        return None
    import tiktoken

    byte = {c: b for b, c in enumerate(byte_letters())}
    ranks = {bytes(byte[c] for c in token.removesuffix(end)) + b"\0" * token.endswith(end): i for token, i in vocab.items()}
    return tiktoken.Encoding("ended", pat_str="[^\0]+\0", mergeable_ranks=ranks, special_tokens={})


class Encoder:
    """A tokenizers file as a function from text to ids, as little-endian unsigned 32-bit integers."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the parallelism
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_padding()
        self.tokenizer.no_truncation()
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        # The library's model takes plain pieces directly, past the steps that split and normalize texts.
        with open(path, encoding="utf-8") as source:
            spec = json.load(source)
        steps = [k["type"] for k in (spec["normalizer"] or {}).get("normalizers", [])]
        self.folds = steps == ["NFC", "Replace", "Lowercase"]  # drops blanks, too
        self.plain = _PLAIN if self.folds or spec["normalizer"] is None and spec["pre_tokenizer"]["type"] == "ByteLevel" else None
        self.letters = dict(enumerate(byte_letters()))
        self.model = self.tokenizer.model
        self.ranked = None if self.folds or not self.plain else ranked_encoding(spec["model"])
        self.ended = ended_encoding(spec["model"]) if self.folds else None
        if self.ranked:
            token_of = sorted(spec["model"]["vocab"].items(), key=lambda t: t[1])
            self.size = np.array([len(token) for token, _ in token_of])  # one letter per byte

    def _merge(self, piece: str) -> bytes:
        """Ids of one word or one run of marks, by the library's model alone."""
        if self.folds:
            piece = piece.lstrip(" ").lower()
        if not piece:
            return b""
        symbols = piece.encode().decode("latin-1").translate(self.letters)
        return np.array([t.id for t in self.model.tokenize(symbols)], "<u4").tobytes()

    def _encode(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def _learn(self, pieces: list[str], out: list[bytes | None]) -> None:
        """Fill the gaps of out from the older generation, then from the tokenizer."""
        if len(self.known) > CACHE_PIECES:
            self.older, self.known = self.known, {}
        hard = []
        for i, found in enumerate(out):
            if found is None:
                piece = pieces[i]
                found = self.known.get(piece) or self.older.get(piece)
                if found is None and self.plain and not self.ranked and (parts := self.plain.fullmatch(piece)):
                    word, marks = parts.groups()
                    found = self.known.get(word) or self.older.get(word) or self._merge(word)
                    if marks:
                        self.known.setdefault(word, found)
                        found += self.known.get(marks) or self.known.setdefault(marks, self._merge(marks))
                if found is None:
                    hard.append(i)
                else:
                    self._keep(piece, found)
                    out[i] = found
        missing = list(dict.fromkeys(pieces[i] for i in hard))
        if self.ranked and (joined := [p for p in missing if p[0] in _ASCII_BLANK and p[-1] not in _ASCII_BLANK and len(p) < _LONG]):
            new = dict(zip(joined, self._together(joined)))
            for i in hard:
                if (found := new.get(pieces[i])) is not None:
                    out[i] = found
                    self._keep(pieces[i], found)
            hard = [i for i in hard if out[i] is None]
            missing = [p for p in missing if p not in new]
        if not missing:
            return
        encoded = self.tokenizer.encode_batch_fast(missing, add_special_tokens=False)
        new = {p: np.array(e.ids, "<u4").tobytes() for p, e in zip(missing, encoded)}
        for i in hard:
            out[i] = new[pieces[i]]
            self._keep(pieces[i], out[i])

    def _together(self, pieces: list[str]) -> list[bytes]:
        """Ids of pieces that can stand one behind the other, from one call for all of them."""
        ids = self.ranked.encode_to_numpy(" x" + "".join(pieces))[1:]
        borders = np.cumsum([len(p) if p.isascii() else len(p.encode()) for p in pieces])
        cuts = (4 * np.searchsorted(np.cumsum(self.size[ids]), borders, "right")).tolist()
        data = ids.astype("<u4").tobytes()
        return [data[a:b] for a, b in zip([0, *cuts], cuts)]

    def _keep(self, piece: str, found: bytes) -> None:
        if len(piece) <= _LONGEST:
            self.known[piece] = found

    def _plain_text(self, text: str, marks: re.Pattern) -> bytes:
        """Ids of a plain text from one call: its words, runs of marks, digits and endings, each closed by NUL."""
        text = "\0".join(marks.split(text.lower())).replace(" ", "\0").replace("\n", "\0")
        return array("I", self.ended.encode_ordinary(text + "\0")).tobytes()

    def ids(self, text: str) -> bytes:
        if self.ended and not _SPECIAL.search(text):
            if not _NOT_SIMPLE.search(text):
                return self._plain_text(text, _MARKS)
            if not _NOT_PLAIN.search(text):
                return self._plain_text(_RARE_BLANK.sub(" ", text), _PARTS)
        if _OTHER_BLANK.search(text) or _SPECIAL.search(text):
            return self._encode(text)
        pieces = _PIECE.findall(text)
        out = list(map(self.known.get, pieces))
        if None in out:
            self._learn(pieces, out)
        return b"".join(out)


@lru_cache(maxsize=4)
def encoder(path: str) -> Encoder:
    """One encoder per file and worker process."""
    return Encoder(path)
