"""Operator 7: BPE as a streaming transducer with bounded lookahead, and its decoder.

Encoding. A merge list decides how far to the right of a token's end a letter can still change that
token: only through a chain of merges, each starting where the one before ends, with falling rank (an earlier
merge must come first to take the shared token away). The longest such chain, found by one pass over the
merges in rank order, is the sufficient lookahead. The encoder holds a buffer of the current word; when a
token's end is at least that far from the end of the buffer, it is final and is emitted, and merging goes on
behind it. So memory is constant however long a word or text is. Every text goes through this transducer, word
by word, as a word's end is a point where all is final. A run from the first state to the end of a word gives
the same each time, so a worker keeps the outcome for words it has seen, up to a bound.

Before merging, text is normalized and cut into words as the tokenizer file says: special tokens, NFC, lower
case letter by letter, pattern. Blanks separate words in this vocabulary, so the text is read in pieces that
end at blanks; where none is near, a piece ends inside a word, and the transducer goes on with the next piece.

Decoding is a state machine from ids to text. With a byte-level decoder it feeds bytes to an incremental
UTF-8 decoder; a file without a decoder yields token strings joined by blanks, as its library does.

Defined results: NULL texts are empty; empty and blank texts have no ids and decode to the empty string.
Repeated rows are encoded each. Extra columns are ignored. An empty table gives no rows.
"""

from __future__ import annotations

import codecs
import hashlib
import heapq
import json
import unicodedata
from collections.abc import Iterable, Iterator
from functools import lru_cache
from itertools import batched

import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from costmart.llm.frames import table

READ = 1 << 16
CACHE_WORDS = 1 << 18
_LONGEST = 64
_BLANKS = "\t\n\x0b\x0c\r "


def byte_letters() -> list[str]:
    """The printable letter of each byte in byte-level vocabularies: itself, or the next free one from 256."""
    plain = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    free = iter(range(256, 512))
    return [chr(b) if b in set(plain) else chr(next(free)) for b in range(256)]


class Merges:
    """Ranked merges over token strings, their sufficient lookahead, and the transducer itself."""

    def __init__(self, merges: Iterable[tuple[str, str]]):
        self.rank = {pair: i for i, pair in enumerate(merges)}
        self.lookahead = self._lookahead()

    def _lookahead(self) -> int:
        """The most letters behind a token's end that can change the token.

        reach[t] is the longest chain that starts at the end of t through merges seen so far; inner[t]
        the longest that could have kept t from being built: through the right part of t, before its rank.
        """
        reach: dict[str, int] = {}
        inner: dict[str, int] = {}
        built: set[str] = set()
        for left, right in self.rank:
            length = len(right) + max(reach.get(right, 0), inner.get(right, 0))
            token = left + right
            if token not in built:
                built.add(token)
                inner[token] = max(reach.get(right, 0), inner.get(right, 0))
            reach[left] = max(reach.get(left, 0), length)
        return max([1, *reach.values(), *inner.values()])

    def merge(self, letters: list[str]) -> list[str]:
        """Merge a sequence of symbols: always the pair of least rank, the leftmost of equals."""
        rank, n = self.rank, len(letters)
        if n < 2:
            return letters
        if n <= 32:  # short words: scanning beats a heap
            parts, none = list(letters), len(rank)
            ranks = [rank.get(pair, none) for pair in zip(parts, parts[1:])]
            while ranks and (least := min(ranks)) < none:
                i = ranks.index(least)
                parts[i] += parts.pop(i + 1)
                del ranks[i]
                if i:
                    ranks[i - 1] = rank.get((parts[i - 1], parts[i]), none)
                if i < len(ranks):
                    ranks[i] = rank.get((parts[i], parts[i + 1]), none)
            return parts
        symbols: list[str | None] = list(letters)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(rank[p], i, p) for i, p in enumerate(zip(letters, letters[1:])) if p in rank]
        heapq.heapify(heap)
        while heap:
            _, i, (left, right) = heapq.heappop(heap)
            j = after[i]
            if symbols[i] != left or j >= n or symbols[j] != right:
                continue
            symbols[i], symbols[j] = left + right, None
            after[i] = after[j]
            if after[i] < n:
                before[after[i]] = i
                if (pair := (symbols[i], symbols[after[i]])) in rank:
                    heapq.heappush(heap, (rank[pair], i, pair))
            if (k := before[i]) >= 0 and (pair := (symbols[k], symbols[i])) in rank:
                heapq.heappush(heap, (rank[pair], k, pair))
        return [s for s in symbols if s is not None]

    def stream(self, symbols: Iterable[str], hold: int | None = None) -> Iterator[str]:
        """Tokens of a whole word, whose last symbol carries the end-of-word mark if there is one."""
        run = Transducer(self, hold)
        yield from run.feed(list(symbols))
        yield from run.close(mark=False)

    suffix = ""

    def symbols_of(self, token: str) -> int:
        return len(token) - len(self.suffix) if self.suffix and token.endswith(self.suffix) else len(token)


class Transducer:
    """One word on its way through the merges: symbols go in, tokens come out as soon as nothing can change them.

    The state is a buffer of `hold` symbols at most, or twice the longest token. The last symbol is held back,
    as it becomes another one if the word ends there.
    """

    steps = 0  # symbols taken in by all words of this process

    def __init__(self, merges: Merges, hold: int | None = None):
        self.merges = merges
        self.far = merges.lookahead + 1
        self.hold = max(hold or 4 * self.far, self.far + 1)
        self.buffer: list[str] = []

    def feed(self, symbols: list[str]) -> Iterator[str]:
        """Tokens that have become final with these symbols."""
        Transducer.steps += len(symbols)
        buffer, at = self.buffer, 0
        while len(buffer) + len(symbols) - at >= self.hold:
            taken = self.hold - len(buffer)
            buffer += symbols[at : at + taken]
            at += taken
            end = 0
            for part in self.merges.merge(buffer):
                size = self.merges.symbols_of(part)
                if end + size > len(buffer) - self.far:
                    break
                end += size
                yield part
            del buffer[:end]
            if not end:  # a token longer than the buffer: wait for more
                self.hold *= 2
        buffer += symbols[at:]

    def run(self, symbols: list[str]) -> list[str]:
        """Tokens of a whole word, the last symbol marked: where it fits the buffer, all come at its end."""
        if len(symbols) < self.hold:
            Transducer.steps += len(symbols)
            return self.merges.merge(symbols)
        return [*self.feed(symbols), *self.close(mark=False)]

    def close(self, mark: bool = True) -> list[str]:
        """The word's last tokens, once its last symbol is marked as its end."""
        if mark and self.buffer:
            self.buffer[-1] += self.merges.suffix
        return self.merges.merge(self.buffer)


class Decoder:
    """From ids to text, by a state machine that holds at most one unfinished character."""

    def __init__(self, spec: dict):
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.strings = {i: t for t, i in {**spec["model"]["vocab"], **self.special}.items()}
        self.byte_level = bool(spec.get("decoder"))
        self.byte = {c: b for b, c in enumerate(byte_letters())}

    def decode(self, ids: Iterable[int]) -> Iterator[str]:
        """Text pieces, each complete with the id that ends it."""
        if not self.byte_level:
            blank = ""
            for i in ids:
                yield blank + self.strings[i]
                blank = " "
            return
        state = codecs.getincrementaldecoder("utf-8")("replace")
        for i in ids:
            token = self.strings[i]
            if token in self.special:
                yield state.decode(b"", True) + token
                state.reset()
            else:
                yield state.decode(bytes(self.byte[c] for c in token))
        yield state.decode(b"", True)


def decoder(path: str) -> Decoder:
    with open(path, encoding="utf-8") as source:
        return Decoder(json.load(source))


class Tokenizer:
    """A BPE tokenizer file: normalization, words, merges, ids and decoding."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as source:
            spec = json.load(source)
        model = spec["model"]
        self.vocabulary: dict[str, int] = model["vocab"]
        self.suffix = model.get("end_of_word_suffix") or ""
        self.merges = Merges(tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"])
        self.merges.suffix = self.suffix
        if self.suffix:
            self.merges.lookahead += len(self.suffix)  # lengths count the suffix's letters too
        self.decoder = Decoder(spec)
        special = self.special = self.decoder.special
        self._special = regex.compile("|".join(map(regex.escape, sorted(special, key=len, reverse=True)))) if special else None
        kinds = spec.get("normalizer") or {}
        kinds = kinds.get("normalizers", [kinds] if kinds else [])
        known = {"NFC", "Replace", "Lowercase"}
        if not {k["type"] for k in kinds} <= known or (spec["pre_tokenizer"] or {}).get("type") != "Sequence":
            raise ValueError(f"{path}: only files that drop blanks between words are supported")
        self.normal = [k["type"] for k in kinds]
        self.pattern = regex.compile(spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"])
        self.letter = byte_letters()
        self._words: dict[str, list[int]] = {}
        # Two generations of results: what is asked for again moves to the younger one.
        self._known: dict[str, tuple[int, str, str]] = {}
        self._older: dict[str, tuple[int, str, str]] = {}

    def normalize(self, text: str) -> str:
        if "NFC" in self.normal and not text.isascii():
            text = unicodedata.normalize("NFC", text)
        if "Lowercase" in self.normal:
            # Letter by letter: a final sigma is lower-cased like any other.
            text = text.lower() if "Σ" not in text else "".join(c.lower() for c in text)
        return text

    def _letters(self, part: str) -> list[str]:
        letter = self.letter
        return [letter[b] for b in part.encode()]

    def _symbols(self, word: str) -> list[str]:
        """The byte letters of a word; the last carries the end-of-word mark."""
        letters = self._letters(word)
        letters[-1] += self.suffix
        return letters

    def _word(self, word: str) -> list[int]:
        """Ids of a whole word: the transducer run from its first state to the word's end, kept for the next time."""
        if (found := self._words.get(word)) is None:
            found = [self.vocabulary[t] for t in Transducer(self.merges).run(self._symbols(word))]
            if len(word) <= _LONGEST:
                if len(self._words) > CACHE_WORDS:
                    self._words.clear()
                self._words[word] = found
        return found

    def _pieces(self, text: str, start: int, end: int) -> Iterator[tuple[str, bool]]:
        """(piece, whether it goes on without a break) of a text, READ letters long or little more.

        Pieces end where a blank follows. Where none is near, they end between two letters that neither normalizing
        nor the words' pattern joins in any other way than as letters of one word.
        """
        while start < end:
            cut, inner = min(end, start + READ), False
            while cut < end and text[cut] not in _BLANKS:
                if cut - start >= READ + _NEAR and _parts(text, cut, end):
                    inner = True
                    break
                cut += 1
            yield text[start:cut], inner
            start = cut

    def _ids(self, text: str, start: int, end: int) -> Iterator[int]:
        """Ids of a range of a text, each as soon as it is final."""
        run, kind = None, ""
        for piece, inner in self._pieces(text, start, end):
            words = [m.group() for m in self.pattern.finditer(self.normalize(piece))]
            for n, word in enumerate(words):
                if run and not (n == 0 and kind == _kind(word)):
                    yield from map(self.vocabulary.__getitem__, run.close())
                    run = None
                if run or (inner and n == len(words) - 1 and _kind(word) != "N"):
                    run, kind = run or Transducer(self.merges), _kind(word)
                    yield from map(self.vocabulary.__getitem__, run.feed(self._letters(word)))
                else:
                    yield from self._word(word)
            if run and not inner:
                yield from map(self.vocabulary.__getitem__, run.close())
                run = None

    def encode(self, text: str) -> Iterator[int]:
        """The ids of a whole text, as they become final."""
        at = 0
        for found in self._special.finditer(text) if self._special else ():
            yield from self._ids(text, at, found.start())
            yield self.special[found.group()]
            at = found.end()
        yield from self._ids(text, at, len(text))

    def decode(self, ids: Iterable[int]) -> Iterator[str]:
        return self.decoder.decode(ids)

    def _seen(self, word: str) -> tuple[int, str, str]:
        """Number of ids, ids and decoded text of what lies between two blanks, kept for the next time."""
        if (found := self._older.get(word)) is None:
            if len(word) > READ or self._special and self._special.search(word):
                ids = list(self.encode(word))
            else:
                ids = [i for w in self.pattern.findall(self.normalize(word)) for i in self._word(w)]
            found = len(ids), " ".join(map(str, ids)), "".join(self.decode(ids))
        if len(word) <= _LONGEST:
            if len(self._known) > CACHE_WORDS:
                self._older, self._known = self._known, {}
            self._known[word] = found
        return found

    def digest(self, text: str) -> tuple[int, str, str]:
        """(n_tokens, SHA-256 of the ids, SHA-256 of the decoded text), fed as ids become final.

        For files that drop blanks and join token strings: what stands between blanks is independent, so the
        transducer's output for it can be kept. A stretch without blanks is fed id by id.
        """
        ids_sum, text_sum, total = hashlib.sha256(), hashlib.sha256(), 0
        for chunk in self._stretches(text):
            if len(chunk) > READ + 2 * _NEAR:
                for ids in batched(self.encode(chunk), 1 << 12):
                    blank = " " if total else ""
                    ids_sum.update((blank + " ".join(map(str, ids))).encode())
                    text_sum.update((blank + "".join(self.decode(ids))).encode())
                    total += len(ids)
                continue
            words = chunk.split() if chunk.isascii() and not _odd(chunk) else _ascii_words(chunk)
            found = [self._known.get(w) or self._seen(w) for w in words]
            found = [f for f in found if f[0]]
            if found:
                blank = " " if total else ""
                ids_sum.update((blank + " ".join([f[1] for f in found])).encode())
                text_sum.update((blank + " ".join([f[2] for f in found])).encode())
                total += sum([f[0] for f in found])
        return total, ids_sum.hexdigest(), text_sum.hexdigest()

    def _stretches(self, text: str) -> Iterator[str]:
        """About READ letters at a time, up to a blank; alone where no blank is near."""
        start = 0
        while start < len(text):
            end = min(len(text), start + READ)
            while end < len(text) and text[end] not in _BLANKS:
                end += 1
            yield text[start:end]
            start = end


# Letters on either side of a cut that must be free of marks which the words' pattern reads together.
_NEAR = 24
_MARKS = regex.compile(r"['<>|\s]")


def _parts(text: str, cut: int, end: int) -> bool:
    """Whether a text without blanks can be cut here: the letter behind never merges with one before it when
    normalized, and no contraction or special token is near."""
    c = text[cut]
    if unicodedata.category(c)[0] not in "LNPS" or "\u1100" <= c <= "\u11ff":
        return False
    return not _MARKS.search(text, max(0, cut - _NEAR), min(end, cut + _NEAR))


_LETTER, _DIGIT = regex.compile(r"\p{L}"), regex.compile(r"\p{N}")


def _kind(word: str) -> str:
    return "L" if _LETTER.match(word) else "N" if _DIGIT.match(word) else "M"


_ODD = regex.compile("[\x1c-\x1f]")
_ASCII_WORD = regex.compile(f"[^{_BLANKS}]+")


def _odd(text: str) -> bool:
    """Whether Python would split a text at characters that are no blanks to the tokenizer."""
    return bool(_ODD.search(text))


def _ascii_words(text: str) -> list[str]:
    return [w.decode() for w in text.encode().split()]


@lru_cache(maxsize=4)
def tokenizer(path: str) -> Tokenizer:
    """One tokenizer per file and worker process."""
    return Tokenizer(path)


_RESULT = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids_sha256", pa.string()), ("decoded_sha256", pa.string())])
RESULT_SCHEMA = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"


def encode_documents(docs: DataFrame, path: str | None = None) -> DataFrame:
    """doc_id, n_tokens and the digests of the ids and of the text decoded from them."""
    file = path or public_tokenizers.path("word_bpe_49k.json")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digest = tokenizer(file).digest
        for batch in batches:
            rows = [(d, *digest(t.as_py() or "")) for d, t in zip(batch.column(0).to_pylist(), batch.column(1))]
            columns = zip(*rows) if rows else [[]] * len(_RESULT)
            yield pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(columns, _RESULT)], schema=_RESULT)

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, RESULT_SCHEMA)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_documents(table(spark, sf_dir, "documents"))
