"""Byte-level BPE over a contiguous rank array.

A word is its bytes, and a short array holds its parts in order, a second one the merge rank of each
adjacent pair. Each step scans ``ranks`` for the smallest
(leftmost if tied), deletes the boundary inside that pair and looks up the two neighbouring ranks
again. The arrays of all new words of a group of texts lie side by side as rows of a matrix, so a
step is a few vector operations for all of them. Words over ``SHORT_WORD`` bytes get the same
merges through a heap, as scanning them would cost the square of their length.

Vocabulary and merges come from a tokenizer file that the driver reads and broadcasts: its size
does not depend on the data. Words found before are kept per worker, at most ``KEPT_WORDS``.

Defined results: a null text is the empty text, which has no tokens. A text of any length is
encoded whole; it is cut into stretches only where no token can span the cut.
"""

from __future__ import annotations

import heapq
import json
import re
import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, SparkSession, functions as F

SHORT_WORD = 64
KEPT_WORDS = 300_000
STRETCH = 1 << 20
ID_BITS = 24
ID_MASK = (1 << ID_BITS) - 1
NO_RANK = 1 << 62
NO_PART = ID_MASK  # no id

# How byte-level BPE files split a text into words ({0} for letters, {1} for numbers).
WORDS = r"'s|'t|'re|'ve|'m|'ll|'d| ?[{0}]+| ?[{1}]+| ?[^\s{0}{1}]+|\s+(?!\S)|\s+"
# A cut before a single blank between two words falls on a token boundary.
CUT = re.compile(r"(?<=\S) (?=\S)")


def byte_letters() -> dict[str, int]:
    """The printable letter that stands for each byte in vocabulary files, and the byte back."""
    printable = [*range(ord("!"), ord("~") + 1), *range(0xA1, 0xAC + 1), *range(0xAE, 0xFF + 1)]
    others = [b for b in range(256) if b not in set(printable)]
    return {chr(b): b for b in printable} | {chr(256 + n): b for n, b in enumerate(others)}


def as_ranges(codes: list[int]) -> str:
    """Sorted code points as ranges of a character class."""
    first = [c for c, b in zip(codes, [-2, *codes]) if c != b + 1]
    last = [c for c, n in zip(codes, [*codes[1:], -2]) if c + 1 != n]
    return "".join(rf"\U{a:08x}-\U{b:08x}" for a, b in zip(first, last))


def unassigned_letters(same_word) -> str:
    """Letters and numbers that the regex library knows and a tokenizer of an older Unicode version does not, as ranges.

    ``same_word(text)`` tells if the tokenizer leaves the text in one piece.
    """
    letter, number = regex.compile(r"\p{L}"), regex.compile(r"\p{N}")
    young = (chr(c) for c in range(0x110000) if unicodedata.category(chr(c)) == "Cn")
    return as_ranges(
        [ord(c) for c in young if (letter.match(c) and not same_word("a" + c)) or (number.match(c) and not same_word("1" + c))]
    )


@dataclass(frozen=True)
class Vocabulary:
    """What workers need of a tokenizer file."""

    pieces: list[bytes]
    merges: dict[int, int]  # two ids, packed: rank and id of the whole, packed
    specials: dict[str, int]
    young: str  # ranges of letters that the tokenizer does not know

    @classmethod
    def load(cls, path: str) -> Vocabulary:
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as file:
            described = json.load(file)
        model, letters = described["model"], byte_letters()
        ids = model["vocab"]
        specials = {t["content"]: t["id"] for t in described.get("added_tokens", [])}
        pieces: list[bytes] = [b""] * (1 + max([*ids.values(), *specials.values()]))
        for piece, i in ids.items():
            pieces[i] = bytes(letters[c] for c in piece)
        for text, i in specials.items():
            pieces[i] = text.encode()
        pairs = (m if isinstance(m, list) else m.split(" ") for m in model["merges"])
        merges = {ids[a] << ID_BITS | ids[b]: rank << ID_BITS | ids[a + b] for rank, (a, b) in enumerate(pairs)}
        splitter = Tokenizer.from_file(path).pre_tokenizer
        return cls(pieces, merges, specials, unassigned_letters(lambda s: len(splitter.pre_tokenize_str(s)) == 1))

    @cached_property
    def byte_ids(self) -> list[int]:
        single = {p: i for i, p in enumerate(self.pieces) if len(p) == 1}
        return [single[bytes([b])] for b in range(256)]

    @cached_property
    def merge_table(self) -> tuple[np.ndarray, np.ndarray]:
        """The pairs in order, and rank and whole of each, for lookups of many pairs at once."""
        pairs = np.fromiter(self.merges, np.int64, len(self.merges))
        order = np.argsort(pairs)
        return pairs[order], np.fromiter(self.merges.values(), np.int64, len(self.merges))[order]

    @cached_property
    def word_pattern(self):
        return regex.compile(WORDS.format(r"\p{L}", r"\p{N}"))

    @cached_property
    def strict_pattern(self):
        """The same without the letters that the tokenizer does not know."""
        return regex.compile(WORDS.format(rf"[\p{{L}}--[{self.young}]]", rf"[\p{{N}}--[{self.young}]]"), regex.V1)

    @cached_property
    def young_pattern(self):
        return re.compile(f"[{self.young}]") if self.young else None

    @cached_property
    def latin_pattern(self):
        """The same for texts of code points below 256, with the classes written out; the re module is faster on those."""
        latin = [chr(c) for c in range(256)]
        listed = {k: "".join(rf"\x{ord(c):02x}" for c in latin if regex.match(k, c)) for k in (r"\p{L}", r"\p{N}", r"\s")}
        letter, number, blank = listed.values()
        pattern = WORDS.replace(r"\s+(?!\S)", rf"[{blank}]+(?![^{blank}])").replace(r"[^\s", rf"[^{blank}").replace(r"\s+", rf"[{blank}]+")
        return re.compile(pattern.format(letter, number))

    def words(self, text: str) -> list[str]:
        try:
            text.encode("latin-1")
        except UnicodeEncodeError:
            young = self.young_pattern is not None and self.young_pattern.search(text)
            return (self.strict_pattern if young else self.word_pattern).findall(text)
        return self.latin_pattern.findall(text)

    @cached_property
    def special_pattern(self):
        longest_first = sorted(self.specials, key=len, reverse=True)
        return re.compile("|".join(map(re.escape, longest_first))) if longest_first else None


def merge_short(words: list[bytes], vocabulary: Vocabulary) -> list[bytes]:
    """The ids of many words of up to SHORT_WORD bytes, packed as 32-bit numbers.

    One row per word: its part ids and, beside them, the ranks of adjacent parts. A step finds the
    smallest rank of each row, deletes the boundary there by moving the rest of the row up one
    place, and looks up the ranks to the left and right of the new part.
    """
    out: list[bytes] = [b""] * len(words)
    widths = np.array([max(1, len(w)) for w in words])
    byte_ids = np.array(vocabulary.byte_ids, dtype=np.int64)
    low = 0
    for width in (4, 8, 12, 16, 24, 32, 48, SHORT_WORD):
        places = np.flatnonzero((widths > low) & (widths <= width))
        low = width
        if not len(places):
            continue
        sizes = np.array([len(words[p]) for p in places])
        raw = np.frombuffer(b"".join(words[p].ljust(width, b"\0") for p in places), np.uint8).reshape(-1, width)
        ids = np.where(np.arange(width) < sizes[:, None], byte_ids[raw], NO_PART)
        ids = np.hstack([ids, np.full((len(places), 1), NO_PART)])
        ranks = _ranks(ids[:, :-1], ids[:, 1:], vocabulary)
        while len(places):
            best = ranks.argmin(1)
            least = ranks[np.arange(len(best)), best]
            open_ = least < NO_RANK
            for p, row, size in zip(places[~open_], ids[~open_].astype(np.int32), sizes[~open_]):
                out[p] = row[:size].tobytes()
            places, ids, ranks, best, least, sizes = (x[open_] for x in (places, ids, ranks, best, least, sizes))
            if not len(places):
                break
            row, column = np.arange(len(places)), np.arange(ids.shape[1] - 1)
            after = column > best[:, None]
            ids[:, :-1] = np.where(after, ids[:, 1:], ids[:, :-1])
            ids[:, -1] = NO_PART
            ids[row, best] = least & ID_MASK
            ranks[:, :-1] = np.where(after[:, :-1], ranks[:, 1:], ranks[:, :-1])
            ranks[:, -1] = NO_RANK
            sizes = sizes - 1
            ranks[row, best] = _ranks(ids[row, best], ids[row, best + 1], vocabulary)
            left = best > 0
            ranks[row[left], best[left] - 1] = _ranks(ids[row[left], best[left] - 1], ids[row[left], best[left]], vocabulary)
    return out


def _ranks(left: np.ndarray, right: np.ndarray, vocabulary: Vocabulary) -> np.ndarray:
    pairs, found = vocabulary.merge_table
    wanted = left << ID_BITS | right
    at = np.minimum(np.searchsorted(pairs, wanted), len(pairs) - 1)
    return np.where(pairs[at] == wanted, found[at], NO_RANK)


def merge_long(data: bytes, vocabulary: Vocabulary) -> list[int]:
    """The ids of one word of any length: the same merges, the next one from a heap."""
    rank_of = vocabulary.merges.get
    ids = list(map(vocabulary.byte_ids.__getitem__, data))
    size = len(ids)
    after, before = list(range(1, size + 1)), list(range(-1, size - 1))
    waiting: list[tuple[int, int, int, int]] = []

    def offer(i: int) -> None:
        if i >= 0 and after[i] < size:
            left, right = ids[i], ids[after[i]]
            if (rank := rank_of(left << ID_BITS | right)) is not None:
                heapq.heappush(waiting, (rank, i, left, right))

    for i in range(size):
        offer(i)
    while waiting:
        rank, i, left, right = heapq.heappop(waiting)
        j = after[i]
        if ids[i] != left or j >= size or ids[j] != right:
            continue  # one of the two has been merged since
        ids[i], ids[j] = rank & ID_MASK, -1
        after[i] = after[j]
        if after[i] < size:
            before[after[i]] = i
        offer(before[i])
        offer(i)
    return [i for i in ids if i >= 0]


class WordIds(dict):
    """Word to its packed ids, for the words met so far."""

    def __init__(self, vocabulary: Vocabulary) -> None:
        super().__init__()
        self.vocabulary = vocabulary

    def learn(self, words: set[str]) -> None:
        """Merge the words that are new, all short ones together."""
        fresh = list(words.difference(self))
        if len(self) + len(fresh) > KEPT_WORDS:
            self.clear()
            fresh = list(words)
        data = [w.encode() for w in fresh]
        short = [i for i, d in enumerate(data) if len(d) <= SHORT_WORD]
        for i, packed in zip(short, merge_short([data[i] for i in short], self.vocabulary)):
            self[fresh[i]] = packed
        for w, d in zip(fresh, data):
            if len(d) > SHORT_WORD:
                self[w] = np.array(merge_long(d, self.vocabulary), dtype=np.int32).tobytes()


def stretches(text: str) -> Iterator[str]:
    """The text in pieces of about STRETCH characters, cut between words and outside special tokens."""
    at = 0
    while len(text) - at > 2 * STRETCH and (cut := CUT.search(text, at + STRETCH)):
        yield text[at : cut.start()]
        at = cut.start()
    yield text[at:] if at else text


class Encoder:
    def __init__(self, vocabulary: Vocabulary) -> None:
        self.vocabulary = vocabulary
        self.known = WordIds(vocabulary)

    def packed(self, texts: list[str]) -> Iterator[bytes]:
        """Each text's ids as packed 32-bit numbers; a few texts at a time share the merging of new words."""
        group: list[str] = []
        size = 0
        for text in texts:
            group.append(text)
            size += len(text)
            if size >= STRETCH:
                yield from self._group(group)
                group, size = [], 0
        yield from self._group(group)

    def _group(self, texts: list[str]) -> Iterator[bytes]:
        if len(texts) == 1 and len(texts[0]) > 2 * STRETCH:
            yield b"".join(b"".join(self._some([piece])) for piece in stretches(texts[0]))
        else:
            yield from self._some(texts)

    def _some(self, texts: list[str]) -> list[bytes]:
        v = self.vocabulary
        split = [self._split(t) for t in texts]
        self.known.learn({w for parts in split for words, _ in parts for w in words})
        packed = self.known.__getitem__
        return [
            b"".join(b"".join(map(packed, words)) + (b"" if special is None else np.int32(v.specials[special]).tobytes()) for words, special in parts)
            for parts in split
        ]

    def _split(self, text: str) -> list[tuple[list[str], str | None]]:
        """Words up to each special token and that token; at last words and none."""
        v = self.vocabulary
        if v.special_pattern is None or not any(s in text for s in v.specials):
            return [(v.words(text), None)]
        parts, at = [], 0
        for m in v.special_pattern.finditer(text):
            parts.append((v.words(text[at : m.start()]), m.group()))
            at = m.end()
        return [*parts, (v.words(text[at:]), None)]


_ENCODERS: dict[int, Encoder] = {}


def _encoder(shared) -> Encoder:
    """One per worker and vocabulary, so that words stay known from batch to batch."""
    if shared.id not in _ENCODERS:
        _ENCODERS[shared.id] = Encoder(shared.vocabulary.value)
    return _ENCODERS[shared.id]


@dataclass(frozen=True)
class Codec:
    """Column functions for one tokenizer file."""

    id: str
    vocabulary: object

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> Codec:
        """Reads the file on the driver; workers get it as a broadcast of a few megabytes."""
        return cls(path, spark.sparkContext.broadcast(Vocabulary.load(path)))

    def encode(self, text: Column) -> Column:
        """The ids of each text, array<int>. Null counts as empty."""
        shared = self

        @F.arrow_udf("array<int>")
        def encoded(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
            encoder = _encoder(shared)
            for texts in batches:
                packed = list(encoder.packed([t or "" for t in texts.to_pylist()]))
                ends = np.cumsum([0, *(len(p) // 4 for p in packed)])
                values = pa.array(np.frombuffer(b"".join(packed), dtype=np.int32))
                yield pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), values)

        return encoded(text)

    def decode(self, ids: Column) -> Column:
        """The text of each array of ids; a null array gives null, bytes that are no UTF-8 the replacement character."""
        shared = self

        @F.arrow_udf("string")
        def decoded(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
            piece = shared.vocabulary.value.pieces.__getitem__
            for lists in batches:
                yield pa.array(
                    [
                        None if not x.is_valid else b"".join(map(piece, x.values.to_pylist())).decode("utf-8", "replace")
                        for x in lists
                    ],
                    pa.string(),
                )

        return decoded(ids)
