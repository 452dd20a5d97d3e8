"""Benchmark decontamination by random-walk embedding and bit-sampling hashing.

Texts and benchmark items are sequences of words (letters and digits, small letters). An item leaks
into a text where a passage lies within ``EDITS`` of the item's length in edit distance. The CGK embedding reads a sequence by a random walk: step t writes the symbol under the
reader and moves on or stays, by a random bit for the step and the symbol. Two sequences at a small
edit distance fall into step again after each edit, so their embeddings have a small Hamming distance.
``WALKS`` independent walks and ``TABLES`` samples of ``SAMPLED`` places for each make hash tables; an item-sized
window and an item that agree in one of them are a candidate pair. The item is then aligned exactly with the text
around the window, with free ends, so a passage may be shorter or longer than the item by all its edits. With 16 x 8
tables the tests find over 95 % of leaks at the largest distance, of whichever edits, and all exact ones. Items of
fewer than ``SHORTEST`` words have no edit to spare and are looked up word for word.

Before they are embedded, windows pass a sieve that loses nothing: an inserted word parts one word pair and pushes
another one out of the window, any other edit spoils at most two, so the window that begins with a passage within k edits
of an item of n words shares at least n - 1 - 2k of its word pairs, each as often as that item has it. Such a window may
run past the end of the text by as many words as may be lost.

The items are broadcast, at most ``PART_CHARACTERS`` characters at a time; a larger benchmark is searched in
parts, one pass over the documents each. All else is a column function: whole texts, no shuffle.

Memory follows the words of a task's texts and of the items, not their product: what a step of a walk does is a hash
of step, walk and symbol, and windows are looked at ``NUMBERS`` numbers at a time.

Defined results: null and empty texts and items hold nothing. Items with equal words are found together; those without an id are
searched as well, and reported once, with a null item_id, unless an item with an id has the same words. Of passages that
overlap, the closest one is reported for an item, the first one if tied.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator
from functools import reduce
from itertools import repeat
from uuid import uuid4

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from marquee.session import store_once

EDITS = 0.2
SHORTEST = 5
WALKS = 16
TABLES = 8
SAMPLED = 4
SEED = 8
GROUP_WORDS = 500_000
PART_CHARACTERS = 32 << 20
PAIR_SLOTS = 1 << 20
NUMBERS = 3_000_000  # numbers that a portion of windows takes in one step
_WORD = re.compile(r"[^\W_]+")


def words_of(text: str) -> list[str]:
    return _WORD.findall(text.lower())


def most_edits(words: int) -> int:
    return int(EDITS * words)


def _repeats(rows: np.ndarray) -> np.ndarray:
    """For each value of the sorted rows how many equal ones are in front of it."""
    place = np.arange(rows.shape[1])
    new = np.hstack([np.ones((len(rows), 1), bool), rows[:, 1:] != rows[:, :-1]])
    return place - np.maximum.accumulate(np.where(new, place, 0), axis=1)


_SHIFT = 32


def closest_passages(items: np.ndarray, texts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each row the least edit distance of the item to any passage of the text, and where that begins and ends.

    Of passages at the least distance the one that ends first, and of these the shortest.
    """
    count, width = texts.shape
    steps = np.arange(width + 1, dtype=np.int64)
    one = np.int64(1) << _SHIFT
    # Distance in the high bits; below it how far from the end the passage begins, so later beginnings are less.
    row = np.tile(width - steps, (count, 1))
    for i in range(items.shape[1]):
        new = np.empty_like(row)
        new[:, 0] = row[:, 0] + one
        new[:, 1:] = np.minimum(row[:, :-1] + (items[:, i : i + 1] != texts) * one, row[:, 1:] + one)
        # A word more in the text adds one per column: a running minimum of the values less their column.
        row = np.minimum.accumulate(new - steps * one, axis=1) + steps * one
    end = (row >> _SHIFT).argmin(axis=1)
    best = row[np.arange(count), end]
    return best >> _SHIFT, width - (best & (one - 1)), end


class Leaks:
    """Finds windows of texts that are close to one of the items."""

    def __init__(self, items: list[tuple[int, str]]) -> None:
        owners: dict[tuple[str, ...], list[int]] = defaultdict(list)
        for item_id, text in items:
            if words := tuple(words_of(text)):
                owners[words].append(item_id)
        self.number = {w: i + 1 for i, w in enumerate(sorted({w for words in owners for w in words}))}
        by_length: dict[int, list[tuple[str, ...]]] = defaultdict(list)
        for words in sorted(owners):
            by_length[len(words)].append(words)
        self.owners = {n: [owners[w] for w in by_length[n]] for n in sorted(by_length)}
        self.codes = {n: np.array([[self.number[w] for w in words] for words in by_length[n]], np.int64) for n in self.owners}
        self.lengths = [n for n in self.owners if n >= SHORTEST]
        self.longest = max(self.lengths, default=0)
        self.least = min((n - most_edits(n) for n in self.owners), default=0)  # words of the shortest passage
        self.short = {n: self._sorted_keys(self.codes[n]) for n in self.owners if n < SHORTEST}
        self.any_pair = np.zeros(PAIR_SLOTS, bool)
        self.pairs: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for n in self.lengths:
            codes = self.codes[n]
            slots = np.sort(self._slots(codes[:, :-1], codes[:, 1:]), axis=1)
            known, which = np.unique(slots, return_inverse=True)
            most = np.zeros(len(known), np.int64)  # times that one item has the pair
            np.maximum.at(most, which.reshape(slots.shape), _repeats(slots) + 1)
            self.pairs[n] = known, most
            self.any_pair[known] = True
        symbols = len(self.number) + 2  # 0: a word of no item; the last one: the end
        self.end = symbols - 1
        random = np.random.default_rng(SEED)
        self.walks = random.integers(0, 1 << 63, WALKS, dtype=np.uint64)
        self.factors = random.integers(1, 1 << 62, (WALKS, TABLES, SAMPLED), dtype=np.int64) | 1
        self.places = {n: random.integers(0, 3 * n, (WALKS, TABLES, SAMPLED)) for n in self.lengths}
        self.hashed = {}
        for n in self.lengths:
            parts = [self.codes[n][a : a + _portion(n)] for a in range(0, len(self.codes[n]), _portion(n))]
            keys = np.concatenate([self._keys(part, n, self._written(part)) for part in parts])
            order = np.argsort(keys, axis=0, kind="stable")
            self.hashed[n] = order, np.take_along_axis(keys, order, axis=0)

    @staticmethod
    def _slots(left: np.ndarray, right: np.ndarray) -> np.ndarray:
        return (left * 1_000_003 + right * 7_919) & (PAIR_SLOTS - 1)

    def _shared_pairs(self, slots: np.ndarray, hits: np.ndarray, n: int) -> np.ndarray:
        """For each window how many of its word pairs one item of n words could share, at most."""
        known, most = self.pairs[n]
        slots = np.sort(np.where(hits, slots, PAIR_SLOTS), axis=1)
        at = np.minimum(np.searchsorted(known, slots), len(known) - 1)
        return ((known[at] == slots) & (_repeats(slots) < most[at])).sum(axis=1)

    def _written(self, windows: np.ndarray) -> np.ndarray:
        """What each walk writes at each step: (steps, windows, WALKS). Windows may be filled up with the end symbol."""
        count, n = windows.shape
        padded = np.hstack([windows, np.full((count, 1), self.end)]).astype(np.int32)
        rows, walks = np.arange(count)[:, None], np.arange(WALKS)[None, :]
        at = np.zeros((count, WALKS), np.int32)
        written = np.empty((3 * n, count, WALKS), np.int32)
        for step in range(3 * n):
            written[step] = symbol = padded[rows, np.minimum(at, n)]
            # The random bit for step, walk and symbol.
            drawn = (symbol.astype(np.uint64) * _FACTORS[0] + self.walks[walks]) ^ np.uint64(int(_FACTORS[1]) * (step + 1) % (1 << 64))
            drawn = (drawn ^ (drawn >> np.uint64(31))) * _FACTORS[2]
            at += (drawn >> np.uint64(63)).astype(np.int32)
        return written

    @staticmethod
    def _sorted_keys(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        keys = _joined_codes(codes.T)
        order = np.argsort(keys, kind="stable")
        return keys[order], order

    def _keys(self, windows: np.ndarray, n: int, written: np.ndarray) -> np.ndarray:
        """The hash of each window of n words in each table: (windows, WALKS * TABLES)."""
        keys = np.zeros((len(windows), WALKS, TABLES), np.int64)
        for walk in range(WALKS):
            for table in range(TABLES):
                sampled = written[self.places[n][walk, table], :, walk].astype(np.int64)
                keys[:, walk, table] = (sampled * self.factors[walk, table][:, None]).sum(axis=0)
        return keys.reshape(len(windows), -1)

    def _candidates(self, keys: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Pairs of a window and an item that agree in some table."""
        order, stored = self.hashed[n]
        found = []
        for table in range(keys.shape[1]):
            low = np.searchsorted(stored[:, table], keys[:, table], "left")
            hits = np.searchsorted(stored[:, table], keys[:, table], "right") - low
            window = np.repeat(np.arange(len(keys)), hits)
            offset = np.arange(len(window)) - np.repeat(np.cumsum(hits) - hits, hits)
            found.append(window * len(stored) + order[low[window] + offset, table])
        pairs = np.unique(np.concatenate(found))
        return pairs // len(stored), pairs % len(stored)

    def in_texts(self, texts: list[str | None]) -> list[list[tuple[int, int, int, int]]]:
        """For each text (item, start, end, distance) of its leaks; start and end are code points."""
        out: list[list[tuple[int, int, int, int]]] = [[] for _ in texts]
        group: list[tuple[int, np.ndarray]] = []
        held = 0
        for i, text in enumerate(texts):
            if not text or not self.owners:
                continue
            words = words_of(text)
            if len(words) < self.least:
                continue
            codes = np.fromiter(map(self.number.get, words, repeat(0)), np.int64, len(words))
            group.append((i, codes))
            held += len(words)
            if held >= GROUP_WORDS:
                self._search(group, texts, out)
                group, held = [], 0
        self._search(group, texts, out)
        return out

    def _search(self, group: list[tuple[int, np.ndarray]], texts: list[str | None], out: list) -> None:
        if not group:
            return
        gap = np.zeros(1, np.int64)
        behind = np.zeros(most_edits(self.longest), np.int64)
        codes = np.concatenate([*[x for _, c in group for x in (c, gap)], behind])
        lasts = np.cumsum([len(c) + 1 for _, c in group]) - 1  # the place behind each text
        leaks: dict[tuple[int, int], list[tuple[int, int, int, int, int]]] = defaultdict(list)
        self._look_up(codes, lasts, leaks)
        slots = self._slots(codes[:-1], codes[1:])
        hits = self.any_pair[slots] & (codes[:-1] > 0) & (codes[1:] > 0)
        upto = np.concatenate([[0], np.cumsum(hits, dtype=np.int32)])
        # (length, starts) of the windows that the sieve lets through.
        passed: list[tuple[int, np.ndarray]] = []
        for n in self.lengths:
            if len(codes) < n:
                break
            k = most_edits(n)
            needed = n - 1 - 2 * k
            starts = np.flatnonzero(upto[n - 1 :] - upto[: len(upto) - n + 1] >= needed)
            starts = starts[starts < lasts[-1]]
            starts = starts[starts + n <= lasts[np.searchsorted(lasts, starts, "right")] + k]
            for part in range(0, len(starts), max(1, NUMBERS // n)):
                some = starts[part : part + max(1, NUMBERS // n)]
                inside = some[:, None] + np.arange(n - 1)
                shared = self._shared_pairs(slots[inside], hits[inside], n)
                passed += [(n, x) for x in _portions(some[shared >= needed], n)]
        for portion in _gathered(passed):
            self._verify(portion, codes, lasts, leaks)
        spots: dict[int, list[tuple[int, int, int, int, int]]] = {}
        for (text, _), found in leaks.items():
            spots.setdefault(text, []).extend(_closest(found))
        for text, found in spots.items():
            i = group[text][0]
            first = lasts[text] - len(group[text][1])
            # Lower case may change the length of a text, so places are counted in words.
            bounds = _bounds(texts[i], {p for start, end, *_ in found for p in (start - first, end - first - 1)})
            for start, end, distance, n, item in found:
                begin, stop = bounds[start - first][0], bounds[end - first - 1][1]
                out[i] += [(owner, begin, stop, distance) for owner in self.owners[n][item]]
            out[i].sort(key=lambda leak: (leak[1], leak[0] is not None, leak[0]))

    def _look_up(self, codes: np.ndarray, lasts: np.ndarray, leaks: dict) -> None:
        """Items too short for edits, word for word."""
        for n, (keys, order) in self.short.items():
            count = len(codes) - n + 1
            if count < 1:
                continue
            windows = _joined_codes([codes[p : p + count] for p in range(n)])
            low, high = np.searchsorted(keys, windows, "left"), np.searchsorted(keys, windows, "right")
            for start in np.flatnonzero(high > low).tolist():
                for item in order[low[start] : high[start]].tolist():
                    if (codes[start : start + n] == self.codes[n][item]).all():
                        text = int(np.searchsorted(lasts, start, "right"))
                        leaks[text, (n << 32) + item].append((start, start + n, 0, n, item))

    def _verify(self, portion: list[tuple[int, np.ndarray]], codes: np.ndarray, lasts: np.ndarray, leaks: dict) -> None:
        """Embed the windows of all lengths together, look them up, and align the pairs."""
        width = max(n for n, _ in portion)
        padded = [
            np.pad(codes[starts[:, None] + np.arange(n)], ((0, 0), (0, width - n)), constant_values=self.end) for n, starts in portion
        ]
        written, done = self._written(np.vstack(padded)), 0
        for (n, starts), windows in zip(portion, padded):
            own = windows[:, :n]
            window, item = self._candidates(self._keys(own, n, written[: 3 * n, done : done + len(own)]), n)
            done += len(own)
            k = most_edits(n)
            size = max(1, NUMBERS // (n + 2 * k))
            for part in range(0, len(window), size):
                self._align(starts[window[part : part + size]], item[part : part + size], n, k, codes, lasts, leaks)

    def _align(self, starts: np.ndarray, item: np.ndarray, n: int, k: int, codes: np.ndarray, lasts: np.ndarray, leaks: dict) -> None:
        """Align items with the text around windows, and keep the passages within k edits."""
        text = np.searchsorted(lasts, starts, "right")
        first = np.concatenate([[0], lasts[:-1] + 1])[text]
        around = starts[:, None] - k + np.arange(n + 2 * k)
        own = (around >= first[:, None]) & (around < lasts[text][:, None])
        words = np.where(own, codes[np.clip(around, 0, len(codes) - 1)], 0)
        distance, begin, end = closest_passages(self.codes[n][item], words)
        near = np.flatnonzero(distance <= k)
        place = starts - k
        for at in near.tolist():
            key = int(text[at]), (n << 32) + int(item[at])
            leaks[key].append((int(place[at] + begin[at]), int(place[at] + end[at]), int(distance[at]), n, int(item[at])))


_FACTORS = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0xD6E8FEB86659FD93)]


def _joined_codes(columns) -> np.ndarray:
    """One number for the codes of each row; equal rows have equal ones."""
    keys = np.zeros(len(columns[0]), np.uint64)
    for column in columns:
        keys = (keys ^ column.astype(np.uint64)) * _FACTORS[0]
        keys ^= keys >> np.uint64(29)
    return keys


def _portion(n: int) -> int:
    """Windows of n words embedded at a time: the walks write three numbers a word."""
    return max(1, NUMBERS // (3 * n * WALKS))


def _portions(starts: np.ndarray, n: int) -> Iterator[np.ndarray]:
    for part in range(0, len(starts), _portion(n)):
        yield starts[part : part + _portion(n)]


def _gathered(passed: list[tuple[int, np.ndarray]]) -> Iterator[list[tuple[int, np.ndarray]]]:
    """The windows of all lengths in portions whose longest window decides how many there are."""
    held: list[tuple[int, np.ndarray]] = []
    for n, starts in passed:  # lengths rise
        if held and sum(len(s) for _, s in held) + len(starts) > _portion(n):
            yield held
            held = []
        held.append((n, starts))
    if held:
        yield held


def _closest(found: list[tuple[int, int, int, int, int]]) -> list[tuple[int, int, int, int, int]]:
    """Of overlapping passages the one at the least distance, the first one if tied."""
    chosen: list[tuple[int, int, int, int, int]] = []
    for leak in sorted(set(found), key=lambda x: (x[2], x[0], x[1])):
        if all(leak[0] >= c[1] or leak[1] <= c[0] for c in chosen):
            chosen.append(leak)
    return chosen


def _bounds(text: str, wanted: set[int]) -> dict[int, tuple[int, int]]:
    """Start and end of the words with these numbers, in the text as it is."""
    if len(text) == len(text.lower()):
        return {i: m.span() for i, m in enumerate(_WORD.finditer(text.lower())) if i in wanted}
    # Some letter grows in lower case: find each character's place before it did.
    place = [i for i, c in enumerate(text) for _ in c.lower()] + [len(text)]
    return {i: (place[m.start()], place[m.end() - 1] + 1) for i, m in enumerate(_WORD.finditer(text.lower())) if i in wanted}


def _joined_words(text):
    @F.arrow_udf("string")
    def joined(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            yield pa.array([" ".join(words_of(t)) for t in texts.to_pylist()], pa.string())

    return joined(text)


class Benchmark:
    """Items in parts that are each small enough to broadcast."""

    def __init__(self, items: DataFrame, id_column: str = "item_id", text_column: str = "text") -> None:
        spark = items.sparkSession
        rows = items.select(F.col(id_column).cast("long").alias("id"), F.col(text_column).alias("text"))
        rows = rows.where("text IS NOT NULL")
        nameless = rows.where("id IS NULL")
        if not nameless.isEmpty():
            named = rows.where("id IS NOT NULL").withColumn("words", _joined_words(F.col("text")))
            nameless = nameless.withColumn("words", _joined_words(F.col("text"))).dropDuplicates(["words"])
            nameless = nameless.join(named.select("words"), "words", "left_anti")
            rows = store_once(named.unionByName(nameless).select("id", "text"), "items")
        size = rows.agg(F.sum(F.length("text"))).first()[0] or 0
        parts = max(1, -(-size // PART_CHARACTERS))
        part = F.pmod(F.xxhash64("id", "text"), F.lit(parts))
        self.parts = []
        for n in range(parts):
            held = [(r[0], r[1]) for r in rows.where(part == n).orderBy("id", "text").collect()]
            self.parts.append(spark.sparkContext.broadcast(held))

    def leaks(self, docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
        """(doc_id, item_id, start, end, distance): a row per leak, distance in words."""
        found = [
            docs.select(F.col(id_column).alias("doc_id"), F.explode(_leaks_of(part)(F.col(text_column))).alias("leak"))
            for part in self.parts
        ]
        return reduce(DataFrame.unionByName, found).select("doc_id", "leak.*")

    def without_leaks(self, docs: DataFrame, text_column: str = "text") -> DataFrame:
        """The documents that hold no item, with all their columns."""
        for n, part in enumerate(self.parts):
            if n:
                docs = store_once(docs, "decontaminated")  # a pass for each part
            docs = docs.where(F.size(_leaks_of(part)(F.col(text_column))) == 0)
        return docs


_FINDERS: dict[str, Leaks] = {}


def _leaks_of(shared):
    kind = pa.list_(pa.struct([("item_id", pa.int64()), ("start", pa.int32()), ("end", pa.int32()), ("distance", pa.int32())]))
    names = ("item_id", "start", "end", "distance")
    key = uuid4().hex

    @F.arrow_udf("array<struct<item_id:long,start:int,end:int,distance:int>>")
    def leaks(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        if key not in _FINDERS:  # one per worker and part, the last one only
            _FINDERS.clear()
            _FINDERS[key] = Leaks(shared.value)
        for texts in batches:
            yield pa.array([[dict(zip(names, x)) for x in found] for found in _FINDERS[key].in_texts(texts.to_pylist())], kind)

    return leaks
