"""Fill-in-the-middle examples, cut at code points through a sparse index of the exceptions.

Cuts are counted in code points, texts lie in memory as bytes. For a batch of texts the index holds only the
characters of more than one byte: the code point that each stands at, and the bytes that it and all before it take
beyond one. A cut at code point c lies at byte c plus the excess of the exceptions in front of c, which
``searchsorted`` finds for all cuts of the batch at once; ASCII stretches have no entry and need no look.
The way back, from a byte to a code point, takes the same excess off.

A text of n code points is cut after min(a, b) and max(a, b) of them, with a = h1 % (n + 1) and
b = h2 % (n + 1); the parts are prefix, middle and suffix. ``plain`` texts stay as they are: empty ones, those that
hold a sentinel, and by h3 all but ``FIM_PERCENT`` of the rest. By h4, ``SPM_PERCENT`` of the others put the
suffix first (spm), the rest the prefix (psm). h1 to h4 are the first 32-bit groups of the SHA-256 of the seed and the id.

Defined results: a null text is empty, and plain; a null id counts as an empty one, so all rows without an id
draw alike. Rows of one id draw alike too. Cuts at the ends leave empty parts. Other columns take no part.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
FIM_PERCENT = 90
SPM_PERCENT = 20
SEED = "1"
_PLAIN, _PSM, _SPM = "plain", "psm", "spm"


class Exceptions:
    """The characters of more than one byte in a row of UTF-8 texts, which begin at ``offsets`` and end at the last of them."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray) -> None:
        lead = np.flatnonzero(data >= 0xC0)
        byte = data[lead]
        extra = 1 + (byte >= 0xE0).astype(np.int64) + (byte >= 0xF0)
        self.excess = np.concatenate([[0], np.cumsum(extra)])
        self.bytes = lead
        # Code points are numbered through all texts.
        self.points = lead - self.excess[:-1]
        self.offsets = offsets
        self.starts = self.to_point(offsets)

    def to_point(self, byte: np.ndarray) -> np.ndarray:
        """The code points in front of a byte that begins a character."""
        return byte - self.excess[np.searchsorted(self.bytes, byte)]

    def to_byte(self, point: np.ndarray) -> np.ndarray:
        """The byte at which a code point begins."""
        return point + self.excess[np.searchsorted(self.points, point)]

    def lengths(self) -> np.ndarray:
        """Code points of each text."""
        return np.diff(self.starts)


def _bytes_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    column = column.cast(pa.large_binary()).fill_null(b"")
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(column.buffers()[2] or b"", np.uint8)[offsets[0] : offsets[-1]]
    return data, offsets - offsets[0]


_KIND = "struct<n:long,form:string,prefix_chars:long,middle_chars:long,output:string>"
_MARKS = [m.encode() for m in (PREFIX, SUFFIX, MIDDLE)]


def _arranged(texts: pa.Array, draws: np.ndarray) -> pa.Array:
    data, offsets = _bytes_of(texts)
    index = Exceptions(data, offsets)
    n = index.lengths()
    ends = np.sort(draws[:, :2] % (n + 1)[:, None], axis=1)
    cuts = index.to_byte(index.starts[:-1, None] + ends)
    view, (p, s, m) = memoryview(data), _MARKS
    forms, outputs = [], []
    wanted = (draws[:, 2] % 100 < FIM_PERCENT) & (n > 0)
    suffix_first = draws[:, 3] % 100 < SPM_PERCENT
    for a, b, one, two, fim, spm in zip(offsets.tolist(), offsets[1:].tolist(), *cuts.T.tolist(), wanted.tolist(), suffix_first.tolist()):
        whole = bytes(view[a:b])
        if not fim or p in whole or s in whole or m in whole:
            forms.append(_PLAIN)
            outputs.append(whole)
            continue
        one, two = one - a, two - a
        prefix, middle, suffix = whole[:one], whole[one:two], whole[two:]
        forms.append(_SPM if spm else _PSM)
        outputs.append(b"".join([s, suffix, p, prefix, m, middle] if spm else [p, prefix, s, suffix, m, middle]))
    form = pa.array(forms, pa.string())
    plain = np.array([f == _PLAIN for f in forms], bool)
    return pa.StructArray.from_arrays(
        [
            pa.array(n),
            form,
            pa.array(ends[:, 0], mask=plain),
            pa.array(ends[:, 1] - ends[:, 0], mask=plain),
            pa.array(outputs, pa.binary()).cast(pa.string()),
        ],
        ["n", "form", "prefix_chars", "middle_chars", "output"],
    )


def fill_in_middle(text: Column, h1: Column, h2: Column, h3: Column, h4: Column) -> Column:
    """(n, form, prefix_chars, middle_chars, output) of a text and its four draws, whole numbers from 0 to 2^32 - 1."""

    @F.arrow_udf(_KIND)
    def arranged(batches: Iterator[tuple[pa.Array, ...]]) -> Iterator[pa.Array]:
        for texts, *draws in batches:
            yield _arranged(texts, np.stack([d.to_numpy(zero_copy_only=False) for d in draws], 1).astype(np.int64))

    return arranged(text, h1, h2, h3, h4)


def draws(id_column: Column, seed: str = SEED) -> list[Column]:
    """h1 to h4 of an id."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(id_column.cast("string"), F.lit(""))), 256)
    return [F.conv(F.substring(digest, 1 + 8 * i, 8), 16, 10).cast("long") for i in range(4)]


def restored(output: Column, form: Column) -> Column:
    """The text that an output was made of. Sentinels occur once each: a text that holds one stays plain, and none can
    form at a seam, as each begins with a character that no sentinel has further in."""
    between = lambda first, last: F.substring_index(F.substring_index(output, first, -1), last, 1)
    middle = F.substring_index(output, MIDDLE, -1)
    psm = F.concat(between(PREFIX, SUFFIX), middle, between(SUFFIX, MIDDLE))
    spm = F.concat(between(PREFIX, MIDDLE), middle, between(SUFFIX, PREFIX))
    return F.when(form == _PSM, psm).when(form == _SPM, spm).otherwise(output)


def examples(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", seed: str = SEED) -> DataFrame:
    """(doc_id, n, form, prefix_chars, middle_chars, output) for every row."""
    made = fill_in_middle(F.col(text_column).cast("binary"), *draws(F.col(id_column), seed))
    return docs.select(F.col(id_column).alias("doc_id"), made.alias("made")).select("doc_id", "made.*")
