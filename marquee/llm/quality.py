"""Quality by compression: zstandard dictionaries of good and of bad labelled text.

A text that resembles a dictionary compresses well with it. Dictionaries of good and of bad text
are built twice, from the text and from its outline (letters and digits replaced by their kind).
A text is compressed with all four. The evidence is, for text and outline, the normalised
difference of the sizes, (bad - good) / (bad + good), and the share of the text's bytes that the
better dictionary leaves, which tells runs of repeated words from prose. A logistic curve, fitted
on labelled texts that had no part in the dictionaries, turns it into a probability.

The fit is bounded: ``SAMPLE`` labelled texts of each class, those with the smallest hash of their
id (repeated rows count once), and of one longer than ``PIECES`` times ``PIECE`` characters that many pieces, spread
evenly from its beginning to its end; the two classes count in the curve by their
share of all labelled rows. Scores are a column function over whole texts without a shuffle. A text
is compressed in blocks of ``BLOCK`` bytes, each against the dictionary anew, so that a long text is
judged by the dictionaries to its end and not by its own beginning.

Defined results: null and empty texts score the share of good rows among the labelled ones. With
labels of one class only, or none, every text scores that share, kept within 0.01 and 0.99 (0.5 without labels).
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, functions as F

from marquee.session import store_once

SAMPLE = 1500
PIECES = 8
PIECE = 1000  # characters of a piece of a long text, and bytes of one text in a dictionary
BLOCK = 1024
DICTIONARY = 1 << 18
LEVEL = 3
RIDGE = 1e-3

# Every letter becomes a or A, every digit 0; bytes beyond ASCII count as small letters.
OUTLINE = bytes(
    ord("a") if chr(b).islower() and b < 128 or b >= 128 else ord("A") if chr(b).isupper() else ord("0") if chr(b).isdigit() else b
    for b in range(256)
)


def compressor(dictionary: bytes):
    built = zstandard.ZstdCompressionDict(dictionary, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    built.precompute_compress(level=LEVEL)
    return zstandard.ZstdCompressor(
        dict_data=built, write_checksum=False, write_content_size=False, write_dict_id=False, level=LEVEL
    )


def excerpt(text: Column) -> Column:
    """The text, or if it is long pieces from all over it."""
    room = F.length(text) - PIECE
    pieces = [F.substr(text, F.floor(room * n / (PIECES - 1)).cast("int") + 1, F.lit(PIECE)) for n in range(PIECES)]
    return F.when(F.length(text) <= PIECES * PIECE, text).otherwise(F.concat(*pieces))


def dictionary_of(texts: list[bytes]) -> bytes:
    """Pieces of the texts, cut at a place that the text's length decides, as far as they fit."""
    out, size = [], 0
    for text in texts:
        at = (len(text) * 7919) % max(1, len(text) - PIECE)
        out.append(text[at : at + PIECE])
        size += len(out[-1]) + 1
        if size >= DICTIONARY:
            break
    return (b"\n".join(out) or b" ")[:DICTIONARY]


class Evidence:
    """Compares texts with the four dictionaries."""

    def __init__(self, dictionaries: dict[str, tuple[bytes, bytes]]) -> None:
        self.views = [
            (view, compressor(good), compressor(bad))
            for view, (good, bad) in zip((None, OUTLINE), (dictionaries["text"], dictionaries["outline"]))
        ]

    def of(self, text: str) -> list[float]:
        data = text.encode()
        out, least = [], 0
        for view, good, bad in self.views:
            seen = data.translate(view) if view else data
            with_good = with_bad = 0
            for at in range(0, len(seen), BLOCK):
                block = seen[at : at + BLOCK]
                with_good += len(good.compress(block))
                with_bad += len(bad.compress(block))
            out.append((with_bad - with_good) / (with_bad + with_good))
            least += min(with_good, with_bad)
        return [*out, math.log(least / len(data))]


@dataclass(frozen=True)
class CompressionClassifier:
    dictionaries: dict[str, tuple[bytes, bytes]] | None
    weights: tuple[float, ...]
    share: float

    @classmethod
    def fit(
        cls, docs: DataFrame, labels: DataFrame, id_column: str = "doc_id", text_column: str = "text", label_column: str = "quality"
    ) -> CompressionClassifier:
        """From the documents that ``labels`` (id, label of 0 or 1) names; other labels, and empty texts, are left out.

        Only ids are shuffled to choose the sample; its texts are then picked out by a broadcast of those ids.
        """
        texts = docs.select(F.col(id_column).alias("id"), F.col(text_column).alias("text")).where("text != ''")
        marks = labels.select(F.col(id_column).alias("id"), F.col(label_column).cast("int").alias("label")).where("label IN (0, 1)")
        usable = store_once(texts.select("id").join(marks, "id"), "labelled-ids")
        counts = {r[0]: r[1] for r in usable.groupBy("label").count().collect()}
        total = sum(counts.values())
        share = min(max(counts.get(1, 0) / total if total else 0.5, 0.01), 0.99)
        if len(counts) < 2:
            return cls(None, (), share)
        place = F.xxhash64(F.col("id").cast("string"), F.lit("sample")).alias("place")
        chosen = [usable.where(F.col("label") == n).select("id", "label", place).distinct().orderBy("place", "id").limit(SAMPLE) for n in (1, 0)]
        # At most 2 * SAMPLE ids.
        picked = texts.join(F.broadcast(chosen[0].unionByName(chosen[1])), "id").select(
            "label", "place", "id", excerpt(F.col("text")).alias("text")
        )
        samples: dict[int, list[bytes]] = {1: [], 0: []}
        for label, _, _, text in sorted(set(map(tuple, picked.collect()))):
            samples[label].append(text.encode())
        # Two thirds make the dictionaries, as many texts of either class; a third calibrates.
        made = {label: [t for i, t in enumerate(texts) if i % 3] for label, texts in samples.items()}
        even = max(1, min(map(len, made.values())))
        dictionaries = {
            name: tuple(dictionary_of([t.translate(view) if view else t for t in made[label][:even]]) for label in (1, 0))
            for name, view in (("text", None), ("outline", OUTLINE))
        }
        evidence = Evidence(dictionaries)
        left = {label: [t.decode() for t in texts[::3]] for label, texts in samples.items()}
        x = np.array([evidence.of(t) for label in (1, 0) for t in left[label]])
        y = np.array([float(label) for label in (1, 0) for _ in left[label]])
        weight = np.where(y == 1, share / max(1, len(left[1])), (1 - share) / max(1, len(left[0])))
        return cls(dictionaries, tuple(logistic(x, y, weight).tolist()), share)

    def score(self, text: Column) -> Column:
        """The probability that a text is good, double."""
        model = self

        @F.arrow_udf("double")
        def scored(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
            evidence = Evidence(model.dictionaries) if model.dictionaries else None
            *slopes, offset = model.weights or (0.0,)
            for texts in batches:
                out = []
                for t in texts:
                    value = t.as_py()
                    if not value or evidence is None:
                        out.append(model.share)
                        continue
                    z = offset + sum(a * b for a, b in zip(slopes, evidence.of(value)))
                    out.append(1 / (1 + math.exp(-max(-700.0, min(700.0, z)))))
                yield pa.array(out, pa.float64())

        return scored(text)


def logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Slopes, then the offset, of the weighted logistic fit with a small ridge, by Newton's method."""
    mean, spread = x.mean(0), x.std(0) + 1e-9
    design = np.column_stack([(x - mean) / spread, np.ones(len(x))])
    beta = np.zeros(design.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-design @ beta))
        gradient = design.T @ (weight * (y - p)) - RIDGE * beta
        curve = (design * (weight * p * (1 - p))[:, None]).T @ design + RIDGE * np.eye(len(beta))
        step = np.linalg.solve(curve, gradient)
        beta += step
        if np.abs(step).max() < 1e-9:
            break
    slopes = beta[:-1] / spread
    return np.append(slopes, beta[-1] - (slopes * mean).sum())
