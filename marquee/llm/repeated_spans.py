"""Removal of byte strings that also start earlier, by merging Burrows-Wheeler transforms of shards.

A byte goes if it lies in a string of ``span`` bytes that is found earlier too: in a document of a smaller
id, or at an earlier start of the same document. Nothing that goes is cut out before all is judged.

Strings meet in cells. The grams (``GRAM`` bytes) of a window of ``span`` bytes have hashes, and the leftmost
gram with the least of them is the window's anchor: equal windows have equal anchors at equal distances, wherever
they stand. Windows in a row with the anchor in one place are one piece of text, and no two windows of a piece
are equal. What repeats is then found in three steps, each exact on what the one before leaves:

* A piece with the same anchor and content as an earlier piece goes whole; of equal pieces the first stays.
* Pieces whose anchor has no other content share no window. The first pieces of all other anchors meet in
  cells by anchor. A cell sorts its pieces in shards, keeps each shard's transform, merges these by interleave
  refinement (``bwt``) down to a common prefix of ``span`` bytes, and gives back every window of an interval
  but its first.
* Anchors with more than ``CROWD`` contents, such as a short line that a third of all documents hold in
  places of their own, would make a cell without bound. Their windows meet by a digest of the window instead,
  in a sum that each task begins by itself.

A task counts equal pieces of its batch once and sends one row for each anchor that it has seen several times,
so a hot line is a row for each batch. Texts travel compressed.

Defined results: a null text is empty; a text shorter than the span keeps all. Documents without an id come
after all others. Rows that share an id are told apart by their text, and those equal in both in any order, of
which the first counts as earlier. Other columns take no part.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from math import ceil

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame, Window, functions as F

from marquee.llm.bwt import Transform, merged_intervals
from marquee.session import store_once

SPAN = 100
GRAM = 24
CROWD = 2048
CELL_BYTES = 2 << 20
SHARD_BYTES = 1 << 18
STRETCH = 1 << 20
# Fixed odd numbers that mix the bytes of a gram.
_MIX = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0xD6E8FEB86659FD93)]


def _anchors(data: np.ndarray, span: int) -> tuple[np.ndarray, np.ndarray]:
    """The hash of each gram, and of each window of ``span`` bytes the place of its anchor."""
    n = len(data)
    words = np.ndarray((n - 7,), "<u8", data, 0, (1,))
    h = words[: n - GRAM + 1] * _MIX[0]
    h ^= words[8 : n - GRAM + 9]
    h *= _MIX[1]
    h += words[16 : n - GRAM + 17]
    h ^= h >> np.uint64(32)
    h *= _MIX[2]
    h ^= h >> np.uint64(29)
    # The places in the low bits: of equal hashes the leftmost is the least.
    low = np.uint64(2 * STRETCH - 1)
    least = (h & ~low) | np.arange(len(h), dtype=np.uint64)
    wanted, width = span - GRAM + 1, 1
    while width < wanted:
        step = min(width, wanted - width)
        least, width = np.minimum(least[:-step], least[step:]), width + step
    return h, (least & low).astype(np.int64)


def _pieces(data: np.ndarray, offsets: np.ndarray, span: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the runs of windows with one anchor, and its hash; documents begin at ``offsets``."""
    found = []
    for at in range(0, max(0, len(data) - span + 1), STRETCH):
        hashes, anchors = _anchors(data[at : at + STRETCH + span - 1], span)
        changes = np.flatnonzero(anchors[1:] != anchors[:-1]) + 1
        inside = offsets[np.searchsorted(offsets, at) : np.searchsorted(offsets, at + len(anchors))] - at
        starts = np.unique(np.concatenate([[0], changes, inside]))
        ends = np.append(starts[1:], len(anchors))
        # Windows that would reach into the next document are none.
        last = offsets[np.searchsorted(offsets, starts + at, "right")] - at - span + 1
        ends = np.minimum(ends, last)
        whole = ends > starts
        found.append((starts[whole] + at, ends[whole] + at, hashes[anchors[starts[whole]]]))
    if not found:
        return np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.uint64)
    return tuple(np.concatenate(x) for x in zip(*found))


def _bytes_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a column of texts in a row, and where each begins and the last one ends."""
    column = column.cast(pa.large_binary()).fill_null(b"")
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(column.buffers()[2] or b"", np.uint8)[offsets[0] : offsets[-1]]
    return data, offsets - offsets[0]


def _new_values(values: np.ndarray) -> np.ndarray:
    return np.concatenate([[True], values[1:] != values[:-1]]) if len(values) else np.empty(0, bool)


# What a batch knows of a piece: nothing more, that its anchor has other pieces, that an earlier piece equals it.
_ALONE, _KNOWN, _AGAIN = 0, 1, 2


def _cut(span: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = _bytes_of(batch.column("text"))
            starts, ends, anchor = _pieces(data, offsets, span)
            doc = np.searchsorted(offsets, starts, "right") - 1
            order_key = batch.column("ord").to_numpy(zero_copy_only=False)[doc] if len(doc) else np.empty(0, np.int64)
            at = (starts - offsets[doc]) * 512 + (ends - starts)
            view, digest = memoryview(data), xxhash.xxh3_64_intdigest
            contents = np.array([digest(view[a : b + span - 1]) for a, b in zip(starts.tolist(), ends.tolist())], np.uint64)
            by = np.lexsort((at, order_key, contents, anchor))
            anchor, contents, order_key, at = anchor[by], contents[by], order_key[by], at[by]
            new_anchor = _new_values(anchor)
            again = ~(new_anchor | _new_values(contents))
            group = np.cumsum(new_anchor) - 1
            several = np.bincount(group)[group] > 1 if len(group) else np.empty(0, bool)
            kind = np.where(again, _AGAIN, np.where(several, _KNOWN, _ALONE)).astype(np.int8)
            spread = (order_key.view(np.uint64) * _MIX[0] ^ at.view(np.uint64)) * _MIX[1]
            route = np.where(new_anchor, anchor, spread)
            columns = [route.view(np.int64), anchor.view(np.int64), contents.view(np.int64), order_key, at, kind]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["route", "anchor", "content", "ord", "at", "kind"])

    return cut


def _packed(text: Column) -> Column:
    """Texts compressed for the way through a shuffle."""

    @F.arrow_udf("binary")
    def packed(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        compress = zstandard.ZstdCompressor(level=1).compress
        for texts in batches:
            yield pa.array([compress(t.as_py() or b"") for t in texts], pa.binary())

    return packed(text.cast("binary"))


def _ranges(lists: pa.Array, row: int) -> np.ndarray:
    """One row's list of pairs of numbers, as rows of two."""
    pairs = lists[row].values
    if pairs is None or not len(pairs):
        return np.empty((0, 2), np.int64)
    return np.stack([x.to_numpy(zero_copy_only=False) for x in pairs.flatten()], 1).astype(np.int64)


def _taken(span: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """The wanted pieces of each text: the piece itself for a cell, the digests of its windows for a crowd."""
    names = ["cell", "ord", "start", "piece", "high", "low"]
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64()]

    def taken(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        expand = zstandard.ZstdDecompressor().decompress
        for batch in batches:
            rows = []
            for row, (name, packed) in enumerate(zip(batch.column("ord").to_pylist(), batch.column("packed"))):
                text = expand(packed.as_py())
                for at, cell in _ranges(batch.column("wanted"), row).tolist():
                    start, windows = divmod(at, 512)
                    if cell >= 0:
                        rows.append((cell, name, start, text[start : start + windows + span - 1], None, None))
                        continue
                    for s in range(start, start + windows):
                        digest = np.frombuffer(xxhash.xxh3_128_digest(text[s : s + span]), np.int64).tolist()
                        rows.append((cell, name, s, None, *digest))
            columns = zip(*rows) if rows else [[]] * len(names)
            yield pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(columns, kinds)], names)

    return taken


def _merged(span: int, shard_bytes: int) -> Callable[[pa.Table], pa.Table]:
    """The spans of a cell's pieces that also start earlier in the cell."""
    schema = pa.schema([("ord", pa.int64()), ("start", pa.int64()), ("end", pa.int64())])

    def repeated(cell: pa.Table) -> pa.Table:
        cell = cell.sort_by([("ord", "ascending"), ("start", "ascending")])
        order_key, start = (cell.column(c).to_numpy() for c in ("ord", "start"))
        pieces = cell.column("piece").to_pylist()
        lengths = np.fromiter(map(len, pieces), np.int64, len(pieces))
        shard = np.cumsum(lengths) // shard_bytes
        bounds = [*np.flatnonzero(_new_values(shard)).tolist(), len(pieces)]
        shards = [Transform(pieces[a:b]) for a, b in zip(bounds, bounds[1:])]
        rows, begins = merged_intervals(shards, span)
        if not len(rows):
            return schema.empty_table()
        places = [s.places() for s in shards]
        piece = np.concatenate([p + a for (p, _), a in zip(places, bounds)])[rows].astype(np.int64)
        inside = lengths[piece] - np.concatenate([n for _, n in places])[rows]
        # Pieces are numbered in the order of their documents and starts, so the least key of an interval is its first window.
        key = piece << 16 | inside
        first = np.repeat(np.minimum.reduceat(key, begins), np.diff(np.append(begins, len(key))))
        key = np.sort(key[key != first])
        piece, inside = key >> 16, key & 0xFFFF
        begins = np.flatnonzero(_new_values(piece) | (np.diff(inside, prepend=-span - 1) > span))
        ends = np.append(begins[1:], len(key)) - 1
        columns = [order_key[piece[begins]], start[piece[begins]] + inside[begins], start[piece[begins]] + inside[ends] + span]
        return pa.table([pa.array(c) for c in columns], schema=schema) if len(key) else schema.empty_table()

    return repeated


def _without(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts without their marked spans."""
    expand = zstandard.ZstdDecompressor().decompress
    for batch in batches:
        n_bytes, removed, spans, kept = [], [], [], []
        for row, packed in enumerate(batch.column("packed")):
            text, marks = expand(packed.as_py()), _ranges(batch.column("marks"), row)
            marks = marks[np.argsort(marks[:, 0], kind="stable")]
            reach = np.maximum.accumulate(marks[:, 1]) if len(marks) else marks[:, 1]
            begins = np.flatnonzero(np.concatenate([[True], marks[1:, 0] > reach[:-1]])) if len(marks) else np.empty(0, np.int64)
            starts, ends = marks[begins, 0], reach[np.append(begins[1:], len(marks)) - 1] if len(marks) else begins
            edges = zip([0, *ends.tolist()], [*starts.tolist(), len(text)])
            n_bytes.append(len(text))
            removed.append(int((ends - starts).sum()))
            spans.append(len(starts))
            kept.append(b"".join(text[a:b] for a, b in edges))
        counts = [pa.array(x, pa.int64()) for x in (n_bytes, removed, spans)]
        names = [*batch.schema.names[:1], "n_bytes", "n_removed", "n_spans", "kept"]
        yield pa.RecordBatch.from_arrays([batch.column(0), *counts, pa.array(kept, pa.binary())], names)


def _numbered(docs: DataFrame, id_column: str, text_column: str) -> DataFrame:
    """(doc_id, ord, text): ord is different in each row, in the order in which documents count as earlier."""
    texts = docs.select(F.col(id_column).alias("doc_id"), F.col(text_column).alias("text"))
    if texts.schema["doc_id"].dataType.simpleString() in ("bigint", "int", "smallint", "tinyint"):
        rows, ids = texts.agg(F.count("*"), F.countDistinct("doc_id")).first()
        if rows == ids:
            return texts.select("doc_id", F.col("doc_id").cast("long").alias("ord"), "text")
    ordered = texts.orderBy(F.col("doc_id").asc_nulls_last(), "text")
    return store_once(ordered.select("doc_id", F.monotonically_increasing_id().alias("ord"), "text"), "numbered")


def without_repeats(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    span: int = SPAN,
    crowd: int = CROWD,
    cell_bytes: int = CELL_BYTES,
    shard_bytes: int = SHARD_BYTES,
) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept) for every row; ``kept`` are the bytes that stay."""
    if span < GRAM:
        raise ValueError(f"a span has at least {GRAM} bytes")
    if span - GRAM >= 512:
        raise ValueError(f"a span has fewer than {512 + GRAM} bytes")
    texts = _numbered(docs, id_column, text_column)
    packed = texts.select("doc_id", "ord", _packed(F.col("text")).alias("packed"))

    # Pieces whose anchor occurs once share nothing.
    cut = texts.select("ord", F.col("text").cast("binary").alias("text")).mapInArrow(
        _cut(span), "route long, anchor long, content long, ord long, at long, kind byte"
    )
    met = cut.withColumn("n", F.count("*").over(Window.partitionBy("route"))).where(f"n > 1 OR kind != {_ALONE}")
    own = F.when(F.col("kind") == _AGAIN, F.xxhash64("ord", "at")).alias("own")
    equal = Window.partitionBy("anchor", "content", "own").orderBy("ord", "at")
    pieces = met.select("anchor", "content", "ord", "at", "kind", own).withColumn("place", F.row_number().over(equal))
    first = ((F.col("place") == 1) & (F.col("kind") != _AGAIN)).alias("first")
    pieces = store_once(pieces.select("anchor", "ord", "at", first), "pieces")

    start, windows = F.expr("at div 512").alias("start"), F.col("at") % 512
    marks = pieces.where(~F.col("first")).select("ord", start, (F.expr("at div 512") + windows + (span - 1)).alias("end"))

    # The first pieces of anchors with several contents meet.
    firsts = pieces.where("first").select("anchor", "ord", "at")
    contents = firsts.groupBy("anchor").agg(F.count("*").alias("contents")).where("contents > 1")
    wanted = store_once(firsts.join(contents, "anchor").select("anchor", "contents", "ord", "at"), "wanted-pieces")
    calm = F.col("contents") <= crowd
    total, crowded = wanted.agg(F.sum(F.when(calm, windows + (span - 1))), F.count_if(~calm)).first()
    cells = max(1, ceil((total or 0) / cell_bytes))
    cell = F.when(calm, F.pmod(F.xxhash64("anchor"), F.lit(cells))).otherwise(F.lit(-1).cast("long")).alias("cell")
    lists = wanted.groupBy("ord").agg(F.collect_list(F.struct("at", cell)).alias("wanted"))
    read = packed.select("ord", "packed").join(lists, "ord").mapInArrow(
        _taken(span), "cell long, ord long, start long, piece binary, high long, low long"
    )
    read = store_once(read, "texts-of-pieces")
    in_cells = read.where("cell >= 0").select("cell", "ord", "start", "piece")
    marks = marks.unionByName(in_cells.groupBy("cell").applyInArrow(_merged(span, shard_bytes), "ord long, start long, end long"))
    if crowded:
        one = read.where("cell < 0").select("high", "low", "ord", "start")
        # Stored, so that the join reads it through an exchange of its own and a window of many places can be split.
        least = store_once(one.groupBy("high", "low").agg(F.min(F.struct("ord", "start")).alias("least")), "first-windows")
        later = one.join(least, ["high", "low"]).where("struct(ord, start) != least")
        marks = marks.unionByName(later.select("ord", "start", (F.col("start") + span).alias("end")))

    by_doc = marks.groupBy("ord").agg(F.collect_list(F.struct("start", "end")).alias("marks"))
    kind = docs.schema[id_column].dataType.simpleString()
    whole = packed.join(by_doc, "ord", "left").select("doc_id", "packed", "marks")
    return whole.mapInArrow(_without, f"doc_id {kind}, n_bytes long, n_removed long, n_spans long, kept binary")
