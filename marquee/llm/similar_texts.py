"""Near copies by their shingles: minima name the candidates, the shingles themselves decide.

Two texts are near copies when their sets of shingles (``WORDS`` words in a row, small letters) have a
Jaccard similarity of ``SIMILARITY`` or more; groups are what such links join. Each text gets ``BANDS`` keys, each
of ``ROWS`` minima of its shingles under permutations of their hashes; a pair of similarity s shares a key but for
a chance of (1 - s^ROWS)^BANDS, 5 in a million at 0.8. The low bytes of all minima are its sketch: the share
in which two sketches agree estimates the similarity, within 0.026 (one standard deviation) at 0.8.

Buckets of up to ``CROWD`` texts name all their pairs, which are then compared by their shingles. A larger one is gone
through in one task, ``BLOCK`` texts at a time: a text is compared by sketch with those in front of it, and by
shingles, the most alike first, with those that may be similar (``MAYBE``, four standard deviations below the bound)
and are not in its group by then. Only links that join two groups leave the task, so a crowd of near copies gives a link
or so for each text, and texts that share a key without being near copies give none and need no rounds. The
blocks of a bucket are compared with each other in the same way. All comparisons by shingles are in whole numbers, so
no text goes that is not linked to one that stays.

Texts are told apart by SHA-256. Defined results: rows without an id, and texts without words, stay; a text of
fewer than ``WORDS`` words is one shingle. Of equal texts the rows with the least id stay, if any does. Of each
group the text with the least id stays, of equal ids the one numbered first.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from marquee.llm.components import components
from marquee.session import store_once

WORDS = 5
SIMILARITY = (4, 5)
BANDS = 40
ROWS = 6
CROWD = 32
BLOCK = 1024
MAYBE = round(0.7 * BANDS * ROWS)
SEED = 42
PORTION = 2048  # shingles permuted at a time
_ODD = np.uint64(0x9E3779B97F4A7C15)
_PERMUTATIONS = np.random.default_rng(SEED).integers(0, 1 << 63, BANDS * ROWS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * _ODD
    return x ^ (x >> np.uint64(29))


def shingles_of(text: str | None) -> np.ndarray:
    """The hashes of the different shingles of a text, sorted."""
    words = (text or "").lower().split()
    hashes = np.fromiter((xxhash.xxh64_intdigest(w, SEED) for w in words), np.uint64, len(words))
    if not len(hashes):
        return hashes
    count = max(1, len(hashes) - WORDS + 1)
    out = np.full(count, SEED, np.uint64)
    for place in range(min(WORDS, len(hashes))):
        out = _mixed(out ^ hashes[place : place + count])
    return np.unique(out)


def minima_of(shingles: np.ndarray) -> np.ndarray:
    """The least hash of a text's shingles under each permutation."""
    least = np.full(BANDS * ROWS, np.iinfo(np.uint64).max, np.uint64)
    for part in range(0, len(shingles), PORTION):
        least = np.minimum(least, (shingles[part : part + PORTION, None] * _PERMUTATIONS).min(0))
    return least


def keys_of(least: np.ndarray) -> np.ndarray:
    """The keys of a text's buckets."""
    keys = np.arange(BANDS, dtype=np.uint64)
    for row in least.reshape(BANDS, ROWS).T:
        keys = _mixed(keys ^ row)
    return keys.view(np.int64)


def sketch_of(least: np.ndarray) -> bytes:
    return _mixed(least).astype(np.uint8).tobytes()


def _signature(text: Column) -> Column:
    kind = pa.struct([("size", pa.int32()), ("keys", pa.list_(pa.int64())), ("sketch", pa.binary())])

    @F.arrow_udf("struct<size:int,keys:array<long>,sketch:binary>")
    def signature(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            out = []
            for text in texts:
                shingles = shingles_of(text.as_py())
                least = minima_of(shingles)
                out.append({"size": len(shingles), "keys": keys_of(least), "sketch": sketch_of(least)})
            yield pa.array(out, kind)

    return signature(text)


def _shingles(text: Column) -> Column:
    @F.arrow_udf("array<long>")
    def shingles(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            yield pa.array([shingles_of(t.as_py()).view(np.int64) for t in texts], pa.list_(pa.int64()))

    return shingles(text)


def are_similar(a: np.ndarray, b: np.ndarray) -> bool:
    """Whether two sets of shingles are near copies; in whole numbers, so the bound itself counts."""
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both * sum(SIMILARITY) >= (len(a) + len(b)) * SIMILARITY[0]


class Crowd:
    """Texts of one bucket and the groups that their links form."""

    def __init__(self, names: list[int], sketches: np.ndarray, shingles: list[np.ndarray], groups: list[int] | None = None) -> None:
        self.names, self.sketches, self.shingles = names, sketches, shingles
        first: dict[int, int] = {}
        self.group = list(range(len(names))) if groups is None else [first.setdefault(g, i) for i, g in enumerate(groups)]

    def root(self, text: int) -> int:
        while self.group[text] != text:
            self.group[text] = text = self.group[self.group[text]]
        return text

    def links(self, texts: range, others: Callable[[int], int]) -> list[tuple[int, int]]:
        """Links of each text with those in front of ``others(text)``, that join groups; the most alike are tried first."""
        found = []
        for text in texts:
            agreed = np.count_nonzero(self.sketches[: others(text)] == self.sketches[text], axis=1)
            maybe = np.flatnonzero(agreed >= MAYBE)
            for other in maybe[np.argsort(-agreed[maybe], kind="stable")].tolist():
                mine, its = self.root(text), self.root(other)
                if mine != its and are_similar(self.shingles[other], self.shingles[text]):
                    self.group[max(mine, its)] = min(mine, its)
                    found.append((self.names[other], self.names[text]))
        return found


def _crowd(rows: pa.Table, groups: list[int] | None = None) -> Crowd:
    sketches = np.frombuffer(b"".join(rows.column("sketch").to_pylist()), np.uint8).reshape(rows.num_rows, -1)
    lists = rows.column("shingles").combine_chunks()
    values, ends = lists.flatten().to_numpy(), np.cumsum(lists.value_lengths().to_numpy())
    return Crowd(rows.column("node").to_pylist(), sketches, np.split(values, ends[:-1]), groups)


_LINKS = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("own", pa.bool_())])


def _link_table(rows: list[tuple[int, int, bool]]) -> pa.Table:
    return pa.table([pa.array(list(c), k) for c, k in zip(zip(*rows), _LINKS.types)], schema=_LINKS) if rows else _LINKS.empty_table()


def _of_block(rows: pa.Table) -> pa.Table:
    """The links inside a block, and each text with the first one of its group."""
    crowd = _crowd(rows.sort_by("node"))
    found = crowd.links(range(rows.num_rows), lambda text: text)
    return _link_table([(*link, False) for link in found] + [(crowd.names[crowd.root(i)], n, True) for i, n in enumerate(crowd.names)])


def _between_blocks(rows: pa.Table) -> pa.Table:
    """Links between the texts of two blocks, whose groups are known."""
    rows = rows.sort_by([("own", "ascending"), ("node", "ascending")])
    crowd = _crowd(rows, rows.column("head").to_pylist())
    first = int((rows.column("own").to_numpy() == 0).sum())
    return _link_table([(*link, False) for link in crowd.links(range(first, rows.num_rows), lambda _: first)])


def _with_key(key: tuple, found: pa.Table) -> pa.Table:
    columns = [pa.array([k.as_py()] * found.num_rows, pa.int64()) for k in key]
    return pa.table([*columns, *found.columns], names=["key", "block", "a", "b", "own"])


def _pairs_of_small(members: DataFrame) -> DataFrame:
    """(a, b) of the texts that share a bucket of up to CROWD, and are of similar size."""
    few = members.where(F.col("n") <= CROWD)
    other = few.select("key", F.col("node").alias("b"), F.col("size").alias("other"))
    alike = F.least("size", "other") * SIMILARITY[1] >= F.greatest("size", "other") * SIMILARITY[0]
    return few.join(other, "key").where((F.col("node") < F.col("b")) & alike).select(F.col("node").alias("a"), "b").distinct()


def _links_of_crowds(crowds: DataFrame, nodes: DataFrame, sets: DataFrame) -> DataFrame:
    """(a, b) of links that connect the near copies in each bucket of more than CROWD."""
    block = F.pmod(F.xxhash64("node"), F.ceil(F.col("n") / BLOCK)).alias("block")
    texts = nodes.select("node", "sketch").join(sets, "node")
    blocks = store_once(crowds.select("key", "n", "node", block).join(texts, "node"), "crowds")
    inside = blocks.groupBy("key", "block").applyInArrow(lambda k, t: _with_key(k, _of_block(t)), "key long, block long, a long, b long, own boolean")
    inside = store_once(inside, "crowd-links")
    links = inside.where("NOT own").select("a", "b")
    several = blocks.where(F.col("n") > BLOCK)
    if several.isEmpty():
        return links
    heads = inside.where("own").select("key", F.col("a").alias("head"), F.col("b").alias("node"))
    # Each block meets each other one of its bucket.
    others = F.explode(F.sequence(F.lit(0), (F.ceil(F.col("n") / BLOCK) - 1).cast("long"))).alias("to")
    cells = several.join(heads, ["key", "node"]).select("key", "node", "head", "sketch", "shingles", "block", others).where("block != to")
    first, second = F.least("block", "to").alias("i"), F.greatest("block", "to").alias("j")
    cells = cells.select("key", "node", "head", "sketch", "shingles", first, second, (F.col("block") > F.col("to")).cast("int").alias("own"))
    between = cells.groupBy("key", "i", "j").applyInArrow(lambda _, t: _between_blocks(t), "a long, b long, own boolean")
    return links.unionByName(between.select("a", "b"))


def without_near_copies(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", searched: DataFrame | None = None
) -> DataFrame:
    """The documents that are no near copy of one in their group that stays, with all columns.

    ``searched`` are the documents that form groups, if not the same: those that ``docs`` was made of by a step that
    keeps the least id of other groups, so that both steps read a stored table.
    """
    name = F.unhex(F.sha2(F.coalesce(F.col(text_column), F.lit("")), 256))
    texts = (docs if searched is None else searched).select(F.col(id_column).alias("id"), name.alias("name"), F.col(text_column).alias("text")).where("id IS NOT NULL")
    signed = texts.select("id", "name", _signature(F.col("text")).alias("s")).select("id", "name", "s.*").where("size > 0")
    one = signed.groupBy("name").agg(F.min("id").alias("id"), F.max("id").alias("last"), *[F.first(c).alias(c) for c in ("size", "keys", "sketch")])
    nodes = store_once(one.withColumn("node", F.monotonically_increasing_id()), "signatures")

    rows = nodes.select("node", "size", F.explode("keys").alias("key"))
    shared = store_once(rows.groupBy("key").agg(F.count("*").alias("n")).where("n > 1"), "shared-keys")
    members = store_once(rows.join(shared, "key"), "buckets")
    pairs, crowds = store_once(_pairs_of_small(members), "named-pairs"), members.where(F.col("n") > CROWD)
    wanted = pairs.select(F.explode(F.array("a", "b")).alias("node")).unionByName(crowds.select("node")).distinct()
    # One row for each text, before any shingle is made.
    single = texts.join(nodes.join(wanted, "node").select("id", "name", "node"), ["id", "name"]).dropDuplicates(["node"])
    sets = store_once(single.select("node", _shingles(F.col("text")).alias("shingles")), "shingles")
    left, right = (sets.select(F.col("node").alias(n), F.col("shingles").alias(s)) for n, s in (("a", "x"), ("b", "y")))
    both, sizes = F.size(F.array_intersect("x", "y")), F.size("x") + F.size("y")
    links = pairs.join(left, "a").join(right, "b").where(both * sum(SIMILARITY) >= sizes * SIMILARITY[0]).select("a", "b")
    if not crowds.isEmpty():
        links = links.unionByName(_links_of_crowds(crowds, nodes, sets))
    classes = components(links.select(F.col("a").alias("u"), F.col("b").alias("v")))

    linked = classes.unionByName(classes.select(F.col("root").alias("node"), "root").distinct())
    linked = store_once(linked.join(nodes.select("node", "id", "name"), "node"), "groups")
    kept = linked.groupBy("root").agg(F.min(F.struct("id", "node"))["node"].alias("kept"))
    gone = linked.join(kept, "root").where("node != kept").select("name", F.lit(True).alias("gone"), "id")
    equal = nodes.where("last != id").join(gone, "name", "left_anti").select("name", F.lit(False).alias("gone"), "id")
    dropped = gone.unionByName(equal).select(F.col("name").alias("own name"), F.col("gone").alias("own gone"), F.col("id").alias("least id"))
    goes = F.col("own gone") | (F.col(id_column) != F.col("least id"))
    out = docs.join(dropped, (name == F.col("own name")) & F.col(id_column).isNotNull() & goes, "left_anti")
    return out.select(*docs.columns)
