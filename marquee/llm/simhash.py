"""SimHash near-duplicates through covering locality-sensitive hashing.

A fingerprint has 64 bits; two link when at most ``radius`` of them differ. Each bit position gets
a code word of ``radius + 1`` bits, and each non-zero vector v of that length makes a mask: the
positions whose code word has an odd product with v. However a pair's at most ``radius`` differing
positions lie, some v is orthogonal to all their code words, so in that table the masked
fingerprints are equal: no linked pair is missed, whatever the data. ``copies`` repeats the
positions, each copy with its own code words, to lengthen the masks for very large tables
(radius 3: 15 masks of 32 to 35 bits with one copy, 127 masks, most of them of over 40 bits, with two).

Work per fingerprint is bounded. Equal fingerprints count once. A bucket of up to ``CROWD``
fingerprints is compared inside one row. A larger one, such as a crowd of near copies, is not
compared at all: each of its members names the points that lie within half the radius, rounded
down (its near points) and rounded up (its far points); who shares a point with one for whom it is
near lies within the radius, and every linked pair has such a point. A point has at most
a few thousand neighbours, so no group grows with the data, and the links are stars, not pairs.

Defined results: null text and text without words have fingerprint zero, and link like any other.
Rows without an id take part in classes but never name them; repeated rows are kept.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import regex
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from marquee.llm.components import components
from marquee.session import store_once

BITS = 64
SEED = 42
CROWD = 1000
STRETCH = 1 << 20
_BLANK = regex.compile(rb"[\x20\x09-\x0D]")


def _stretches(data: bytes) -> Iterator[bytes]:
    """The bytes in pieces of about STRETCH, cut at blanks."""
    at = 0
    while len(data) - at > 2 * STRETCH and (cut := _BLANK.search(data, at + STRETCH)):
        yield data[at : cut.start()]
        at = cut.end()
    yield data[at:] if at else data


def fingerprint_of(text: str | None, words: int) -> int:
    """The SimHash of one text as a signed 64-bit number."""
    digest, seed = xxhash.xxh64_digest, SEED
    total, counts, carried, any_full = 0, np.zeros(BITS, np.int64), [], False
    for piece in _stretches((text or "").encode().lower()):
        found = [*carried, *piece.split()]
        if len(found) < words:
            carried = found
            continue
        any_full = True
        joined = b" ".join(found)
        lengths = np.fromiter(map(len, found), np.int64, len(found))
        ends = np.cumsum(lengths + 1) - 1
        starts = ends - lengths
        spans = zip(starts[: len(found) - words + 1].tolist(), ends[words - 1 :].tolist())
        hashes = np.frombuffer(b"".join([digest(joined[a:b], seed) for a, b in spans]), np.uint8).reshape(-1, 8)
        for part in range(0, len(hashes), 1 << 14):
            counts += np.unpackbits(hashes[part : part + (1 << 14)], axis=1).sum(0, dtype=np.int64)
        total += len(hashes)
        carried = found[len(found) - words + 1 :]
    if not any_full:
        if not carried:
            return 0
        counts += np.unpackbits(np.frombuffer(digest(b" ".join(carried), seed), np.uint8))
        total = 1
    return int.from_bytes(np.packbits(counts * 2 > total).tobytes(), "big", signed=True)


def fingerprint(text: Column, words: int = 3) -> Column:
    """The 64-bit SimHash of the whole text over its shingles of ``words`` words."""

    @F.arrow_udf("long")
    def simhash(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            yield pa.array([fingerprint_of(t.as_py(), words) for t in texts], pa.int64())

    return simhash(text)


def covering_masks(radius: int, copies: int = 1) -> list[int]:
    """Masks such that any ``radius`` bit positions are all left out of at least one of them."""
    length = copies * radius + 1
    # Code words: the non-zero ones in turn, each copy at another offset, so that all masks are alike in size.
    codes = [[1 + (p + c * 7) * (1 + 2 * c) % ((1 << length) - 1) for c in range(copies)] for p in range(BITS)]
    masks = set()
    for v in range(1, 1 << length):
        masks.add(sum(1 << p for p in range(BITS) if any((code & v).bit_count() % 2 for code in codes[p])))
    return sorted(masks)


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def _patterns(spark: SparkSession, masks: list[int], radius: int) -> DataFrame:
    """(table, flip, near): the changes, outside the table's mask, that name the points of a crowded bucket."""
    near, far = radius // 2, radius - radius // 2
    rows = [
        (t, _signed(sum(1 << p for p in places)), len(places) <= near)
        for t, mask in enumerate(masks)
        for size in range(far + 1)
        for places in combinations([p for p in range(BITS) if not mask >> p & 1], size)
    ]
    return spark.createDataFrame(rows, "table int, flip long, near boolean")


def _close(radius: int):
    """For each list of fingerprints: a link from each to the least of those it reaches inside the list."""

    @F.arrow_udf("array<struct<u:long,v:long>>")
    def linked(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        kind = pa.list_(pa.struct([("u", pa.int64()), ("v", pa.int64())]))
        for lists in batches:
            out = []
            for x in lists:
                f = np.sort(np.asarray(x.values, dtype=np.int64))
                near = np.bitwise_count((f[:, None] ^ f[None, :]).view(np.uint64)) <= radius
                label = np.arange(len(f))
                while True:
                    lower = np.where(near, label[None, :], len(f)).min(1)
                    if (lower == label).all():
                        break
                    label = lower
                out.append([{"u": int(f[i]), "v": int(f[j])} for i, j in enumerate(label) if i != j])
            yield pa.array(out, kind)

    return linked


def links(prints: DataFrame, radius: int = 3, copies: int = 1, crowd: int = CROWD) -> DataFrame:
    """Links (u, v) between distinct fingerprints (one column, fp) that join exactly the pairs within ``radius``,
    directly or through others."""
    spark = prints.sparkSession
    masks = covering_masks(radius, copies)
    tables = F.array(*[F.struct(F.lit(t).alias("table"), F.lit(_signed(m)).alias("mask")) for t, m in enumerate(masks)])
    rows = prints.select("fp", F.explode(tables).alias("m")).select(
        "fp", "m.table", F.col("fp").bitwiseAND(F.col("m.mask")).alias("key")
    )
    sizes = rows.groupBy("table", "key").agg(F.count("*").alias("n"), F.min("fp").alias("u"), F.max("fp").alias("v"))
    sizes = store_once(sizes.where("n > 1"), "buckets")
    apart = lambda a, b: F.bit_count(F.col(a).bitwiseXOR(F.col(b)))
    pairs = sizes.where("n = 2").where(apart("u", "v") <= radius).select("u", "v")
    larger = rows.join(sizes.where("n > 2").select("table", "key", "n"), ["table", "key"])
    # The explicit exchange lets adaptive execution split a crowded bucket in the join above.
    partitions = max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
    small = larger.where(F.col("n") <= crowd).repartition(partitions, "table", "key")
    listed = small.groupBy("table", "key").agg(F.collect_list("fp").alias("fps"))
    stars = listed.select(F.explode(_close(radius)("fps")).alias("l")).select("l.u", "l.v")
    # At most 2^(radius + 1) tables times the choices of half the radius among 64 positions, whatever the data.
    points = (
        larger.where(F.col("n") > crowd)
        .select("table", "fp")
        .join(F.broadcast(_patterns(spark, masks, radius)), "table")
        .select("fp", "near", F.col("fp").bitwiseXOR(F.col("flip")).alias("point"))
    )
    hubs = points.where("near").groupBy("point").agg(F.min("fp").alias("v"))
    through = points.join(hubs, "point").where("fp != v").select(F.col("fp").alias("u"), "v")
    return pairs.unionByName(stars).unionByName(through)


def _rooted_classes(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", words: int = 3, radius: int = 3, copies: int = 1
) -> DataFrame:
    """(doc_id, fp, root, component_id) for every row; the root tells classes of one name apart."""
    prints = store_once(
        docs.select(F.col(id_column).alias("doc_id"), fingerprint(F.col(text_column), words).alias("fp")), "fingerprints"
    )
    distinct = store_once(prints.groupBy("fp").agg(F.min("doc_id").alias("least")), "distinct-fingerprints")
    roots = components(links(distinct.select("fp"), radius, copies))
    rooted = distinct.join(roots, distinct.fp == roots.node, "left").select(
        "fp", "least", F.coalesce("root", "fp").alias("root")
    )
    named = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    classes = rooted.join(named, "root").select("fp", "root", "component_id")
    return prints.join(classes, "fp").select("doc_id", "fp", "root", "component_id")


def near_duplicate_classes(docs: DataFrame, **options) -> DataFrame:
    """(doc_id, fingerprint, component_id) for every row: the class is named by its smallest id."""
    return _rooted_classes(docs, **options).select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id"
    )


def keep_one_per_class(docs: DataFrame, text_column: str = "text", words: int = 3, **options) -> DataFrame:
    """The documents whose id names their class, one row for each class, with all columns.

    A row without an id can't be named and stays. Only the ids that are not simply kept are joined with
    the documents: those that name no class, and the repeated ones, whose rows are told apart by fingerprint.
    """
    classes = _rooted_classes(docs, text_column=text_column, words=words, **options).where("doc_id IS NOT NULL")
    names = F.col("doc_id") == F.col("component_id")
    naming = classes.groupBy("doc_id").agg(F.count("*").alias("rows"), F.count_if(names).alias("named"))
    others = store_once(naming.where("rows != 1 OR named != 1"), "other-documents")
    kept = docs.join(others.select("doc_id"), "doc_id", "left_anti").select(*docs.columns)
    repeated = others.where("rows > 1 AND named > 0").select("doc_id")
    if repeated.isEmpty():
        return kept
    naming_rows = classes.where(names).join(repeated, "doc_id").select("doc_id", F.col("fp").alias("own print"), F.col("root").alias("own class"))
    naming_rows = store_once(naming_rows.distinct(), "naming-rows")
    marked = docs.join(repeated, "doc_id", "left_semi").withColumn("own print", fingerprint(F.col(text_column), words))
    single = marked.join(naming_rows, ["doc_id", "own print"]).dropDuplicates(["doc_id", "own class"])
    return kept.unionByName(single.select(*docs.columns))
