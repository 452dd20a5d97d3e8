"""Sharding by best-fit-decreasing bin packing.

Documents with equal texts form a group that is never divided. Groups sorted by size enter the bin
whose remaining capacity is the tightest that still holds them; the bins wait in a search tree
ordered by remaining capacity. The number of shards is given, so the smallest capacity at which
best fit needs no more bins than that is searched by halving; shards then come out near equal.

Nothing unbounded reaches the driver. Groups of at least ``1 / FINE`` of a shard are packed one by
one; there are at most ``FINE`` times the number of shards of them. Smaller groups are tied into
``PARCELS`` parcels by the hash of their text, and each parcel is packed as one item. A group
belongs to one parcel or is its own item, so it still enters one shard whole. A group larger than a
fair share gets a bin of its own size; nothing can divide it.

Slots number the rows of a shard without gaps: rows are counted by (shard, bucket of the id), the
counts summed up in front, and only the distinct rows of one bucket are numbered in one task.
Rows that are equal throughout are counted and get neighbouring slots.

Defined results: a null text has size 8 and checksum 0, and nulls form one group, apart from the
empty text. An empty table gives an empty result.
"""

from __future__ import annotations

from bisect import bisect_left, insort

from pyspark.sql import DataFrame, Window, functions as F

from marquee.session import store_once

FINE = 128
PARCELS = 8192
ROW_BYTES = 8
BUCKET_ROWS = 20_000
STRETCH = 100_000  # repeats of one row numbered at a time


class OpenBins:
    """Bins in a balanced search structure, ordered by remaining capacity, then number."""

    def __init__(self, bins: int, capacity: int) -> None:
        self.room = [(capacity, b) for b in range(bins)]

    def place(self, size: int) -> int | None:
        """The bin with the least room that holds the item, now with less room; None if there is none."""
        at = bisect_left(self.room, (size, -1))
        if at == len(self.room):
            return None
        room, bin_ = self.room.pop(at)
        insort(self.room, (room - size, bin_))
        return bin_


def best_fit(sizes: list[int], bins: int, capacity: int) -> list[int] | None:
    """The bin of each of the sizes, which come in falling order; None if they need more bins."""
    open_bins, placed = OpenBins(bins, capacity), []
    for size in sizes:
        if (bin_ := open_bins.place(size)) is None:
            return None
        placed.append(bin_)
    return placed


def best_fit_decreasing(items: dict, bins: int) -> dict:
    """Item to bin, for the smallest capacity at which best-fit decreasing fills no more than the given bins."""
    order = sorted(items, key=lambda i: (-items[i], str(i)))
    sizes = [items[i] for i in order]
    low = max([-(-sum(sizes) // bins), *sizes[:1]], default=0)
    high = max(low, 2 * low)
    while best_fit(sizes, bins, high) is None:
        high *= 2
    while low < high:
        middle = (low + high) // 2
        if best_fit(sizes, bins, middle) is None:
            low = middle + 1
        else:
            high = middle
    return dict(zip(order, best_fit(sizes, bins, high)))


def pack_shards(docs: DataFrame, shards: int = 24, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(doc_id, size, text_crc32, law, shard, slot, grown_shard) for every row; the law is ``bytes``."""
    spark = docs.sparkSession
    text = F.col(text_column)
    rows = docs.select(
        F.col(id_column).alias("doc_id"),
        (F.coalesce(F.octet_length(text), F.lit(0)) + ROW_BYTES).cast("long").alias("size"),
        F.coalesce(F.crc32(text), F.lit(0)).cast("long").alias("text_crc32"),
        F.coalesce(F.unhex(F.sha2(text, 256)), F.lit(b"")).alias("group"),
    ).withColumn("parcel", F.pmod(F.xxhash64("group"), F.lit(PARCELS)).cast("int"))
    rows = store_once(rows, "sharding-rows")
    groups = store_once(rows.groupBy("group", "parcel").agg(F.sum("size").alias("bytes")), "sharding-groups")
    total = groups.agg(F.sum("bytes")).first()[0] or 0
    large = F.col("bytes") * (shards * FINE) >= total
    # At most shards * FINE large groups and PARCELS parcels, whatever the data.
    items = {("group", bytes(r[0])): r[1] for r in groups.where(large).select("group", "bytes").collect()}
    parcels = groups.where(~large).groupBy("parcel").agg(F.sum("bytes")).collect()
    items |= {("parcel", r[0]): r[1] for r in parcels}
    bins = best_fit_decreasing(items, shards)
    own = spark.createDataFrame([(i, b) for (kind, i), b in bins.items() if kind == "group"], "group binary, own int")
    tied = spark.createDataFrame([(i, b) for (kind, i), b in bins.items() if kind == "parcel"], "parcel int, tied int")
    placed = (
        rows.join(F.broadcast(own), "group", "left")
        .join(F.broadcast(tied), "parcel", "left")
        .select("doc_id", "size", "text_crc32", F.coalesce("own", "tied").alias("shard"))
    )
    buckets = max(1, -(-rows.count() // (shards * BUCKET_ROWS)))
    # All parts of the row choose its bucket, so rows that repeat one id do not pile up unless they are equal throughout.
    placed = placed.withColumn("bucket", F.pmod(F.xxhash64("doc_id", "size", "text_crc32"), F.lit(buckets)).cast("long"))
    numbered = _numbered(placed)
    return numbered.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def _numbered(placed: DataFrame) -> DataFrame:
    """A gapless number from 0 for the rows of each shard.

    Equal rows (a document stored many times) are counted, not gathered: each distinct row gets the
    stretch of numbers that its repeats need, and the repeats are dealt out inside the row.
    """
    counted = placed.groupBy("shard", "bucket", "doc_id", "size", "text_crc32").agg(F.count("*").alias("repeats"))
    counted = store_once(counted, "sharding-counts")
    per_bucket = counted.groupBy("shard", "bucket").agg(F.sum("repeats").alias("n"))
    in_front = Window.partitionBy("shard").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    firsts = per_bucket.select("shard", "bucket", F.coalesce(F.sum("n").over(in_front), F.lit(0)).alias("first"))
    order = Window.partitionBy("shard", "bucket").orderBy("doc_id", "size", "text_crc32")
    before = F.coalesce(F.sum("repeats").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    numbered = counted.withColumn("before", before).join(firsts, ["shard", "bucket"])
    numbered = numbered.withColumn("first", F.col("first") + F.col("before")).drop("before")
    again = lambda length: F.explode(F.sequence(F.lit(0), (length - 1).cast("int"))).alias("again")
    columns = ["doc_id", "size", "text_crc32", "shard"]
    few = numbered.where(F.col("repeats") <= STRETCH).select(*columns, "first", again(F.col("repeats")))
    # A row that is repeated very often is first cut into stretches, which are dealt to all tasks.
    stretch = F.explode(F.sequence(F.lit(0).cast("long"), F.col("repeats") - 1, F.lit(STRETCH).cast("long"))).alias("from")
    many = numbered.where(F.col("repeats") > STRETCH).select(*columns, "first", "repeats", stretch)
    many = many.repartition("doc_id", "from").select(*columns, (F.col("first") + F.col("from")).alias("first"), again(F.least(F.col("repeats") - F.col("from"), F.lit(STRETCH))))
    return few.unionByName(many).select(*columns, (F.col("first") + F.col("again")).cast("long").alias("slot"))
