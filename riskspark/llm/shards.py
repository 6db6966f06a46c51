"""Sharding by Karmarkar-Karp differencing, for groups of rows that must stay together.

Differencing takes the two partial partitions of largest spread (largest less smallest part) and adds
them oppositely ordered, until one is left. It runs on a bounded number of items:
* every group of more than 1 / bundles of all bytes: at most ``bundles`` such groups exist;
* the other groups, bundled by hash into ``bundles`` sums.
So the differencing sees at most twice ``bundles`` numbers whatever the table holds. Group sizes,
bundle sums, the shard of each row and its slot are Spark aggregations and joins with the item table.

Size is the UTF-8 bytes of the text (null: none) plus 8. Groups are equal texts; null texts are one
group, apart from empty ones. Slots are gapless from 0 in each shard: rows are dealt by hash into
buckets, bucket counts are summed up, and only the rows of one bucket are ranked together (by id, then
checksum and size), so a hot group spreads over all buckets. Repeated rows take neighbouring slots. An
empty table gives an empty result.
"""

from __future__ import annotations

import heapq
from itertools import count

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskspark.llm.common import stored

RESULTS = ("size", "text_crc32", "law", "shard", "slot", "grown_shard")


def differencing(items: list[tuple[object, int]], parts: int) -> dict[object, int]:
    """Part of each item (key, size); a partial partition is its sums and, per part, a tree of members."""
    order = count()
    heap = []
    for key, size in items:
        sums = [(0, None)] * (parts - 1) + [(size, key)]  # ascending; a leaf is its key
        heap.append((-(size if parts > 1 else 0), next(order), sums))
    heapq.heapify(heap)
    while len(heap) > 1:
        (_, _, one), (_, _, two) = heapq.heappop(heap), heapq.heappop(heap)
        merged = [
            (a + b, x if y is None else y if x is None else (Pair(x, y)))
            for (a, x), (b, y) in zip(one, reversed(two))
        ]
        merged.sort(key=lambda p: p[0])
        heapq.heappush(heap, (merged[0][0] - merged[-1][0], next(order), merged))
    out: dict[object, int] = {}
    for part, (_, tree) in enumerate(heap[0][2] if heap else []):
        stack = [tree] if tree is not None else []
        while stack:
            node = stack.pop()
            if isinstance(node, Pair):
                stack += (node.left, node.right)
            else:
                out[node] = part
    return out


class Pair:
    __slots__ = ("left", "right")

    def __init__(self, left, right):
        self.left, self.right = left, right


def sharded(docs: DataFrame, shards: int = 24, id_col: str = "doc_id", text_col: str = "text", bundles: int = 16_384, buckets: int = 1_024) -> DataFrame:
    """Every row's id, size, text_crc32, law, shard, slot and grown_shard (null: the law is ``bytes``)."""
    text = F.col(text_col)
    rows = stored(docs.select(
        F.col(id_col), (F.coalesce(F.octet_length(text), F.lit(0)) + 8).cast("long").alias("size"),
        F.crc32(F.coalesce(text, F.lit("")).cast("binary")).alias("text_crc32"), F.coalesce(F.md5(text.cast("binary")), F.lit("null")).alias("grp"),
        F.when(F.col(id_col).isNull(), F.monotonically_increasing_id()).alias("spread"),  # rows without an id are dealt out, too
    ), "shard-rows")
    groups = stored(rows.groupBy("grp").agg(F.sum("size").alias("bytes")), "shard-groups")
    total = groups.agg(F.sum("bytes")).first()[0] or 0
    bundle = F.pmod(F.xxhash64("grp"), F.lit(bundles)).cast("int")
    is_heavy = F.col("bytes") * bundles > F.lit(total)
    heavy = groups.where(is_heavy).select("grp", "bytes").collect()  # fewer than bundles
    light = groups.where(~is_heavy).groupBy(bundle.alias("bundle")).agg(F.sum("bytes").alias("bytes")).collect()
    items = sorted([(r["grp"], r["bytes"]) for r in heavy] + [(r["bundle"], r["bytes"]) for r in light], key=str)
    part = differencing(items, shards)
    spark = docs.sparkSession
    of_heavy = spark.createDataFrame([(k, s) for k, s in part.items() if isinstance(k, str)], "grp string, heavy_shard int")
    of_bundle = spark.createDataFrame([(k, s) for k, s in part.items() if isinstance(k, int)], "bundle int, light_shard int")
    placed = (
        rows.withColumn("bundle", bundle).join(F.broadcast(of_heavy), "grp", "left").join(F.broadcast(of_bundle), "bundle", "left")
        .withColumn("shard", F.coalesce("heavy_shard", "light_shard"))
        .withColumn("bucket", F.pmod(F.xxhash64(id_col, "text_crc32", "spread"), F.lit(buckets)).cast("int"))
    )
    # at most shards x buckets counts
    counts = placed.groupBy("shard", "bucket").agg(F.count("*").alias("n"))
    offsets = stored(counts.withColumn("before", F.sum("n").over(Window.partitionBy("shard").orderBy("bucket")) - F.col("n")).drop("n"), "shard-offsets")
    within = Window.partitionBy("shard", "bucket").orderBy(F.col(id_col).asc_nulls_last(), "text_crc32", "size")
    return (
        placed.withColumn("place", F.row_number().over(within)).join(F.broadcast(offsets), ["shard", "bucket"])
        .select(id_col, "size", "text_crc32", F.lit("bytes").alias("law"), "shard", (F.col("before") + F.col("place") - 1).alias("slot"),
                F.lit(None).cast("int").alias("grown_shard"))
    )
