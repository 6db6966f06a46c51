"""SimHash near-duplicates with pigeonhole blocks.

Fingerprint: XXH64 (seed 42) of each space-joined word shingle, repeats included; a bit is set when it
is set in over half of the hashes. Fingerprints link at ``max_bits`` or fewer differing bits.

Candidates: a fingerprint is cut into ``blocks`` pieces. Two linked ones agree on at least
blocks - max_bits of them, so every choice of so many pieces is a key, and linked fingerprints share a
key. With 7 blocks a key has 27 or 28 bits and there are 35 keys; larger tables take 8 blocks (32 bits,
70 keys). Equal fingerprints are one node from the start, so copies never meet in a key.

Verification by key size, every link kept:
* two fingerprints: the Hamming distance of the pair, on the aggregate itself;
* up to ``bucket_rows``: all distances of the bounded bucket in numpy, an edge per fingerprint;
* more: two fingerprints at 4 bits or fewer share a midpoint within 2 bits of both. Each emits its
  midpoints over the bits outside the key; a midpoint has boundedly many neighbours, and all of them
  are mutually reachable, so an edge to the least suffices. Rows grow with the bucket, not its square.

Documents without words (null, empty, blanks) have fingerprint zero and link like any other. Null ids
stay rows, and a class of null ids only has a null component. Repeated rows get equal results.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskspark.llm.common import components, joined_by_key, stored, with_results

BITS = 64


def fingerprint(text: str | None, size: int = 4) -> int:
    """The fingerprint as a signed 64-bit number."""
    words = text.encode().lower().split() if text else []
    if not words:
        return 0
    joined, at, starts = b" ".join(words), 0, []
    for w in words:
        starts.append(at)
        at += len(w) + 1
    starts.append(at)
    digest, last = xxhash.xxh64_intdigest, max(len(words) - size, 0)
    hashes = np.array([digest(joined[a : b - 1], 42) for a, b in zip(starts[: last + 1], starts[min(size, len(words)) :])], np.uint64)
    ones = np.zeros(BITS, np.int64)
    for part in range(0, len(hashes), 1 << 16):  # bounded memory for very long texts
        ones += np.unpackbits(hashes[part : part + (1 << 16)].astype(">u8").view(np.uint8)).reshape(-1, BITS).sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes)).view(">i8")[0])


def fingerprints(docs: DataFrame, text_col: str = "text", size: int = 4) -> DataFrame:
    """Every column of ``docs`` and fp."""
    return with_results(docs, text_col, lambda t: (fingerprint(t, size),), "fp long")


def keys(fp: Column, blocks: int, max_bits: int) -> list[tuple[int, Column]]:
    """(mask, masked fingerprint) for each choice of blocks - max_bits pieces."""
    cuts = [round(i * BITS / blocks) for i in range(blocks + 1)]
    pieces = [((1 << b) - 1) ^ ((1 << a) - 1) for a, b in zip(cuts, cuts[1:])]
    out = []
    for chosen in combinations(pieces, blocks - max_bits):
        mask = sum(chosen)
        mask -= (1 << BITS) * (mask >> (BITS - 1))
        out.append((mask, fp.bitwiseAND(F.lit(mask))))
    return out


def star_edges(members: pa.ListArray, max_bits: int) -> pa.Array:
    """For each bounded list of fingerprints, edges that connect exactly what its links connect."""
    out = []
    for one in members.to_pylist():
        fps = np.array(one, np.int64).view(np.uint64)
        near = np.bitwise_count(fps[:, None] ^ fps[None, :]) <= max_bits
        edges, left = [], np.ones(len(fps), bool)
        while left.any():  # breadth first: each reached fingerprint gets one edge
            start = int(np.argmax(left))
            front, left[start] = [start], False
            while front:
                i = front.pop()
                reached = np.flatnonzero(near[i] & left)
                left[reached] = False
                edges += [{"a": int(fps[i].astype(np.int64)), "b": int(fps[j].astype(np.int64))} for j in reached]
                front += reached.tolist()
        out.append(edges)
    return pa.array(out, pa.list_(pa.struct([("a", pa.int64()), ("b", pa.int64())])))


def midpoint_edges(rows: DataFrame, max_bits: int) -> DataFrame:
    """Edges within over-full keys (columns mask, key, fp) through shared midpoints."""
    if max_bits % 2:
        raise ValueError("midpoints need an even number of bits")
    level = rows.select("mask", "fp", F.col("fp").alias("mid"), F.lit(-1).alias("last"))
    made = level
    for _ in range(max_bits // 2):  # one more flipped bit, higher than the last one and outside the key
        level = level.select("mask", "fp", "mid", F.explode(F.filter(
            F.sequence(F.lit(0), F.lit(BITS - 1)), lambda b: (b > F.col("last")) & (F.getbit(F.col("mask"), b) == 0))).alias("last"))
        level = level.select("mask", "fp", F.expr("mid ^ shiftleft(1L, last)").alias("mid"), "last")
        made = made.union(level)
    # members of a midpoint: distinct, at most 1 + 37 + 666 of them for 27 key bits
    return (
        made.groupBy("mask", "mid").agg(F.collect_set("fp").alias("members")).where("size(members) > 1")
        .select(F.array_min("members").alias("a"), F.explode("members").alias("b")).where("a <> b")
    )


def links(fps: DataFrame, blocks: int = 7, max_bits: int = 4, bucket_rows: int = 256) -> DataFrame:
    """Edges (a, b) between distinct fingerprints (column fp) that give the components of all links."""
    made = keys(F.col("fp"), blocks, max_bits)
    keyed = fps.select("fp", F.explode(F.array(*[F.struct(F.lit(m).alias("mask"), k.alias("key")) for m, k in made])).alias("k")).select("fp", "k.mask", "k.key")
    sizes = stored(
        keyed.groupBy("mask", "key").agg(F.count("*").alias("n"), F.min("fp").alias("a"), F.max("fp").alias("b")).where("n > 1"), "simhash-keys")
    pairs = sizes.where("n = 2").where(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= max_bits).select("a", "b")
    more = stored(keyed.join(sizes.where("n > 2").select("mask", "key", "n"), ["mask", "key"]), "simhash-members")
    edge = T.ArrayType(T.StructType([T.StructField("a", T.LongType()), T.StructField("b", T.LongType())]))
    stars = F.arrow_udf(lambda x: star_edges(x, max_bits), edge)
    small = (
        more.where(F.col("n") <= bucket_rows).groupBy("mask", "key").agg(F.collect_list("fp").alias("fps"))
        .select(F.explode(stars("fps")).alias("e")).select("e.a", "e.b")
    )
    large = midpoint_edges(more.where(F.col("n") > bucket_rows).select("mask", "key", "fp"), max_bits)
    return stored(pairs.union(small).union(large).distinct(), "simhash-edges")


def classed(docs: DataFrame, id_col: str, text_col: str, size: int, blocks: int, max_bits: int, bucket_rows: int) -> tuple[DataFrame, DataFrame]:
    """Rows (id_col, fp), and per fingerprint the least row of its class: fp, least (no_id, id, text_hash)."""
    made = stored(
        fingerprints(docs.select(F.col(id_col), F.col(text_col), F.xxhash64(text_col).alias("text_hash")), text_col, size)
        .select(id_col, "text_hash", "fp"), "simhash-fps")
    first = F.min(F.struct(F.col(id_col).isNull().alias("no_id"), F.col(id_col).alias("id"), "text_hash"))
    distinct = stored(made.groupBy("fp").agg(first.alias("first")), "simhash-nodes")
    nodes = components(links(distinct.select("fp"), blocks, max_bits, bucket_rows)).withColumnRenamed("node", "fp")
    linked = stored(distinct.join(nodes, "fp"), "simhash-linked")  # only fingerprints that have links
    least = joined_by_key(linked, stored(linked.groupBy("root").agg(F.min("first").alias("least")), "simhash-roots"), ["root"])
    return made, stored(
        distinct.join(least.select("fp", "least"), "fp", "left").select("fp", F.coalesce("least", "first").alias("least")), "simhash-classes")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = 4, blocks: int = 7, max_bits: int = 4, bucket_rows: int = 256) -> DataFrame:
    """One row per document: id_col, fp (long), component_id (least id reachable)."""
    made, classes = classed(docs, id_col, text_col, size, blocks, max_bits, bucket_rows)
    return joined_by_key(made, classes.select("fp", F.col("least.id").alias("component_id")), ["fp"]).select(id_col, "fp", "component_id")


def deduplicated(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = 4, blocks: int = 7, max_bits: int = 4, bucket_rows: int = 256) -> DataFrame:
    """One document of each class stays: the one of the least id (null ids last, then by text hash)."""
    made, classes = classed(docs, id_col, text_col, size, blocks, max_bits, bucket_rows)
    keep = stored(classes.select(F.col("least.id").alias("__id"), F.col("least.text_hash").alias("__hash")).distinct(), "simhash-keep")
    on = docs[id_col].eqNullSafe(F.col("__id")) & (F.xxhash64(docs[text_col]) == F.col("__hash"))
    kept = docs.join(keep, on, "left_semi")
    if made.groupBy(id_col, "text_hash").count().where("count > 1").isEmpty():
        return kept
    return kept.dropDuplicates([id_col, text_col])  # rows repeated as a whole
