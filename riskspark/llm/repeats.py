"""Suffix-array substring dedup: distributed prefix doubling over names of growing length.

A position's name for length 2h is made of the rank pair (name of length h there, name of length h at
offset h); names of equal length are equal exactly when the strings are (64 bits choose candidates, 128
bits decide). Names are doubled in numpy within a task (8, 13, 25, 50, 100, 200 bytes); Spark groups the
names, drops what is unique and carries on with the rest:

* Round 1, half the threshold. Shuffling every byte position would move tens of bytes per byte of text,
  so one position per window takes part: of the 101 positions of a 200-byte string where 100 bytes
  start, the one of least name. Equal strings choose the same one, so they are of one class, and a
  string whose class is a single position is unique.
* Round 2, the threshold. A chosen position's context is all strings that chose it. Contexts that occur
  again are done: all of them repeats. Where contexts of a class differ, one copy of each goes on.
  Classes of up to ``class_contexts`` contexts are ranked in one task each, which holds all strings that
  could be equal; strings of larger classes become rows of their own and are grouped by Spark.

No pairs are formed: groups are counted by partial aggregation, and joins back to positions may be
split where a name is hot. Spans of a document are gathered per document only.

Null texts are empty. Documents shorter than the threshold keep all bytes. Rows of equal id and text
are counted as two texts and share their result. Very long texts are handled in pieces of a million
positions. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from riskspark.llm.common import joined_by_key, schema_of, stored, with_results

PIECE = 1 << 20
KEY = ("k1", "k2")
FIELDS = "n_bytes long, n_removed long, n_spans long, kept_sha256 string, removed_spans array<struct<start: int, end: int>>"
# odd multipliers of the pair function, one pair per independent name
MIXES = tuple((np.uint64(a), np.uint64(b)) for a, b in ((0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F), (0xD6E8FEB86659FD93, 0xA0761D6478BD642F)))


def pair_names(left: np.ndarray, right: np.ndarray, mix: tuple[np.uint64, np.uint64]) -> np.ndarray:
    x = (left ^ (left >> np.uint64(31))) * mix[0] + (right ^ (right >> np.uint64(29))) * mix[1]
    return x ^ (x >> np.uint64(32))


def names(raw: bytes, length: int, mix: tuple[np.uint64, np.uint64] = MIXES[0]) -> np.ndarray:
    """Name of the ``length`` bytes (8 at least) from each position on that has so many."""
    if len(raw) < length:
        return np.zeros(0, np.uint64)
    if length == 8:
        return np.ndarray((len(raw) - 7,), "<u8", raw, 0, (1,)).copy()
    half = max(8, (length + 1) // 2)
    at, offset = names(raw, half, mix), length - half
    return pair_names(at[:-offset], at[offset:], mix)


def choices(raw: bytes, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Chosen position's name, and the first and last start of the strings of ``length`` that chose it."""
    made = names(raw, length // 2)
    # least name by its upper 40 bits, leftmost on ties
    least = (made & ~np.uint64(0xFFFFFF)) | (np.arange(len(made), dtype=np.uint64) & np.uint64(0xFFFFFF))
    width, h = length - length // 2 + 1, 1
    while 2 * h <= width:
        least = np.minimum(least[:-h], least[h:])
        h *= 2
    if width > h:
        least = np.minimum(least[: h - width], least[width - h :])
    chosen = (least & np.uint64(0xFFFFFF)).astype(np.int64)
    first = np.flatnonzero(np.concatenate(([True], chosen[1:] != chosen[:-1])))
    last = np.concatenate((first[1:], [len(chosen)])) - 1
    return made[chosen[first]].view(np.int64), first, last


def position_rows(docs: DataFrame, length: int) -> DataFrame:
    """name, ctx, k1, k2, pos for each chosen position; pos is first start * 256 + further starts."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cols: list[list] = [[], [], [], [], []]
            size = 0
            for text, k1, k2 in zip(*(c.to_pylist() for c in batch.columns)):
                raw = text.encode() if text else b""
                for at in range(0, max(len(raw) - length + 1, 0), PIECE):
                    part = raw[at : at + PIECE + length - 1]
                    name, first, last = choices(part, length)
                    ctx = [xxhash.xxh64_intdigest(part[a:b]) for a, b in zip(first.tolist(), (last + length).tolist())]
                    for c, v in zip(cols, (name, np.array(ctx, np.uint64).view(np.int64), np.full(len(name), k1), np.full(len(name), k2), (first + at) * 256 + (last - first))):
                        c.append(v)
                    size += len(name)
                if size > 200_000:
                    yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in cols], names=["name", "ctx", *KEY, "pos"])
                    cols, size = [[], [], [], [], []], 0
            if size:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in cols], names=["name", "ctx", *KEY, "pos"])

    return docs.select("__text", *KEY).mapInArrow(run, "name long, ctx long, k1 long, k2 long, pos long")


STRINGS = "name long, weight int, k1 long, k2 long, start long, part binary, hi long, lo long"


def string_rows(docs: DataFrame, contested: DataFrame, length: int) -> DataFrame:
    """A row per contested context with its bytes or, in large classes, per string with its 128-bit name."""
    one = F.struct("name", F.col("first.pos").alias("pos"), F.least("n", F.lit(2)).cast("int").alias("weight"), "large")
    lists = contested.groupBy("first.k1", "first.k2").agg(F.collect_list(one).alias("of"))
    arrow = to_arrow_schema(schema_of(STRINGS))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: list[tuple] = []
            for text, k1, k2, of in zip(*(c.to_pylist() for c in batch.columns)):
                raw = text.encode()
                for x in of:
                    first, more = x["pos"] // 256, x["pos"] % 256
                    part = raw[first : first + more + length]
                    if x["large"]:
                        hi, lo = (names(part, length, m).view(np.int64).tolist() for m in MIXES)
                        rows += [(x["name"], x["weight"], k1, k2, first + i, None, h, w) for i, (h, w) in enumerate(zip(hi, lo))]
                    else:
                        rows.append((x["name"], x["weight"], k1, k2, first, part, None, None))
                    if len(rows) > 50_000:
                        yield made(rows)
                        rows = []
            if rows:
                yield made(rows)

    def made(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(zip(*rows), arrow)], schema=arrow)

    return docs.join(lists, list(KEY)).select("__text", *KEY, "of").mapInArrow(run, STRINGS)


def class_spans(classes: DataFrame, length: int) -> DataFrame:
    """k1, k2, start, end of runs of repeated strings in contexts that occur once; a row holds a whole class."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for members in batch.column(0).to_pylist():
                hi, lo = (np.concatenate([names(x["part"], length, m) for x in members]) for m in MIXES)
                sizes = [len(x["part"]) - length + 1 for x in members]
                weight = np.repeat([x["weight"] for x in members], sizes)
                order = np.lexsort((lo, hi))
                group = np.cumsum(np.concatenate(([0], (np.diff(hi[order].view(np.int64)) != 0) | (np.diff(lo[order].view(np.int64)) != 0))))
                again = np.empty(len(order), bool)
                again[order] = np.bincount(group, weights=weight[order])[group] > 1
                at = 0
                for x, size in zip(members, sizes):
                    if x["weight"] == 1:
                        edges = np.flatnonzero(np.diff(np.concatenate(([0], again[at : at + size], [0]))))
                        rows += [(x["k1"], x["k2"], x["start"] + a, x["start"] + b - 1 + length) for a, b in edges.reshape(-1, 2).tolist()]
                    at += size
            cols = list(zip(*rows)) or [()] * 4
            yield pa.RecordBatch.from_arrays([pa.array(list(c), pa.int64()) for c in cols], names=[*KEY, "start", "end"])

    return classes.mapInArrow(run, "k1 long, k2 long, start long, end long")


def repeated_spans(docs: DataFrame, length: int, class_contexts: int) -> DataFrame:
    """k1, k2, __spans: unmerged [start, end) runs covered by repeated strings, for documents that have any."""
    rows = position_rows(docs, length)
    again = rows.groupBy("name").agg(F.count("*").alias("n"), F.min("ctx").alias("c0"), F.max("ctx").alias("c1")).where("n > 1")
    again = stored(again.select("name", (F.col("c0") != F.col("c1")).alias("mixed")), "repeats-names")  # a table: the join may split hot names
    hit = stored(rows.join(again, "name"), "repeats-positions")
    mixed = hit.where("mixed")
    contexts = stored(mixed.groupBy("name", "ctx").agg(F.count("*").alias("n"), F.min(F.struct(*KEY, "pos")).alias("first")), "repeats-contexts")
    large = stored(contexts.groupBy("name").agg(F.count("*").alias("c")).where(F.col("c") > class_contexts).select("name", F.lit(True).alias("large")), "repeats-large")
    contested = joined_by_key(contexts, large, ["name"]).withColumn("large", F.coalesce("large", F.lit(False)))
    strings = stored(string_rows(docs, contested, length), "repeats-strings")

    first, further = F.shiftright("pos", 8), F.col("pos") % 256
    whole = hit.where("not mixed").unionByName(mixed.join(contexts.where("n > 1").select("name", "ctx"), ["name", "ctx"], "left_semi"))
    whole = whole.select(*KEY, first.alias("start"), (first + further + length).alias("end"))
    classes = strings.where("part is not null").groupBy("name").agg(F.collect_list(F.struct("weight", *KEY, "start", "part")).alias("members"))
    local = class_spans(classes.select("members"), length)
    rest = strings.where("part is null")
    twice = stored(rest.groupBy("hi", "lo").agg(F.sum("weight").alias("n")).where("n > 1").select("hi", "lo"), "repeats-twice")
    single = rest.where("weight = 1").join(twice, ["hi", "lo"], "left_semi").select(*KEY, "start", (F.col("start") + length).alias("end"))
    span = F.struct(F.col("start").cast("int").alias("start"), F.col("end").cast("int").alias("end"))
    return stored(whole.union(local).union(single).groupBy(*KEY).agg(F.collect_list(span).alias("__spans")), "repeats-spans")


def cut(raw: bytes, spans: list[dict] | None) -> tuple[list[tuple[int, int]], bytes]:
    merged: list[list[int]] = []
    for a, b in sorted((s["start"], s["end"]) for s in spans or ()):
        if merged and a <= merged[-1][1]:
            merged[-1][1] = max(merged[-1][1], b)
        else:
            merged.append([a, b])
    kept, last = [], 0
    for a, b in merged:
        kept.append(raw[last:a])
        last = b
    return [(a, b) for a, b in merged], b"".join([*kept, raw[last:]])


def deduplicated(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = 200, class_contexts: int = 1_024, keep_bytes: bool = False) -> DataFrame:
    """Every column of ``docs``, then n_bytes, n_removed, n_spans, kept_sha256 and removed_spans (byte offsets);
    with ``keep_bytes`` also the remaining bytes as ``kept``."""
    if not 16 <= length <= 500:
        raise ValueError("length is from 16 to 500 bytes")
    keyed = docs.withColumns({"k1": F.xxhash64(id_col), "k2": F.xxhash64(text_col, F.octet_length(text_col)), "__text": F.col(text_col)})
    spans = repeated_spans(keyed.select("__text", *KEY), length, class_contexts)

    def row(x: dict) -> tuple:
        raw = x["t"].encode() if x["t"] else b""
        merged, kept = cut(raw, x["s"])
        out = (len(raw), len(raw) - len(kept), len(merged), hashlib.sha256(kept).hexdigest(), [{"start": a, "end": b} for a, b in merged])
        return (*out, kept) if keep_bytes else out

    joined = keyed.join(spans, list(KEY), "left").withColumn("__in", F.struct(F.col("__text").alias("t"), F.col("__spans").alias("s")))
    return with_results(joined.select(*docs.columns, "__in"), "__in", row, FIELDS + ", kept binary" * keep_bytes).drop("__in")
