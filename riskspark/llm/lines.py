"""Substring dedup by line or paragraph hashing.

Texts are cut at line breaks (paragraphs: at blank lines). A unit is normalised (A-Z lower-cased, runs of
ASCII whitespace to one space, ends stripped). 128-bit digests of all units with a word are grouped globally
(``min_words`` can spare shorter ones). The earliest ranked occurrence (least id, nulls last, then text
hash, then offset) stays, every other one is removed, within a document too. Removed units keep their
original code point offsets [start, end). The occurrence that stays shows, too: units that some other
document holds are counted, with their words, and those of ``long_words`` words or more by themselves.

Only digests that occur twice come back to the units, in a join that Spark may split where a line is hot.
Very long texts are cut unit by unit; the units of one text are together in its task.

Null texts are empty and keep nothing; empty tables give empty results. Rows of equal id and text rank
equally and share their result, so the occurrence that stays, stays in each of them.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskspark.llm.common import stored, unused, with_results

CUTS = {"line": re.compile(r"\n"), "paragraph": re.compile(r"\n[ \t\r\f\v]*\n\s*")}
FIELDS = (
    "n_units long, n_removed long, removed_chars long, removed_spans array<struct<start: int, end: int>>, "
    "n_repeated long, repeated_words long, n_long_repeated long, kept string"
)


def units_of(text: str | None, unit: str = "line") -> list[tuple[int, int]]:
    """[start, end) of each unit, without its separator."""
    if not text:
        return []
    out, at = [], 0
    for m in CUTS[unit].finditer(text):
        out.append((at, m.start()))
        at = m.end()
    return [*out, (at, len(text))]


def normalised(unit: str) -> bytes:
    return b" ".join(unit.encode().lower().split())


def digests(docs: DataFrame, unit: str, min_words: int) -> DataFrame:
    """hi, lo, id, th, start, end, words of each unit that counts."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, which = [], []
            for i, text in enumerate(batch.column(0).to_pylist()):
                for a, b in units_of(text, unit):
                    plain = normalised(text[a:b])
                    n = plain.count(b" ") + 1
                    if n >= min_words and plain:
                        d = xxhash.xxh3_128_intdigest(plain)
                        rows.append((d >> 64, d & 0xFFFFFFFFFFFFFFFF, a, b, n))
                        which.append(i)
            if not rows:
                continue
            hi, lo, *places = zip(*rows)
            made = [pa.array(np.array(x, np.uint64).view(np.int64)) for x in (hi, lo)]
            take = pa.array(which, pa.int64())
            yield pa.RecordBatch.from_arrays([*made, batch.column(1).take(take), batch.column(2).take(take), *[pa.array(x, pa.int32()) for x in places]], names=["hi", "lo", "id", "th", "start", "end", "words"])

    kind = docs.schema["id"].dataType.simpleString()
    return docs.select("text", "id", "th").mapInArrow(run, f"hi long, lo long, id {kind}, th long, start int, end int, words int")


def deduplicated(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", unit: str = "line", min_words: int = 1, long_words: int = 20) -> DataFrame:
    """Every column of ``docs``, then n_units, n_removed, removed_chars, removed_spans, n_repeated,
    repeated_words, n_long_repeated and kept (the units that stay, joined by the separator's line break)."""
    at = unused(docs, "__at")  # id, hash and text, whatever the columns are called
    keyed = docs.withColumn(at, F.struct(F.col(f"`{id_col}`").alias("id"), F.xxhash64(F.col(f"`{text_col}`")).alias("th"), F.col(f"`{text_col}`").alias("text")))
    units = digests(keyed.select(F.col(at)["text"].alias("text"), F.col(at)["id"].alias("id"), F.col(at)["th"].alias("th")), unit, min_words)
    row_rank = F.struct(F.col("id").isNull().alias("no_id"), F.col("id").alias("id"), F.col("th").alias("th"))
    rank = F.struct(row_rank.alias("row"), F.col("start").alias("start"))
    twice = units.groupBy("hi", "lo").agg(F.count("*").alias("n"), F.min(rank).alias("keep"), F.max(row_rank).alias("last")).where("n > 1")
    twice = stored(twice.select("hi", "lo", "keep", (F.col("keep.row") != F.col("last")).alias("elsewhere")), "lines-twice")  # a table: the join may split hot lines
    marked = units.join(twice, ["hi", "lo"]).select("id", "th", F.struct("start", "end", "words", (rank != F.col("keep")).alias("gone"), "elsewhere").alias("unit"))
    found = marked.where("unit.gone or unit.elsewhere").groupBy("id", "th").agg(F.sort_array(F.collect_set("unit")).alias("units"))
    between = "\n" if unit == "line" else "\n\n"

    def row(x: dict) -> tuple:
        cut, marks = units_of(x["t"], unit), x["u"] or ()
        gone = {(u["start"], u["end"]) for u in marks if u["gone"]}
        shared = [u["words"] for u in marks if u["elsewhere"]]
        kept = between.join(x["t"][a:b] for a, b in cut if (a, b) not in gone)
        return (len(cut), len(gone), sum(b - a for a, b in gone), [{"start": a, "end": b} for a, b in sorted(gone)],
                len(shared), sum(shared), sum(n >= long_words for n in shared), kept)

    joined = keyed.join(found, F.col(at)["id"].eqNullSafe(found["id"]) & (F.col(at)["th"] == found["th"]), "left")
    joined = joined.select(*[keyed[f"`{c}`"] for c in docs.columns], F.struct(F.col(at)["text"].alias("t"), found["units"].alias("u")).alias(at))
    return with_results(joined, at, row, FIELDS).drop(at)
