"""Benchmark decontamination: a broadcast set of normalised test n-grams scanned over token windows.

Words are runs of ``[0-9a-z]`` and non-ASCII characters after lower-casing A-Z. An item's windows are
its runs of ``n`` consecutive words; an item of fewer words, but not none, is one window. A document
word inside any occurrence of a window is hit. Hashes of all windows of a text are made in numpy and
looked up; every candidate is verified word by word, so hash collisions cannot show.

The benchmark is cut into blocks of at most ``block_words`` words. Each block is one broadcast and one
pass over the texts, chained without a shuffle, so a benchmark of any size fits the executors.

Nulls and empty texts have no words and are never hit; null or empty items have no windows. A null
item id is reported as the text ``null``. Repeated rows each get their own result. Empty tables give
empty results, an empty benchmark gives no hits.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskspark.llm.common import with_results

WORDS = re.compile(rb"[0-9a-z\x80-\xff]+")
FIELDS = "n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean, hit_items array<string>, hit_spans array<struct<start: int, end: int>>"
MIX = np.uint64(0x9E3779B97F4A7C15)


def words_of(text: str | None) -> list[bytes]:
    return WORDS.findall(text.encode().lower()) if text else []


def window_hashes(codes: np.ndarray, n: int) -> np.ndarray:
    """A hash of each run of n words from the words' codes."""
    size = len(codes) - n + 1
    out = np.zeros(max(size, 0), np.uint64)
    for k in range(n if size > 0 else 0):
        out = out * MIX + codes[k : k + size]
    return out


def codes_of(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(hash, words), np.int64, len(words)).view(np.uint64)


class Windows:
    """Windows of a block of items, by length: the sorted hashes and, to verify, words -> item ids."""

    def __init__(self, items: list[tuple[str, str | None]], n: int):
        self.items: dict[int, dict[tuple, set[str]]] = {}
        for item, text in items:
            words = words_of(text)
            size = min(n, len(words))
            for p in range(len(words) - size + 1 if size else 0):
                self.items.setdefault(size, {}).setdefault(tuple(words[p : p + size]), set()).add(item)
        self.hashes = {
            size: np.unique(np.concatenate([window_hashes(codes_of(list(w)), size) for w in found]))
            for size, found in self.items.items()
        }

    def hits(self, words: list[bytes]) -> tuple[set[str], list[tuple[int, int]]]:
        """Items with an occurring window, and the hit word runs [first, last)."""
        found, runs, codes = set(), [], codes_of(words)
        for size, known in self.hashes.items():
            made = window_hashes(codes, size)
            at = np.minimum(np.searchsorted(known, made), len(known) - 1)
            for p in np.flatnonzero(known[at] == made).tolist():
                if items := self.items[size].get(tuple(words[p : p + size])):
                    found |= items
                    runs.append((p, p + size))
        return found, merged(runs)


def merged(runs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for a, b in sorted(runs):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [(a, b) for a, b in out]


def blocks_of(benchmark: DataFrame, id_col: str, text_col: str, block_words: int) -> Iterator[list[tuple[str, str | None]]]:
    """Blocks of items of at most ``block_words`` words (or one item), read partition by partition."""
    block, size = [], 0
    rows = benchmark.select(F.coalesce(F.col(id_col).cast("string"), F.lit("null")), F.col(text_col))
    for item, text in rows.toLocalIterator():
        words = len(text.split()) + text.count("-") if text else 0
        if block and size + words > block_words:
            yield block
            block, size = [], 0
        block.append((item, text))
        size += words
    if block:
        yield block


def scan(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_id: str = "item_id", item_text: str = "text",
         n: int = 10, block_words: int = 500_000) -> DataFrame:
    """Every document with its hits: counts, items, and hit spans as byte offsets of the UTF-8 text."""
    out, first = docs, True
    for block in blocks_of(benchmark, item_id, item_text, block_words):
        out = with_hits(out, block, text_col, n, first)
        first = False
    return with_hits(out, [], text_col, n, True) if first else out


def with_hits(docs: DataFrame, block: list[tuple[str, str | None]], text_col: str, n: int, first: bool) -> DataFrame:
    shared = docs.sparkSession.sparkContext.broadcast(block)
    if first:
        return with_results(docs, text_col, row_function(shared, n), FIELDS)
    # later blocks: what earlier ones found travels with the row
    row, prior = row_function(shared, n), docs.withColumn("__prior", F.struct(F.col(text_col).alias("t"), "hit_items", "hit_spans"))
    return with_results(prior, "__prior", lambda x: row(x["t"], x["hit_items"], x["hit_spans"]), FIELDS).drop("__prior")


def row_function(shared, n: int) -> Callable[..., tuple]:
    made: list[Windows] = []

    def row(text: str | None, items: list[str] | None = None, spans: list[dict] | None = None) -> tuple:
        if not made:
            made.append(Windows(shared.value, n))
        raw = text.encode().lower() if text else b""
        at = [m.span() for m in WORDS.finditer(raw)] if spans else None
        words = WORDS.findall(raw)
        found, runs = made[0].hits(words) if words else (set(), [])
        if runs or spans:
            at = at or [m.span() for m in WORDS.finditer(raw)]
            if spans:
                order = {a: i for i, (a, _) in enumerate(at)}
                ends = {b: i + 1 for i, (_, b) in enumerate(at)}
                runs = merged(runs + [(order[s["start"]], ends[s["end"]]) for s in spans])
        names = sorted(found | set(items or ()))
        return (len(words), sum(b - a for a, b in runs), len(names), hashlib.sha256(",".join(names).encode()).hexdigest(),
                bool(runs), names, [{"start": at[a][0], "end": at[b - 1][1]} for a, b in runs])

    return row


def decontaminate(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", n: int = 10, mode: str = "document") -> DataFrame:
    """The columns of ``docs``, without contaminated documents, or with the hit spans cut out of their texts."""
    if mode not in ("document", "span"):
        raise ValueError("mode is document or span")
    found = scan(docs, benchmark, text_col, n=n)
    if mode == "document":
        return found.where("not contaminated").select(*docs.columns)
    spans = found.withColumn("__in", F.struct(F.col(text_col).alias("t"), "hit_spans"))
    return with_results(spans, "__in", lambda x: (cut_spans(x["t"], x["hit_spans"]),), f"`{text_col}` string").select(*docs.columns)


def cut_spans(text: str | None, spans: list[dict]) -> str | None:
    if not spans:
        return text
    raw, out, last = text.encode(), [], 0
    for s in spans:
        out.append(raw[last : s["start"]])
        last = s["end"]
    return b"".join([*out, raw[last:]]).decode()
