"""Periodic runs of words, by a suffix automaton with link-cut access.

A run is a stretch of consecutive words with smallest period q, of at least max(``least``, 2q) words, that
cannot be extended on either side. A text's words are appended to a suffix automaton. The nodes on the
path from a prefix's node to the root of the suffix links are the suffixes of the prefix; each carries
the end of its last occurrence. Access, as in a link-cut tree, recolours that path with the new end.
Before, the path is made of segments of one colour, each a splay tree, and access passes the segments
from the bottom to the top. A segment coloured j, whose longest string has m words, met at end i, is a
string that ended at j and ends at i: with i - j <= m the last 2 (i - j) words are a square. Its period is
the least one, since the last occurrence was the nearest, and every run shows in this way at the end of
its first square. The square is extended to the run, once for each run.

Texts are independent, so Spark splits the table and nothing is shuffled. In a run of L >= max(12, 2q) words
L - q >= 6 words equal those q further on, so each of its words lies in a sequence of ``least`` // 2 words
that occurs twice in the text. Words outside such sequences belong to no run; they are passed over, and
the automaton sees each stretch between them whole (hashes decide, so a collision only adds words).

Bounds: the automaton of the longest stretch of one text is in memory, some 600 bytes a word; access
costs amortised O(log n) segments. Null, empty and blank texts have no words and no runs. Repeated rows
get equal results. A null id gives no rewriting. An empty table gives an empty result. Input columns
named like a result column are replaced by it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskspark.llm.common import unused, with_results

LEAST = 12
MIX = np.uint64(0x9E3779B97F4A7C15)
FIELDS = (
    "n_words long, runs array<struct<start: long, length: long, period: long>>, kept_spans array<struct<start: long, end: long>>, collapsed string"
)
Run = tuple[int, int, int]


def words_of(text: str | None) -> list[bytes]:
    return text.encode().split() if text else []


def numbered(words: list[bytes]) -> list[int]:
    """Equal words get equal numbers."""
    seen: dict[bytes, int] = {}
    return [seen.setdefault(w, len(seen)) for w in words]


def stretches(codes: list[int], least: int = LEAST) -> list[tuple[int, int]]:
    """[a, b) of at least ``least`` words whose every word lies in a sequence of least // 2 words that occurs twice."""
    size = max(least // 2, 1)
    if len(codes) < least:
        return []
    x = np.array(codes, np.uint64) * MIX
    n = len(codes) - size + 1
    hashes = np.zeros(n, np.uint64)
    for k in range(size):
        hashes = (hashes ^ (hashes >> np.uint64(29))) * MIX + x[k : k + n]
    order = np.argsort(hashes, kind="stable")
    same = np.zeros(n, bool)
    equal = hashes[order[1:]] == hashes[order[:-1]]
    same[order[1:][equal]] = True
    same[order[:-1][equal]] = True
    if not same.any():
        return []
    edge = np.zeros(len(codes) + 1, np.int64)
    starts = np.flatnonzero(same)
    np.add.at(edge, starts, 1)
    np.add.at(edge, starts + size, -1)
    covered = np.concatenate([[False], np.cumsum(edge[:-1]) > 0, [False]])
    a, b = np.flatnonzero(covered[1:] & ~covered[:-1]), np.flatnonzero(covered[:-1] & ~covered[1:])
    return [(int(s), int(e)) for s, e in zip(a, b) if e - s >= least]


def automaton(codes: list[int]) -> tuple[list[int], list[int], list[int]]:
    """Suffix automaton: the longest string and the suffix link of each node, and the node of each prefix."""
    longest, link, ahead, prefixes, last = [0], [-1], [{}], [], 0
    for c in codes:
        cur = len(longest)
        longest.append(longest[last] + 1)
        link.append(0)
        ahead.append({})
        p = last
        while p >= 0 and c not in ahead[p]:
            ahead[p][c] = cur
            p = link[p]
        if p >= 0:
            q = ahead[p][c]
            if longest[p] + 1 == longest[q]:
                link[cur] = q
            else:
                clone = len(longest)
                longest.append(longest[p] + 1)
                link.append(link[q])
                ahead.append(ahead[q].copy())
                while p >= 0 and ahead[p].get(c) == q:
                    ahead[p][c] = clone
                    p = link[p]
                link[q] = link[cur] = clone
        last = cur
        prefixes.append(cur)
    return longest, link, prefixes


class Colours:
    """Last ends along suffix-link paths: each segment of one colour is a splay tree ordered by depth.

    ``up`` is a node's splay parent, or the node above its segment for a splay root; a segment's colour is
    kept at its splay root.
    """

    def __init__(self, link: list[int]):
        self.up = list(link)
        self.left, self.right = [-1] * len(link), [-1] * len(link)
        self.colour = [-1] * len(link)

    def splay(self, x: int) -> None:
        up, left, right, colour = self.up, self.left, self.right, self.colour
        while True:
            p = up[x]
            if p < 0 or (left[p] != x and right[p] != x):
                return
            g = up[p]
            outer = g >= 0 and (left[g] == p or right[g] == p)
            if outer:
                first = p if (left[g] == p) == (left[p] == x) else x
                for y in (first, x):
                    self._rotate(y)
            else:
                colour[x] = colour[p]  # p was the splay root
                self._rotate(x)
                return
            top = up[x]
            if top < 0 or (left[top] != x and right[top] != x):
                colour[x] = colour[g]  # g was the splay root
                return

    def _rotate(self, x: int) -> None:
        up, left, right = self.up, self.left, self.right
        p = up[x]
        g = up[p]
        if left[p] == x:
            b = left[p] = right[x]
            right[x] = p
        else:
            b = right[p] = left[x]
            left[x] = p
        if b >= 0:
            up[b] = p
        up[p] = x
        up[x] = g
        if g >= 0:
            if left[g] == p:
                left[g] = x
            elif right[g] == p:
                right[g] = x

    def access(self, x: int, end: int) -> Iterator[tuple[int, int]]:
        """Recolours the path from ``x`` to the root; yields (deepest node, old colour) of each segment of it."""
        up, right, colour = self.up, self.right, self.colour
        below, at = -1, x
        while at >= 0:
            self.splay(at)
            yield at, colour[at]
            cut = right[at]
            if cut >= 0:
                colour[cut] = colour[at]  # what hangs below keeps its last end
            right[at] = below
            below, at = at, up[at]
        self.splay(x)
        colour[x] = end


def runs_of(codes: list[int], least: int = LEAST) -> list[Run]:
    """(start, length, period) of the runs of a sequence, by start, then period."""
    longest, link, prefixes = automaton(codes)
    colours = Colours(link)
    out: list[Run] = []
    known: dict[int, int] = {}  # period -> end of the last run with it
    n = len(codes)
    for i, node in enumerate(prefixes):
        for deepest, j in colours.access(node, i):
            q = i - j
            if j < 0 or q > longest[deepest] or known.get(q, -1) >= i:
                continue
            a, b = i - 2 * q + 1, i + 1
            while a > 0 and codes[a - 1] == codes[a - 1 + q]:
                a -= 1
            while b < n and codes[b] == codes[b - q]:
                b += 1
            known[q] = b - 1
            if b - a >= max(least, 2 * q):
                out.append((a, b - a, q))
    return sorted(out, key=lambda r: (r[0], r[2]))


def runs_in(words: list[bytes], least: int = LEAST) -> list[Run]:
    codes = numbered(words)
    found = [(a + s, length, q) for a, b in stretches(codes, least) for s, length, q in runs_of(codes[a:b], least)]
    return sorted(found, key=lambda r: (r[0], r[2]))


def kept_spans(n: int, runs: list[Run]) -> list[tuple[int, int]]:
    """[start, end) of the words that no run holds after its first period."""
    out, at = [], 0
    for a, b in sorted((s + q, s + length) for s, length, q in runs):
        if a > at:
            out.append((at, a))
        at = max(at, b)
    return [*out, (at, n)] if at < n else out


def found(docs: DataFrame, text_col: str = "text", least: int = LEAST) -> DataFrame:
    """Every column of ``docs``, then n_words, runs, kept_spans (of words) and collapsed (the kept words, one space between)."""
    def row(text: str | None) -> tuple:
        words = words_of(text)
        runs = runs_in(words, least)
        spans = kept_spans(len(words), runs)
        kept = b" ".join(w for a, b in spans for w in words[a:b]).decode()
        return (len(words), [dict(zip(("start", "length", "period"), r)) for r in runs], [{"start": a, "end": b} for a, b in spans], kept)

    return with_results(docs, text_col, row, FIELDS)


def with_planted(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", share: int = 10) -> DataFrame:
    """``docs`` whose texts, for ids with crc32 divisible by ``share``, end in a repetition.

    With h the crc32 of the decimal id and g = h // 10, each word i >= a of the n words becomes original word
    a + (i - a) % p, where a = g % n and p = 1 + (n - a) // (3 + g % 8). Other texts stay as they are.
    """
    def row(x: dict) -> tuple:
        text, h = x["t"], x["h"]
        words = words_of(text) if h is not None and h % share == 0 else []
        if not words:
            return (text,)
        n, g = len(words), h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        return (b" ".join(words[:a] + [words[a + (i - a) % p] for i in range(a, n)]).decode(),)

    crc = F.crc32(F.col(f"`{id_col}`").cast("string").cast("binary"))
    given = docs.withColumn(unused(docs, "__in"), F.struct(F.col(f"`{text_col}`").alias("t"), crc.alias("h")))
    return with_results(given, given.columns[-1], row, f"`{text_col}` string").select(*[F.col(f"`{c}`") for c in docs.columns])
