"""Plain single-machine versions of the contracts, to hold the queries against."""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import Counter, defaultdict

import xxhash


def sha256(x: bytes | str) -> str:
    return hashlib.sha256(x.encode() if isinstance(x, str) else x).hexdigest()


def repeats(docs: list[tuple], length: int = 200) -> dict:
    """id -> (n_bytes, n_removed, n_spans, kept_sha256)."""
    raws = [(i, (t or "").encode()) for i, t in docs]
    seen: Counter = Counter(r[p : p + length] for _, r in raws for p in range(len(r) - length + 1))
    out = {}
    for i, r in raws:
        gone = bytearray(len(r))
        for p in range(len(r) - length + 1):
            if seen[r[p : p + length]] > 1:
                gone[p : p + length] = b"\1" * length
        kept = bytes(b for b, g in zip(r, gone) if not g)
        spans = len(re.findall(rb"\x01+", bytes(gone)))
        out[i] = (len(r), sum(gone), spans, sha256(kept))
    return out


def fingerprint(text: str | None) -> int:
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not w:
        return 0
    hs = [xxhash.xxh64_intdigest(" ".join(w[p : p + 4]).encode(), seed=42) for p in range(max(len(w) - 3, 1))]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def simhash(docs: list[tuple], bits: int = 4) -> dict:
    """id -> (fingerprint hex, component)."""
    import numpy as np

    fps = {i: fingerprint(t) for i, t in docs}
    distinct = np.array(sorted(set(fps.values())), np.uint64)
    parent = list(range(len(distinct)))

    def find(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a in range(len(distinct)):
        for b in np.flatnonzero(np.bitwise_count(distinct[a] ^ distinct[a + 1 :]) <= bits):
            parent[find(a)] = find(a + 1 + int(b))
    index = {int(f): k for k, f in enumerate(distinct)}
    least: dict = {}
    for i, f in fps.items():
        root = find(index[f])
        least[root] = min(least.get(root, i), i)
    return {i: (f"{f:016x}", least[find(index[f])]) for i, f in fps.items()}


def decontaminate(docs: list[tuple], items: list[tuple]) -> dict:
    """id -> (n_words, n_hit, n_items, items_sha256, contaminated)."""
    words = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    windows = defaultdict(set)
    for item, t in items:
        w = words(t)
        for p in range(max(len(w) - 9, 1) if w else 0):
            windows[tuple(w[p : p + 10])].add(item)
    sizes = {len(w) for w in windows}
    out = {}
    for i, t in docs:
        w = words(t)
        hit, found = set(), set()
        for n in sizes:
            for p in range(len(w) - n + 1):
                if got := windows.get(tuple(w[p : p + n])):
                    found |= got
                    hit |= set(range(p, p + n))
        out[i] = (len(w), len(hit), len(found), sha256(",".join(sorted(map(str, found)))), bool(hit))
    return out


def secrets(text: str | None) -> tuple:
    """n_assign, n_access, n_hex, base_sha256."""
    found = []
    for k, (pattern, group, least) in enumerate((
        (r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 8), (r"AKIA[A-Z0-9]+", 0, 16), (r"[0-9a-f]+", 0, 32))):
        found += [(m.start(), k, m.end()) for m in re.finditer(pattern, text or "", re.A) if len(m[group]) >= least]
    names = ("assign", "access", "hex")
    n = Counter(k for _, k, _ in found)
    return n[0], n[1], n[2], sha256(",".join(f"{names[k]}:{a}:{b}" for a, k, b in sorted(found)))


def quality_base(text: str | None) -> tuple:
    w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    three = Counter(zip(w, w[1:], w[2:]))
    again = {q for p in range(len(w) - 2) if three[tuple(w[p : p + 3])] > 1 for q in range(p, p + 3)}
    dup, seen = 0, set()
    for line in (text or "").split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    failed = len(w) < 50 or 100 * len(again) > 50 * len(w)
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text or "")), dup, len(again), failed


def lines(docs: list[tuple]) -> dict:
    """id -> (n_units, n_removed, removed_chars, spans, kept_sha256, n_repeated, repeated_words, n_long_repeated)."""
    def key_of(line: str) -> str:
        return " ".join(re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), line)))

    holders = defaultdict(set)
    for i, t in docs:
        for line in (t or "").split("\n"):
            holders[key_of(line)].add(i)
    seen: set = set()
    out = {}
    for i, t in sorted(docs, key=lambda d: d[0]):
        at, gone, kept, n, shared = 0, [], [], 0, []
        for line in (t or "").split("\n") if t else []:
            n += 1
            key = key_of(line)
            if key and len(holders[key]) > 1:
                shared.append(len(key.split(" ")))
            if key and key in seen:
                gone.append((at, at + len(line)))
            else:
                kept.append(line)
                seen.add(key)
            at += len(line) + 1
        out[i] = (
            n, len(gone), sum(b - a for a, b in gone), ",".join(f"{a}:{b}" for a, b in gone), sha256("\n".join(kept)),
            len(shared), sum(shared), sum(w >= 20 for w in shared))
    return out


def crc(x) -> int:
    return zlib.crc32(str(x).encode())


def merkle(docs: list[tuple], tampered=lambda i: i is not None and crc(i) % 5 == 0) -> list[tuple]:
    """(doc_id, source, lang, n_chars, text) -> rows of doc_id, leaf, subroot, root, proof, folded, verified."""
    def enc(v):
        return "-" if v is None else f"{len(str(v).encode())}:{v}"

    def leaf(i, s, lang, n, t):
        return sha256("".join(map(enc, (i, s, lang, n, t))))

    def tree(leaves):
        """root, and per leaf its [(before, after)]."""
        paths, at, level = [[] for _ in leaves], list(range(len(leaves))), leaves
        while len(level) > 1:
            for k, a in enumerate(at):
                run = level[a // 16 * 16 : a // 16 * 16 + 16]
                paths[k].append(("".join(run[: a % 16]), "".join(run[a % 16 + 1 :])))
            level = [sha256("".join(level[a : a + 16])) for a in range(0, len(level), 16)]
            at = [a // 16 for a in at]
        return level[0], paths

    by = defaultdict(list)
    for d in docs:
        by[d[1]].append(d)
    names = sorted(by, key=lambda s: (s is not None, (s or "").encode()))
    made = {}
    for s in names:
        rows = sorted(by[s], key=lambda d: (d[0] is not None, d[0] or 0, leaf(*d)))
        made[s] = (rows, *tree([leaf(*d) for d in rows]))
    if not names:
        return []
    root, tops = tree([made[s][1] for s in names])
    out = []
    for s, top in zip(names, tops):
        rows, sub, paths = made[s]
        for d, path in zip(rows, paths):
            cur = leaf(*d[:4], re.sub("[A-Z]", lambda m: m[0].lower(), d[4]) if d[4] is not None and tampered(d[0]) else d[4])
            for a, b in path + top:
                cur = sha256(a + cur + b)
            out.append((d[0], leaf(*d), sub, root, sha256("".join(a + b for a, b in path + top)), cur, cur == root))
    return out


def planted(i, text: str | None) -> list[str]:
    w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    if i is None or crc(i) % 10 or not w:
        return w
    g, n = crc(i) // 10, len(w)
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return w[:a] + [w[a + (k - a) % p] for k in range(a, n)]


def runs(w: list, least: int = 12) -> list[tuple[int, int, int]]:
    """(start, length, period): every period's stretches of equal words, the least period of each."""
    best: dict[tuple[int, int], int] = {}
    for q in range(1, len(w) // 2 + 1):
        a = 0
        for i in range(len(w) - q + 1):
            if i == len(w) - q or w[i] != w[i + q]:
                if i - a >= q and i - a + q >= least:
                    best.setdefault((a, i - a + q), q)
                a = i + 1
    return sorted((a, n, q) for (a, n), q in best.items())


def run_row(i, text: str | None) -> tuple:
    w = planted(i, text)
    found = sorted(runs(w), key=lambda r: (r[0], r[2]))
    gone = {k for a, n, q in found for k in range(a + q, a + n)}
    top = min(found, key=lambda r: (-r[1], r[0], r[2]), default=None)
    return (
        i, len(found), *((top[0], top[1], top[2], 1000 * top[1] // top[2]) if top else (None,) * 4),
        sha256("".join(f"{a},{n},{q}\n" for a, n, q in found)), sha256(" ".join(x for k, x in enumerate(w) if k not in gone)))
