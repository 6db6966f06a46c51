"""Merkle manifest of a dataset, its trees stored in van Emde Boas layout.

A row's leaf is the SHA-256 of its encoded columns. The leaves of a key (source), by ascending id, form a
tree of fanout 16; the keys' roots, by ascending key (null first), form one more such tree, whose root
names the whole dataset. A proof is the siblings of a leaf, run by run up to the root; folding a leaf with
its siblings gives the root again unless the leaf was changed.

Layout: a tree is cut into aligned blocks of at most ``block_steps`` steps (three: 4,096 leaves). A block is one
row, its nodes an array in van Emde Boas order: the levels are split at half height, the upper subtree
comes first, then the lower subtrees in order, each laid out likewise. ``address`` gives a node's place
from its depth and index alone; building a block and fetching siblings both go through it. Block roots are
the leaves of the next tier of blocks, so a key of any size is log4096 tables. Slots behind the last
node of a ragged block are not stored.

Scale: rows are ranked within their key by one range exchange on (key, id), which splits a hot key, and
per-partition counts; then only digests move, grouped by block, so no group exceeds 4,096 rows. Proofs
come down from the root: a block is joined with the path above it and its leaves are folded in one task.

Null columns are encoded as ``-``, other values as byte count, colon, value, so no two rows share an
encoding. Null keys are a key of their own, null ids come first. Rows of equal key and id are ordered by
leaf; equal rows are equal leaves and get proofs of their own places. A key of one row has its leaf as
its root. An empty table has no rows and no root (None). Extra columns are neither hashed nor returned.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import lru_cache, reduce
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskspark.llm.common import joined_by_key, stored

FANOUT, BLOCK_STEPS, WIDTH = 16, 3, 32
COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
PATH = "array<struct<before: string, after: string>>"
SIBLINGS = pa.list_(pa.struct([("before", pa.string()), ("after", pa.string())]))


def digest(text: str) -> str:
    return sha256(text.encode()).hexdigest()


# ---- layout -------------------------------------------------------------------------------------------

def nodes_of(levels: int) -> int:
    """Nodes of a complete tree of so many levels."""
    return (FANOUT**levels - 1) // (FANOUT - 1)


def address(levels: int, depth: int, index: int) -> int:
    """Place of the node ``index`` of level ``depth`` (root 0) of a complete tree in van Emde Boas order."""
    if levels == 1:
        return 0
    upper = levels // 2
    if depth < upper:
        return address(upper, depth, index)
    below = FANOUT ** (depth - upper)
    tree, rest = divmod(index, below)
    return nodes_of(upper) + tree * nodes_of(levels - upper) + address(levels - upper, depth - upper, rest)


@lru_cache(maxsize=None)
def places(height: int) -> tuple[tuple[int, ...], ...]:
    """Addresses by depth and index of a block of ``height`` steps."""
    return tuple(tuple(address(height + 1, d, i) for i in range(FANOUT**d)) for d in range(height + 1))


def widths(n: int, height: int) -> list[int]:
    """Nodes at each depth, root first, above ``n`` leaves."""
    return [-(-n // FANOUT ** (height - d)) for d in range(height + 1)]


class Block:
    """The nodes of an aligned subtree."""

    def __init__(self, height: int, n: int, nodes: bytes | bytearray):
        self.height, self.n, self.nodes, self.at = height, n, nodes, places(height)

    @classmethod
    def build(cls, leaves: list[str], height: int) -> Block:
        at, counts = places(height), widths(len(leaves), height)
        made = cls(height, len(leaves), bytearray(WIDTH * (1 + max(at[d][m - 1] for d, m in enumerate(counts)))))
        for i, leaf in enumerate(leaves):
            made._put(height, i, leaf)
        for depth in range(height - 1, -1, -1):
            for i in range(counts[depth]):
                made._put(depth, i, digest("".join(made.run(depth + 1, i))))
        return made

    def _put(self, depth: int, i: int, value: str) -> None:
        a = WIDTH * self.at[depth][i]
        self.nodes[a : a + WIDTH] = bytes.fromhex(value)

    def node(self, depth: int, i: int) -> str:
        a = WIDTH * self.at[depth][i]
        return self.nodes[a : a + WIDTH].hex()

    def run(self, depth: int, parent: int) -> list[str]:
        """The children of a node: their addresses are an arithmetic progression."""
        last = min(FANOUT * (parent + 1), widths(self.n, self.height)[depth])
        return [self.node(depth, i) for i in range(FANOUT * parent, last)]

    def paths(self) -> list[list[tuple[str, str]]]:
        """For each leaf, the digests before and after it in its run, then of the node above, up to the root."""
        above: list[list[tuple[str, str]]] = [[]]
        for depth in range(1, self.height + 1):
            level = []
            for parent, rest in enumerate(above):
                run = self.run(depth, parent)
                level += [[("".join(run[:j]), "".join(run[j + 1 :])), *rest] for j in range(len(run))]
            above = level
        return above


def fold(leaf: str, path: list[tuple[str, str]]) -> str:
    for before, after in path:
        leaf = digest(before + leaf + after)
    return leaf


# ---- rows ---------------------------------------------------------------------------------------------

def encoded(c: Column) -> Column:
    s = c.cast("string")
    return F.coalesce(F.concat(F.octet_length(s).cast("string"), F.lit(":"), s), F.lit("-"))


def leaf_of(*columns: Column) -> Column:
    return F.sha2(F.concat(*map(encoded, columns)), 256)


def ranked(rows: DataFrame) -> DataFrame:
    """``rows`` (key, id, leaf, claim) with at, the place within the key by id, and n, the key's rows.

    One range exchange sorts the table; a partition's rows of a key are consecutive, so a row's place is
    that of the partition's first row of the key and the distance to it.
    """
    spread = rows.withColumn("even", F.monotonically_increasing_id())  # equal rows need not meet in one task
    placed = stored(
        spread.repartitionByRange("key", "id", "leaf", "even").sortWithinPartitions("key", "id", "leaf", "even")
        .select(*rows.columns, F.spark_partition_id().alias("part"), F.monotonically_increasing_id().alias("pos")), "merkle-ranked")
    counts = placed.groupBy("key", "part").agg(F.count("*").alias("m"), F.min("pos").alias("first"))
    parts = stored(counts.selectExpr(
        "key", "part", "first", "sum(m) over (partition by key) as n",
        "sum(m) over (partition by key order by part rows between unbounded preceding and current row) - m as base"), "merkle-parts")
    return joined_by_key(placed, parts, ["key", "part"], "inner").select(*rows.columns, (F.col("base") + F.col("pos") - F.col("first")).alias("at"), "n")


def blocks(rows: DataFrame, block_steps: int) -> DataFrame:
    """key, block, steps (to the key's root), n, nodes, root, ids, claims of each block of ``rows`` (key, at, steps, leaf, id, claim)."""
    kind = rows.schema["id"].dataType.simpleString()

    def build(group: pa.Table) -> pa.Table:
        got = group.sort_by("at")
        steps, leaves = got["steps"][0].as_py(), got["leaf"].to_pylist()
        made = Block.build(leaves, min(block_steps, steps))
        ids = pa.array([got["id"].to_pylist()], pa.list_(got.schema.field("id").type))
        return pa.table({
            "key": got["key"].slice(0, 1), "block": got["block"].slice(0, 1), "steps": got["steps"].slice(0, 1), "n": pa.array([len(leaves)], pa.int32()),
            "nodes": pa.array([bytes(made.nodes)]), "root": pa.array([made.node(0, 0)]), "ids": ids, "claims": pa.array([got["claim"].to_pylist()], pa.list_(pa.string()))})

    keyed = rows.withColumn("block", F.expr(f"at div {FANOUT**block_steps}"))
    return stored(
        keyed.groupBy("key", "block").applyInArrow(
            build, f"key string, block long, steps int, n int, nodes binary, root string, ids array<{kind}>, claims array<string>"), "merkle-blocks")


def tiers_of(rows: DataFrame, block_steps: int) -> list[DataFrame]:
    """Block tables from the leaves up; a key's last block holds its root."""
    steps = F.when(F.col("n") == 1, 0).otherwise(F.length(F.hex(F.col("n") - 1)))  # hexadecimal digits: least power of 16
    out = [blocks(ranked(rows).select("key", "at", steps.cast("int").alias("steps"), "leaf", "id", "claim"), block_steps)]
    while not (more := out[-1].where(F.col("steps") > block_steps)).isEmpty():
        out.append(blocks(more.select(
            "key", F.col("block").alias("at"), (F.col("steps") - block_steps).alias("steps"), F.col("root").alias("leaf"),
            F.col("block").alias("id"), F.lit(None).cast("string").alias("claim")), block_steps))
    return out


def roots_of(tiers: list[DataFrame], block_steps: int) -> DataFrame:
    """key, root."""
    return reduce(DataFrame.union, [t.where(F.col("steps") <= block_steps).select("key", "root") for t in tiers])


def block_paths(group: pa.Table, block_steps: int) -> tuple[list[list[tuple[str, str]]], list[tuple[str, str]], Block]:
    row = group.slice(0, 1).to_pylist()[0]
    block = Block(min(block_steps, row["steps"]), row["n"], row["nodes"])
    return block.paths(), [(p["before"], p["after"]) for p in row["path"]], block


def path_rows(paths: list[list[tuple[str, str]]], above: list[tuple[str, str]]) -> pa.Array:
    return pa.array([[{"before": a, "after": b} for a, b in [*p, *above]] for p in paths], SIBLINGS)


def with_paths(tiers: list[DataFrame], tops: DataFrame, block_steps: int) -> DataFrame:
    """The first tier's blocks, each with the siblings of its root up to the manifest's root; ``tops`` (key,
    path) has those of the keys' roots. Paths are few: one for each 4,096 rows."""
    def lower(group: pa.Table) -> pa.Table:
        """key, block (that a leaf of this block is the root of), path."""
        within, above, _ = block_paths(group, block_steps)
        first = group["block"][0].as_py() * FANOUT**block_steps
        return pa.table({
            "key": pa.array([group["key"][0].as_py()] * len(within)), "block": pa.array(range(first, first + len(within)), pa.int64()),
            "path": path_rows(within, above)})

    above = None
    for tier in reversed(tiers):
        own = joined_by_key(tier.where(F.col("steps") <= block_steps).select("key", "block"), tops, ["key"], "inner", limit=2_000).select("key", "block", "path")
        paths = stored(own if above is None else own.unionByName(above), "merkle-paths")
        joined = joined_by_key(tier, paths, ["key", "block"], "inner", limit=2_000)
        above = joined.groupBy("key", "block").applyInArrow(lower, f"key string, block long, path {PATH}")
    return joined


@dataclass(frozen=True)
class Manifest:
    root: str | None
    tiers: list[DataFrame]      # blocks of the keys' trees, leaves first
    tops: list[DataFrame]       # blocks of the tree over the keys' roots
    roots: DataFrame            # key, root
    block_steps: int

    def proofs(self) -> DataFrame:
        """key, id, leaf, siblings_sha256, folded_root (from the claimed leaf where there is one), a row for each row."""
        kind, block_steps = self.tiers[0].schema["ids"].dataType.elementType.simpleString(), self.block_steps

        def tops(group: pa.Table) -> pa.Table:
            within, above, _ = block_paths(group, block_steps)
            return pa.table({"key": group["ids"].combine_chunks().flatten(), "path": path_rows(within, above)})

        whole = stored(self.tops[-1].select("key", F.array().cast(PATH).alias("path")), "merkle-top")  # one row
        below = with_paths(self.tops, whole, block_steps).groupBy("key", "block").applyInArrow(tops, f"key string, path {PATH}")
        rows = with_paths(self.tiers, stored(below, "merkle-keys"), block_steps)

        def prove(group: pa.Table) -> pa.Table:
            within, above, block = block_paths(group, block_steps)
            row = group.select(["key", "ids", "claims"]).slice(0, 1)
            rest = "".join(a + b for a, b in above)
            leaves = [block.node(block.height, i) for i in range(block.n)]
            found = [digest("".join(a + b for a, b in p) + rest) for p in within]
            claims = row["claims"][0].as_py()
            folded = [fold(fold(c or leaf, p), above) for leaf, c, p in zip(leaves, claims, within)]
            return pa.table({
                "key": pa.array([row["key"][0].as_py()] * block.n), "id": row["ids"].combine_chunks().flatten(), "leaf": pa.array(leaves),
                "siblings_sha256": pa.array(found), "folded_root": pa.array(folded)})

        return rows.groupBy("key", "block").applyInArrow(prove, f"key string, id {kind}, leaf string, siblings_sha256 string, folded_root string")


def manifest(docs: DataFrame, id_col: str = "doc_id", key_col: str = "source", columns: tuple[str, ...] = COLUMNS, claim: Column | None = None,
             block_steps: int = BLOCK_STEPS) -> Manifest:
    """The trees of ``docs``; ``claim`` is a leaf that somebody claims for the row (null: none), to be folded by ``proofs``."""
    key = F.coalesce(F.concat(F.lit("="), F.col(f"`{key_col}`").cast("string")), F.lit(""))
    none = F.lit(None).cast("string")
    rows = docs.select(
        key.alias("key"), F.col(f"`{id_col}`").alias("id"), leaf_of(*[F.col(f"`{c}`") for c in columns]).alias("leaf"),
        (none if claim is None else claim).alias("claim"))
    tiers = tiers_of(rows, block_steps)
    roots = stored(roots_of(tiers, block_steps), "merkle-roots")
    tops = tiers_of(roots.select(F.lit("").alias("key"), F.col("key").alias("id"), F.col("root").alias("leaf"), none.alias("claim")), block_steps)
    last = tops[-1].where(F.col("steps") <= block_steps).select("root").first()  # one row
    return Manifest(last["root"] if last else None, tiers, tops, roots, block_steps)


def tampered_leaf(id_col: str = "doc_id", text_col: str = "text", columns: tuple[str, ...] = COLUMNS, every: int = 5) -> Column:
    """The leaf of a row whose text was lower-cased (A-Z), for ids whose crc32 is divisible by ``every``."""
    changed = [F.translate(F.col(c), UPPER, LOWER) if c == text_col else F.col(c) for c in columns]
    return F.when(F.crc32(F.col(id_col).cast("string").cast("binary")) % every == 0, leaf_of(*changed))


def verified(docs: DataFrame, id_col: str = "doc_id", key_col: str = "source", columns: tuple[str, ...] = COLUMNS, claim: Column | None = None,
             block_steps: int = BLOCK_STEPS) -> DataFrame:
    """Per row: id_col, leaf, subroot, root, proof_sha256, folded_root, verified."""
    made = manifest(docs, id_col, key_col, columns, claim, block_steps)
    root = F.lit(made.root).cast("string")
    proofs = joined_by_key(made.proofs(), made.roots.select("key", F.col("root").alias("subroot")), ["key"], "inner")
    return proofs.select(
        F.col("id").alias(id_col), "leaf", "subroot", root.alias("root"), F.col("siblings_sha256").alias("proof_sha256"), "folded_root",
        (F.col("folded_root") == root).alias("verified"))
