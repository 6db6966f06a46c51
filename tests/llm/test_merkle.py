"""The Merkle manifest: layout, trees of every shape, proofs, edge cases."""

from __future__ import annotations

import random

import pytest

from riskspark.llm import catalog, merkle
from tests.llm import brute

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, source string, lang string, n_chars long, text string"
FIELDS = ("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")


def ordered(rows) -> list[tuple]:
    return sorted((tuple(r) for r in rows), key=repr)


@pytest.mark.parametrize("levels", [1, 2, 3, 4, 5])
def test_addresses_are_a_permutation(levels):
    made = [merkle.address(levels, d, i) for d in range(levels) for i in range(merkle.FANOUT**d)]
    assert sorted(made) == list(range(merkle.nodes_of(levels)))


def test_lower_subtrees_are_contiguous():
    levels, upper = 4, 2
    for tree in range(merkle.FANOUT**upper):
        held = [merkle.address(levels, upper + d, tree * merkle.FANOUT**d + i) for d in range(levels - upper) for i in range(merkle.FANOUT**d)]
        assert sorted(held) == list(range(min(held), min(held) + merkle.nodes_of(levels - upper)))


@pytest.mark.parametrize("n,height", [(1, 0), (1, 3), (2, 1), (16, 1), (17, 2), (255, 2), (257, 3), (4096, 3)])
def test_block_folds_to_its_root(n, height):
    leaves = [brute.sha256(str(i)) for i in range(n)]
    block = merkle.Block.build(leaves, height)
    paths = block.paths()
    assert len(paths) == n and all(merkle.fold(x, p) == block.node(0, 0) for x, p in zip(leaves, paths))
    level = leaves
    for _ in range(height):
        level = [brute.sha256("".join(level[a : a + 16])) for a in range(0, len(level), 16)]
    assert level == [block.node(0, 0)]
    if n > 1:
        assert merkle.fold(leaves[0], paths[1]) != block.node(0, 0)


def test_query_brute(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = [tuple(r) for r in docs.select("doc_id", "source", "lang", "n_chars", "text").collect()]
    got = catalog.op12_manifest(spark, SF)
    assert ordered(got.select(*FIELDS).collect()) == ordered(brute.merkle(rows))
    assert got.where("verified").count() and got.where("not verified").count()


def test_many_tiers(spark):
    """Blocks of 16 leaves: four tiers for the large key, also ragged ones; a second tier over the keys."""
    rng = random.Random(4)
    made = [(i, "hot" if i % 3 else f"s{rng.randrange(40)}", None, i, f"Text {i}") for i in range(900)]
    got = merkle.verified(spark.createDataFrame(made, SCHEMA), claim=merkle.tampered_leaf(), block_steps=1)
    assert ordered(got.collect()) == ordered(brute.merkle(made))


def test_edges(spark):
    long = "Ab " * 60_000
    made = [
        (None, None, None, None, None), (None, None, None, None, "A"), (1, "", "en", 0, ""), (2, None, "en", 1, "B"), (2, None, "en", 1, "B"),
        (2, None, "en", 1, "C"), (3, "-", "en", 1, long), (4, "é", "de", 1, "É\x00"), (5, "z", "de", 1, "x"), (10, "z", "de", 1, "X"),
    ]
    d = spark.createDataFrame(made, SCHEMA)
    got = merkle.verified(d.selectExpr("*", "text as leaf", "doc_id as root", "1 as key", "2 as at", "3 as claim"), claim=merkle.tampered_leaf())
    assert got.columns == list(FIELDS)
    assert ordered(got.collect()) == ordered(brute.merkle(made))
    empty = merkle.manifest(spark.createDataFrame([], SCHEMA))
    assert empty.root is None and empty.proofs().count() == 0
    assert merkle.verified(spark.createDataFrame([], SCHEMA)).count() == 0


def test_a_changed_row_changes_every_root(spark):
    made = [(i, "a", "en", 1, f"t{i}") for i in range(40)]
    one = merkle.manifest(spark.createDataFrame(made, SCHEMA))
    two = merkle.manifest(spark.createDataFrame([*made[:-1], (39, "a", "en", 1, "t39 ")], SCHEMA))
    assert one.root != two.root and {r["verified"] for r in merkle.verified(spark.createDataFrame(made, SCHEMA)).collect()} == {True}
