"""Runs of words: the automaton against all periods by hand, the query against brute force, edge cases."""

from __future__ import annotations

import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from riskspark.llm import catalog, runs
from tests.llm import brute

SF = "/root/testdata/sf0.001"
FIELDS = ("doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256")


@settings(max_examples=300, deadline=None)
@given(st.lists(st.integers(0, 2), max_size=60), st.sampled_from([1, 2, 3, 5, 12]))
def test_runs_of_small_alphabets(codes, least):
    want = sorted(brute.runs(codes, least), key=lambda r: (r[0], r[2]))
    assert runs.runs_of(codes, least) == want
    assert runs.runs_in([b"%d" % c for c in codes], least) == want


@pytest.mark.parametrize("seed", range(6))
def test_runs_in_long_texts(seed):
    rng = random.Random(seed)
    w = []
    while len(w) < 700:
        piece = [rng.randrange(4 + 40 * (seed % 3)) for _ in range(rng.randint(1, 30))]
        w += piece * rng.choice([1, 1, 2, 3, 7]) + piece[: rng.randint(0, len(piece))]
    assert runs.runs_in([b"%d" % c for c in w]) == sorted(brute.runs(w), key=lambda r: (r[0], r[2]))


def test_fibonacci_and_one_word():
    a, b = "a", "ab"
    while len(b) < 600:
        a, b = b, b + a
    assert runs.runs_of([ord(c) for c in b], 2) == sorted(brute.runs(list(b), 2), key=lambda r: (r[0], r[2]))
    assert runs.runs_in([b"x"] * 50_000) == [(0, 50_000, 1)]
    assert runs.runs_in([b"x"] * 11) == [] and runs.runs_in([]) == []


def test_kept_spans():
    assert runs.kept_spans(20, [(2, 12, 3)]) == [(0, 5), (14, 20)]
    assert runs.kept_spans(14, [(0, 12, 3), (1, 13, 2)]) == [(0, 3)]
    assert runs.kept_spans(0, []) == []


def test_query_brute(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    got = sorted(tuple(r) for r in catalog.op13_runs(spark, SF).select(*FIELDS).collect())
    assert got == sorted(brute.run_row(r["doc_id"], r["text"]) for r in docs.collect())
    assert sum(r[1] > 0 for r in got) > 10


def test_edges(spark):
    long = " ".join(f"w{i % 7}" for i in range(40_000))
    made = [(1, None), (2, ""), (3, " \n "), (4, "a b " * 6), (4, "a b " * 6), (None, "a b " * 6), (5, "a\u00a0b " * 12), (6, long), (7, "x")]
    d = spark.createDataFrame(made, "doc_id long, text string").selectExpr("*", "1 as runs", "'z' as collapsed", "2 as __in")
    got = {(r["doc_id"], r["text"]): r for r in runs.found(d).collect()}
    assert len(runs.found(d).collect()) == len(made) and [c for c in runs.found(d).columns[:3]] == ["doc_id", "text", "__in"]
    assert [len(got[k]["runs"]) for k in ((1, None), (2, ""), (3, " \n "), (7, "x"))] == [0] * 4 and got[1, None]["collapsed"] == ""
    assert tuple(got[None, "a b " * 6]["runs"][0]) == (0, 12, 2) == tuple(got[4, "a b " * 6]["runs"][0]) and got[4, "a b " * 6]["collapsed"] == "a b"
    assert tuple(got[5, "a\u00a0b " * 12]["runs"][0]) == (0, 12, 1) and tuple(got[6, long]["runs"][0]) == (0, 40_000, 7)
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert runs.found(runs.with_planted(empty)).count() == 0
    assert runs.with_planted(d).columns == d.columns
