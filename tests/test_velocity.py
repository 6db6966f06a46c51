from __future__ import annotations

import datetime as dt
import random

import pandas as pd
import pytest
from pyspark.sql import functions as F

from riskspark.operators import velocity
from riskspark.operators.velocity import card_velocity, velocity_violations

START = dt.datetime(2024, 1, 1)


def frame(spark, rows):
    data = [(str(i), START + dt.timedelta(seconds=s), card, amt) for i, (s, card, amt) in enumerate(rows)]
    return spark.createDataFrame(data, "trans_num string, trans_ts timestamp, cc_num long, amt double")


def counts(df):
    return {r.trans_num: (r.trans_velocity_1h, r.trans_velocity_24h) for r in df.collect()}


def brute(rows):
    """Rolling counts as pandas defines them, by definition."""
    out = {}
    for i, (s, card, amt) in enumerate(rows):
        before = [
            (s2, a2) for j, (s2, c2, a2) in enumerate(rows)
            if c2 == card and (s2 < s or (s2 == s and sort_key(j) <= sort_key(i))) and a2 is not None
        ]
        out[str(i)] = tuple(max(sum(s2 > s - w for s2, _ in before) - 1, 0) for w in (3600, 86400))
    return out


def sort_key(i):
    return str(i)


def test_tie_fixture(spark):
    seconds = [0, 1800, 1800, 3600, 5400, 5400.5, 7200]
    got = counts(card_velocity(frame(spark, [(s, 1, 1.0) for s in seconds])))
    assert [got[str(i)][0] for i in range(7)] == [0, 1, 2, 2, 1, 2, 2]
    assert [got[str(i)][1] for i in range(7)] == [0, 1, 2, 3, 4, 5, 6]


@pytest.mark.parametrize("seed", [1, 2])
def test_random_rows_against_definition(spark, seed):
    rng = random.Random(seed)
    rows = [
        (rng.choice([rng.randrange(0, 200_000), 3600 * rng.randrange(0, 50)]), rng.choice([1, 1, 1, 2, 3]), None if rng.random() < 0.05 else 1.0)
        for _ in range(300)
    ]
    df, want = frame(spark, rows), brute(rows)
    assert counts(card_velocity(df)) == want
    assert counts(card_velocity(df, hot_rows=50)) == want  # card 1 runs in slices
    assert counts(card_velocity(df, hot_rows=10, slice_rows=7)) == want
    assert counts(card_velocity(df, hot_rows=10, slice_rows=40, cell_seconds=500)) == want


def test_a_burst_spreads_over_many_slices(spark):
    """One card, all rows within an hour: slices hold a bounded number of moves, results stay."""
    rng = random.Random(5)
    rows = [(rng.randrange(0, 3600), 1, 1.0) for _ in range(600)] + [(5000, None, 1.0), (5001, None, 1.0)]
    df = frame(spark, rows)
    moves = velocity._walk(velocity._rows(df, F.struct("trans_num"), "cc_num", "trans_ts", "trans_num", "amt", ()), velocity.WINDOWS, ())
    sliced, carried = velocity._sliced(moves, velocity.WINDOWS, (), slice_rows=50, cell_seconds=1)
    sizes = [r["count"] for r in sliced.where("_card = 1").groupBy("_slice").count().collect()]
    assert sum(sizes) == 1800 and len(sizes) > 30 and max(sizes) < 60 and carried.count() == len(sizes) + 1
    assert counts(card_velocity(df, hot_rows=2, slice_rows=50)) == brute(rows)


def test_agrees_with_pandas_rolling(spark, txns):
    pdf = txns.select("trans_num", "trans_ts", "cc_num", "amt").toPandas()
    want = {}
    for _, part in pdf.sort_values(["cc_num", "trans_ts", "trans_num"]).groupby("cc_num"):
        rolled = part.set_index("trans_ts")["amt"]
        for name, v1, v24 in zip(part["trans_num"], rolled.rolling("1h").count() - 1, rolled.rolling("24h").count() - 1):
            want[name] = (int(v1), int(v24))
    assert counts(card_velocity(txns.select("trans_num", "trans_ts", "cc_num", "amt"))) == want


def test_history_counts_but_is_not_returned(spark):
    rows = [(s, 1, 1.0) for s in range(0, 7200, 600)]
    df = frame(spark, rows)
    whole = counts(card_velocity(df))
    cut = F.lit(START + dt.timedelta(seconds=3000))
    for hot in (10**6, 2):
        part = counts(card_velocity(df.where(F.col("trans_ts") > cut), history=df.where(F.col("trans_ts") <= cut), hot_rows=hot))
        assert part == {k: v for k, v in whole.items() if k in part} and len(part) == 6


def test_scopes_do_not_see_each_other(spark):
    df = frame(spark, [(0, 1, 1.0), (10, 1, 1.0)]).withColumn("split", F.when(F.col("trans_num") == "0", "train").otherwise("val"))
    assert set(counts(card_velocity(df, scope=("split",))).values()) == {(0, 0)}


def test_audit_finds_nothing(txns):
    row = velocity_violations(txns, F.lit(dt.datetime(2024, 1, 15))).first()
    assert (row.nonzero_first, row.changed_rows) == (0, 0) and row.rows_compared > 0
