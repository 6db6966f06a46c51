from __future__ import annotations

import datetime as dt
import random
from types import SimpleNamespace

import pandas as pd
import pytest
from pyspark.sql import functions as F

from riskspark.operators.velocity import card_velocity
from riskspark.streaming import scoring
from riskspark.streaming.keyed import BATCH, PIECE, CardCounts, closing_row, with_velocity

START = dt.datetime(2024, 1, 1)
SCHEMA = "trans_num string, trans_ts timestamp, cc_num long, amt double"
COUNTS = ["trans_num", "trans_velocity_1h", "trans_velocity_24h"]


def at(minutes):
    return START + dt.timedelta(minutes=minutes)


class Replay:
    """Portions that arrive one after another; each run restarts the query from its checkpoint."""

    def __init__(self, spark, folder, build):
        self.spark, self.folder, self.build = spark, str(folder), build
        self.schema = spark.createDataFrame([], SCHEMA).schema

    def __call__(self, rows, card=1):
        data = [(r[0], at(r[1]), *(r[2:] or (card, 5.0))) for r in rows]
        self._write(self.spark.createDataFrame(data, SCHEMA))

    def close(self, minutes=60 * 24 * 30):
        self._write(closing_row(self.spark.createDataFrame([], SCHEMA), at(minutes)))

    def _write(self, df):
        df.write.mode("append").parquet(f"{self.folder}/in")
        out = self.build(scoring.read_transactions(self.spark, f"{self.folder}/in", self.schema))
        query = scoring.append_to(out, f"{self.folder}/out", f"{self.folder}/cp")
        query.awaitTermination()
        self.progress = query.lastProgress

    def rows(self):
        return self.spark.read.parquet(f"{self.folder}/out")

    def counts(self):
        return {r[0]: (r[1], r[2]) for r in self.rows().select(*COUNTS).collect()}


def test_late_rows_count_for_later_ones(spark, tmp_path):
    replay = Replay(spark, tmp_path, with_velocity)
    replay([("a", 0), ("c", 50)])
    assert replay.counts() == {}  # nothing is final before the watermark passes it
    replay([("b", 20), ("d", 70), ("x", 300, 2, 1.0)])  # b is late for c, within the delay
    assert replay.counts() == {"a": (0, 0), "b": (1, 1), "c": (2, 2), "d": (2, 3)}
    replay([("too late", 60), ("e", 500)])  # behind the watermark
    replay.close()
    assert replay.counts() == {"a": (0, 0), "b": (1, 1), "c": (2, 2), "d": (2, 3), "e": (0, 4), "x": (0, 0)}
    assert replay.progress["stateOperators"][0]["numRowsTotal"] == 0  # timers emptied the state


ODD = [
    ("a", 0, 1, 5.0), ("b", 0, 1, 5.0), ("c", 0, 1, None), ("d", 60, 1, 5.0), ("e", 60, 1, 5.0), ("f", 61, 1, 5.0), ("g", 90, None, 1.0),
    ("h", 95, None, 1.0), ("i", 1440, 1, 2.0), ("j", 1441, 1, 2.0), ("k", 1500, 1, 2.0), ("l", 1501, 2, 2.0), ("m", 4000, 1, 2.0),
]


@pytest.mark.parametrize("options", [{}, {"hot_cards": [1, None], "slice_seconds": 600}])
def test_equals_the_batch(spark, tmp_path, options):
    """Ties, rows without an amount or a card, whole cards and sliced ones; portions out of order."""
    replay = Replay(spark, tmp_path, lambda stream: with_velocity(stream, **options))
    replay([r for r in ODD if r[1] < 65][::-1])
    replay(sorted((r for r in ODD if r[1] >= 65), key=lambda r: r[0] in "jm"))
    replay.close()
    batch = card_velocity(spark.createDataFrame([(r[0], at(r[1]), *r[2:]) for r in ODD], SCHEMA))
    got = replay.rows()
    assert got.columns == batch.columns and got.count() == len(ODD)
    assert got.exceptAll(batch).count() == 0
    assert all(op["numRowsTotal"] == 0 for op in replay.progress["stateOperators"])


def test_rows_pass_unchanged(spark, tmp_path):
    """Large numbers, dates, nulls and text keep their values on the way through the state."""
    schema = "trans_num string, trans_ts timestamp, cc_num long, amt double, dob date, note string, big long, flag boolean"
    data = [("a", dt.datetime(2024, 1, 1, 0, 0, 0, 123457), 2**62 + 1, 0.1 + 0.2, dt.date(1999, 12, 31), 'q"\n\\é', 2**53 + 1, None),
            ("b", dt.datetime(2024, 1, 1), 2**62 + 1, 1e-300, None, None, None, True)]
    df = spark.createDataFrame(data, schema)
    df.write.parquet(str(tmp_path / "in"))
    closing_row(df, at(60 * 24 * 9)).write.mode("append").parquet(str(tmp_path / "in"))
    stream = scoring.read_transactions(spark, str(tmp_path / "in"), df.schema)
    scoring.append_to(with_velocity(stream), str(tmp_path / "out"), str(tmp_path / "cp")).awaitTermination()
    got = spark.read.parquet(str(tmp_path / "out"))
    assert got.drop(*COUNTS[1:]).exceptAll(df).count() == 0 and got.count() == 2


def test_slices_must_divide_the_windows(spark, tmp_path):
    stream = scoring.read_transactions(spark, str(tmp_path), spark.createDataFrame([], SCHEMA).schema)
    with pytest.raises(ValueError):
        with_velocity(stream, hot_cards=[1], slice_seconds=7)


def test_copies_in_later_portions(spark, tmp_path):
    replay = Replay(spark, tmp_path, scoring.deduplicated)
    replay([("a", 0), ("b", 100), ("c", 110)])
    replay([("b", 100), ("c", 115), ("a", 0)])  # within the delay, the same time or another; a is late
    assert sorted(r["trans_num"] for r in replay.rows().collect()) == ["a", "b", "c"]
    replay([("d", 400)])
    replay([("b", 380)])  # beyond the delay of the first b, not late itself
    replay.close()
    assert sorted(r["trans_num"] for r in replay.rows().collect()) == ["a", "b", "b", "c", "d"]


def test_windows_close_at_the_end(spark, tmp_path):
    def build(stream):
        scored = with_velocity(stream).withColumns({"risk_level": F.when(F.col("trans_velocity_1h") > 0, "HIGH RISK").otherwise("LOW RISK"), "is_fraud": F.lit(1)})
        return scoring.tier_counts(scored).select(F.hour("window.start").alias("h"), "risk_level", "total", "fraud_count")

    replay = Replay(spark, tmp_path, build)
    replay([("a", 10), ("b", 20), ("c", 130)])
    replay([("d", 185), ("e", 30)])  # e is behind the watermark
    replay.close()
    assert sorted(map(tuple, replay.rows().collect())) == [(0, "HIGH RISK", 1, 1), (0, "LOW RISK", 1, 1), (2, "LOW RISK", 1, 1), (3, "HIGH RISK", 1, 1)]


def test_keyed_state_is_cut_by_the_cores(spark, tmp_path):
    """Partitions of the state follow the cores, not a large session setting, which stays as it was."""
    name, cores = "spark.sql.shuffle.partitions", spark.sparkContext.defaultParallelism
    before = spark.conf.get(name)
    spark.conf.set(name, str(1000 * cores))
    try:
        assert scoring.state_partitions(spark) == 2 * cores
        rows = spark.createDataFrame([("a", at(0), 1, 1.0)], SCHEMA)
        rows.write.parquet(str(tmp_path / "one"))
        stream = scoring.read_transactions(spark, str(tmp_path / "one"), rows.schema)
        query = scoring.append_to(with_velocity(stream), str(tmp_path / "o"), str(tmp_path / "c"), 2)
        query.awaitTermination()
        assert query.lastProgress["stateOperators"][0]["numShufflePartitions"] == 2
        assert spark.conf.get(name) == str(1000 * cores)
        spark.conf.set(name, "1")
        assert scoring.state_partitions(spark) == 1
    finally:
        spark.conf.set(name, before)


class State(dict):
    """Map or value state of one key, and its timers."""

    keys, getValue, updateValue, removeKey = (lambda self: list(self)), dict.get, dict.__setitem__, dict.pop
    get, update, timers = (lambda self: dict.get(self, 0)), (lambda self, v: self.__setitem__(0, v)), ()

    def getMapState(self, *_):
        return State()

    getValueState = getMapState

    def registerTimer(self, at):
        self.timers = (*self.timers, at)


def test_a_cards_rows_are_released_a_part_at_a_time():
    """Rows that arrive in any order leave in order of time; no release holds all that wait, ties are not parted."""
    rng, windows, handle = random.Random(3), {"n": 3}, State()
    data = [(rng.randrange(60_000) * 1_000_000, i, rng.random() < 0.9) for i in range(60_000)]
    sizes, card = [], CardCounts(windows)
    card.init(handle)
    release = card.release
    card.release = lambda key, rows, memory: (sizes.append(len(rows)), release(key, rows, memory))[1]
    frames = [pd.DataFrame([(us, t, int(c), str(t)) for us, t, c in data[at : at + BATCH]], columns=["us", "tie", "counts", "payload"]) for at in range(0, len(data), BATCH)]
    got = []
    for part in (frames[:4], frames[4:]):
        list(card.handleInputRows(("c",), iter(part), None))
    for mark in (40_000_000, 10**9):  # in ms; some rows stay for the second
        now = SimpleNamespace(getCurrentWatermarkInMs=lambda mark=mark: mark)
        got += [(int(t), n) for f in card.handleExpiredTimer(("c",), now, None) for t, n in zip(f["payload"], f["n"])]
        assert max(sizes) < BATCH + 2 * PIECE * len(frames) < len(data) / 2
    past, expected = [], []
    for us, t, c in sorted(data):
        past.append(us) if c else None
        while past and past[0] <= us - 3_000_000:
            past.pop(0)
        expected.append((t, max(len(past) - 1, 0)))
    assert got == expected and not card.waiting
    assert handle.timers[0] == min(us for f in frames[:4] for us in f["us"]) // 1000 + 1
