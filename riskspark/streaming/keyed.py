"""Velocity on a stream as keyed state with event-time timers.

A row waits in its card's state until the watermark has passed its time. By then every row that may precede
it within the allowed delay has arrived, so rows come out in time order with the counts the batch
operator gives, whatever order they arrived in, and late rows count for later ones. Waiting rows are kept in small pieces
and merged by time, so a worker never holds all rows of a card. What stays is the times of
a card's last day; a timer drops them once they are out of reach of any window. Results feed further
operators of the same query, such as scoring.

Cards known to be hot do not share one state. Their rows are spread over (card, slice) keys: a slice
counts its own arrivals and the expiries that fall into it, and what was live at its start comes from the
totals of earlier slices, which Spark sums before the shuffle. So a card is as many keys as it has slices, and
its own key sees one total per slice.

Rows later than the delay are dropped by the watermark, rows without a time never pass it and are left out.
Equal times count in ``order``; rows without an amount are not counted. A row without an id only moves the
watermark: the last portion of a replay is closed by one (``closing_row``).
"""

from __future__ import annotations

import io
import pickle
import uuid
from collections.abc import Iterator
from datetime import datetime

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from riskspark.operators.velocity import WINDOWS

ROCKS_DB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
PROVIDER = "spark.sql.streaming.stateStore.providerClass"
ARRIVAL, CARRY = 0, -1  # an expiry of window k (from 1) has kind k
PIECE, BATCH = 512, 10_000  # rows of a waiting piece; rows that come to those in memory before some are released
JSON = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS", "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS", "timeZone": "UTC", "ignoreNullFields": "false"}


def packed(frame: pd.DataFrame) -> bytes:
    out = io.BytesIO()
    pickle.dump({c: frame[c].tolist() for c in frame.columns}, out, protocol=5)
    return out.getvalue()


def unpacked(blobs: list[bytes]) -> pd.DataFrame:
    return pd.concat([pd.DataFrame(pickle.loads(b)) for b in blobs], ignore_index=True)


class Waiting(StatefulProcessor):
    """Rows wait, in small pieces named by their first time, until the watermark has reached ``us``. Then ``release`` gets
    them in order of time, a bounded number at once and rows of one time together: only pieces that overlap are in
    memory, however many rows wait."""

    columns: tuple[str, ...] = ()

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.waiting = handle.getMapState("waiting", "first long, piece string", "rows binary")
        self.kept = handle.getValueState("kept", "data binary")

    def wait(self, frame: pd.DataFrame) -> int:
        frame = frame[list(self.columns)].sort_values("us", kind="stable")
        for at in range(0, len(frame), PIECE):
            piece = frame.iloc[at : at + PIECE]
            self.waiting.updateValue((int(piece["us"].iloc[0]), uuid.uuid4().hex), (packed(piece),))
        return int(frame["us"].iloc[0])

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        first = min((self.wait(frame) for frame in rows if len(frame)), default=None)
        if first is not None:
            self.handle.registerTimer(first // 1000 + 1)  # also when it is over: expired timers run after all rows of the batch
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        mark = timerValues.getCurrentWatermarkInMs() * 1000
        names = sorted(tuple(k) for k in self.waiting.keys())
        due = [k for k in names if k[0] <= mark]
        later = names[len(due)][0] if len(due) < len(names) else None
        kept = self.kept.get()
        memory = pickle.loads(kept[0]) if kept else None
        held, new, over = [], 0, 0  # frames in memory, rows that came since the last release, rows left by it
        for i, name in enumerate(due):
            held.append(unpacked([self.waiting.getValue(name)[0]]))
            new += len(held[-1])
            ended = i + 1 == len(due)
            if new < max(BATCH, over) and not ended:
                continue
            upto = mark if ended else due[i + 1][0] - 1
            rows = pd.concat(held, ignore_index=True) if len(held) > 1 else held[0]
            closed = rows["us"] <= upto
            left = rows[~closed]
            if closed.any():
                out, memory = self.release(key, rows[closed], memory)
                if not ended:
                    memory = self.trimmed(memory, int(rows["us"][closed].max()))  # the rest is no earlier
                if out is not None and len(out):
                    yield out
            held, new, over = [left], 0, len(left)
        if len(due) == len(names):
            self.waiting.clear()
        else:
            for name in due:
                self.waiting.removeKey(name)
        if held and len(held[0]):
            first = self.wait(held[0])
            later = first if later is None else min(first, later)
        if later is not None:
            self.handle.registerTimer(later // 1000 + 1)
        memory = self.trimmed(memory, mark)
        if memory is None:
            self.kept.clear()
        else:
            self.kept.update((pickle.dumps(memory, protocol=5),))
            self.handle.registerTimer(self.reach(memory) // 1000 + 1)

    def close(self) -> None:
        pass

    def release(self, key, rows: pd.DataFrame, memory):
        raise NotImplementedError

    def trimmed(self, memory, mark: int):
        """What later rows can still need."""
        return memory

    def reach(self, memory) -> int:
        """When the last of it is out of reach."""
        raise NotImplementedError


class CardCounts(Waiting):
    """All rows of a card; memory: the times of counted rows of the longest window."""

    columns = ("us", "tie", "counts", "payload")

    def __init__(self, windows: dict[str, int]):
        self.windows = windows

    def release(self, key, rows, memory):
        rows = rows.sort_values(["us", "tie"], kind="stable")
        us, counts = rows["us"].to_numpy(np.int64), rows["counts"].to_numpy(np.int64)
        past = memory if memory is not None else np.zeros(0, np.int64)
        times = np.concatenate([past, us[counts > 0]])
        upto = len(past) + np.cumsum(counts)  # counted rows up to and with the row
        return result(rows, {
            name: np.maximum(upto - 1 - np.searchsorted(times, us - seconds * 1_000_000, "right"), 0) for name, seconds in self.windows.items()}), times

    def trimmed(self, memory, mark):
        if memory is None:
            return None
        memory = memory[memory > mark - max(self.windows.values()) * 1_000_000]
        return memory if len(memory) else None

    def reach(self, memory):
        return int(memory[-1]) + max(self.windows.values()) * 1_000_000


class SliceTotals(Waiting):
    """Totals of a hot card's slices to what was live at each slice's start; memory: the last slices and totals."""

    columns = ("us", "slice", "total")

    def __init__(self, windows: dict[str, int]):
        self.windows = windows

    def release(self, key, rows, memory):
        rows = rows.sort_values("slice")
        new = rows["slice"].to_numpy(np.int64)
        starts = np.concatenate([memory[0], new]) if memory else new
        totals = np.concatenate([memory[1], rows["total"].to_numpy(np.int64)]) if memory else rows["total"].to_numpy(np.int64)
        before = np.concatenate([[0], np.cumsum(totals)])
        live = {f"carry_{k}": before[np.searchsorted(starts, new)] - before[np.searchsorted(starts, new - s * 1_000_000)] for k, s in enumerate(self.windows.values(), 1)}
        return pd.DataFrame({"card": [key[0]] * len(new), "slice": new, "ended": pd.to_datetime(rows["us"].to_numpy(np.int64), unit="us"), **live}), (starts, totals)

    def trimmed(self, memory, mark):
        if memory is None:
            return None
        stay = memory[0] > mark - 2 * max(self.windows.values()) * 1_000_000
        return (memory[0][stay], memory[1][stay]) if stay.any() else None

    def reach(self, memory):
        return int(memory[0][-1]) + 2 * max(self.windows.values()) * 1_000_000


class SliceCounts(Waiting):
    """One slice of a hot card; memory: what came before its live count at the start."""

    columns = ("us", "tie", "counts", "payload", "kind", "at", "carry")

    def __init__(self, windows: dict[str, int], length: int):
        self.windows, self.length = windows, length

    def release(self, key, rows, memory):
        rows = unpacked([memory, packed(rows)]) if memory is not None else rows
        carries = rows[rows["kind"] == CARRY]
        if not len(carries):
            return None, packed(rows)
        carry = carries["carry"].iloc[0]
        mine = rows[rows["kind"] == ARRIVAL].sort_values(["at", "tie"], kind="stable")
        at, upto = mine["at"].to_numpy(np.int64), np.cumsum(mine["counts"].to_numpy(np.int64))
        found = {}
        for k, name in enumerate(self.windows, 1):
            gone = rows[(rows["kind"] == k) & (rows["counts"] > 0)]
            found[name] = np.maximum(int(carry[k - 1]) + upto - 1 - np.searchsorted(np.sort(gone["at"].to_numpy(np.int64)), at, "right"), 0)
        return result(mine, found), None

    def trimmed(self, memory, mark):
        """A slice without rows of its own has no total, so nothing to wait for."""
        return memory if memory is not None and unpacked([memory])["us"].max() > mark - 2 * self.length * 1_000_000 else None

    def reach(self, memory):
        return int(unpacked([memory])["us"].max()) + 2 * self.length * 1_000_000


def result(rows: pd.DataFrame, counts: dict[str, np.ndarray]) -> pd.DataFrame:
    return pd.DataFrame({"event_time": pd.to_datetime(rows["us"].to_numpy(np.int64), unit="us"), "payload": rows["payload"].tolist(), **counts})


def closing_row(like: DataFrame, at: datetime, ts: str = "trans_ts") -> DataFrame:
    """A row that stands for no transaction and moves the watermark past every window: the end of a replay."""
    return like.sparkSession.createDataFrame([tuple(at if c == ts else None for c in like.columns)], like.schema)


def watermarked(stream: DataFrame, delay: str, ts: str = "trans_ts", order: str = "trans_num") -> DataFrame:
    """Closing rows are seen by the watermark and leave. The condition names the time, so that the
    optimizer keeps it behind the watermark."""
    return stream.withWatermark(ts, delay).where(F.when(F.col(ts).isNotNull(), F.col(order).isNotNull()).otherwise(False))


def with_velocity(
    stream: DataFrame, delay: str = "1 hour", windows: dict[str, int] | None = None, card: str = "cc_num", ts: str = "trans_ts",
    order: str = "trans_num", amount: str = "amt", hot_cards: list | None = None, slice_seconds: int = 60,
) -> DataFrame:
    """Every column of ``stream`` and a count per window, each row once the watermark has passed it.

    ``hot_cards`` is a bounded list of keys to slice; ``slice_seconds`` divides every window. Without hot cards ``ts``
    stays the event time of the result, for windows in the same query; a sliced row comes out when its slice
    ends, so with them results have no event time and go to a table first. ``order`` is an id of text or a whole number.
    """
    windows = windows or WINDOWS
    if any(s % slice_seconds for s in windows.values()):
        raise ValueError("slice_seconds divides every window")
    spark = stream.sparkSession
    spark.conf.set(PROVIDER, ROCKS_DB)  # the state's map and timer columns need it
    key = F.coalesce(F.concat(F.lit("="), F.col(card).cast("string")), F.lit(""))  # never null: a null would turn whole numbers of other keys into floats
    rows = watermarked(stream, delay, ts, order).select(
        F.col(ts), F.col(card).alias("own"), key.alias("card"), F.unix_micros(F.col(ts).cast("timestamp")).alias("us"), F.col(order).alias("tie"),
        F.when(F.col(amount).isNotNull(), 1).otherwise(0).alias("counts"), F.to_json(F.struct(*[F.col(c) for c in stream.columns]), JSON).alias("payload"))
    names = ", ".join(f"{n} long" for n in windows)
    fields = f"event_time timestamp, payload string, {names}"

    def counted(grouped, processor: Waiting) -> DataFrame:
        return grouped.transformWithStateInPandas(processor, fields, "Append", "EventTime", eventTimeColumnName="event_time")

    if not hot_cards:
        made = counted(rows.groupBy("card"), CardCounts(windows))
    else:
        hot = F.coalesce(F.col("own").isin([c for c in hot_cards if c is not None]), F.lit(None in hot_cards))
        length = slice_seconds * 1_000_000
        mine = rows.where(hot).withColumn("slice", F.col("us") - F.pmod("us", F.lit(length)))
        totals = mine.groupBy("card", F.window(ts, f"{slice_seconds} seconds").alias("w")).agg(F.sum("counts").alias("total"))
        totals = totals.select("card", F.window_time("w").alias("ended"), F.unix_micros("w.start").alias("slice"), (F.unix_micros("w.end") - 1).alias("us"), "total")
        carry_names = [f"carry_{k}" for k in range(1, len(windows) + 1)]
        carry = totals.groupBy("card").transformWithStateInPandas(
            SliceTotals(windows), f"card string, slice long, ended timestamp, {', '.join(f'{c} long' for c in carry_names)}", "Append", "EventTime", eventTimeColumnName="ended")
        last = F.col("slice") + (length - 1)
        none = F.array().cast("array<long>")
        steps = [F.struct(F.lit(ARRIVAL).alias("kind"), F.col("us").alias("at"), F.col("slice").alias("slice"), F.col("payload").alias("payload"))]
        for k, s in enumerate(windows.values(), 1):
            later = F.lit(s * 1_000_000)
            steps.append(F.struct(F.lit(k).alias("kind"), (F.col("us") + later).alias("at"), (F.col("slice") + later).alias("slice"), F.lit(None).cast("string").alias("payload")))
        moves = mine.select(ts, "card", "tie", "counts", F.explode(F.array(*steps)).alias("m")).select(
            F.col(ts).alias("ended"), "card", "m.slice", "tie", "counts", "m.payload", "m.kind", "m.at", none.alias("carry"))
        carried = carry.select(
            "ended", "card", "slice", F.lit(None if stream.schema[order].dataType.simpleString() == "string" else 0).cast(stream.schema[order].dataType).alias("tie"),
            F.lit(0).alias("counts"), F.lit(None).cast("string").alias("payload"), F.lit(CARRY).alias("kind"), F.col("slice").alias("at"), F.array(*carry_names).alias("carry"))
        sliced = moves.union(carried).withColumn("us", last)
        made = counted(rows.where(~hot).groupBy("card"), CardCounts(windows)).union(counted(sliced.groupBy("card", "slice"), SliceCounts(windows, slice_seconds)))
    parsed = F.from_json("payload", stream.schema, JSON)
    return made.select("event_time", parsed.alias("row"), *windows).select(
        *[F.col("event_time").alias(ts) if c == ts and not hot_cards else F.col(f"row.{c}").alias(c) for c in stream.columns], *windows)
