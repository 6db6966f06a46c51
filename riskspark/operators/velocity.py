"""Card velocity: earlier transactions of the same card inside a trailing window.

Each transaction arrives at t and expires from a window of w seconds at t + w.
Walking arrivals and expiries of a card in time order, a running sum is the
number of live transactions, so one pass serves every window and no frame is
ever re-scanned. Windows are left-open: an expiry at t comes before an arrival
at t, and equal times count only rows earlier in ``order``.

Cards with very many rows are cut into slices of consecutive arrivals and expiries that run as
separate groups; a carry row per slice brings in what was live when the slice began. Slices are bounded in
rows, not in time: the moves of each second are counted first, and running counts say where a slice
ends, so a burst within an hour is many slices. Without such cards none of this is in the plan.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from riskspark.operators.lookups import hot_keys
from riskspark.session import stored

# Feature name and trailing seconds.
WINDOWS = {"trans_velocity_1h": 3600, "trans_velocity_24h": 86400}
CARRY, EXPIRY, ARRIVAL = -1, 0, 1


def card_velocity(
    df: DataFrame,
    windows: dict[str, int] | None = None,
    card: str = "cc_num",
    ts: str = "trans_ts",
    order: str = "trans_num",
    amount: str = "amt",
    scope: tuple[str, ...] = (),
    history: DataFrame | None = None,
    hot_rows: int | None = None,
    slice_rows: int = 1_000_000,
    cell_seconds: float = 1,
) -> DataFrame:
    """Adds one count per window. ``history`` rows are counted but not returned;
    ``scope`` columns keep rows of different scopes (splits) from seeing each other. Moves of one
    ``cell_seconds`` stay together; the keys of hot cards (at most 10,000) are written before the plan is made."""
    windows = windows or WINDOWS
    payload = F.struct(*[F.col(c) for c in df.columns])
    moves = _rows(df, payload, card, ts, order, amount, scope)
    if history is not None:
        unseen = _rows(history, F.lit(None).cast(df.select(payload.alias("p")).schema["p"].dataType), card, ts, order, amount, scope)
        moves = moves.unionByName(unseen)

    heavy = stored(hot_keys(moves.groupBy("_card").agg(F.count(F.lit(1)).alias("_n")), "_card", "_n", hot_rows).select(F.col("_card").alias("_heavy")), "hot-cards")
    walk = _walk(moves, windows, scope)
    if heavy.isEmpty():
        return _count_live(walk.withColumn("_slice", F.lit(0).cast("bigint")), windows, scope)
    marked = walk.join(F.broadcast(heavy.withColumn("_hot", F.lit(True))), F.col("_card").eqNullSafe(F.col("_heavy")), "left").drop("_heavy")  # rows without a card are a key, too
    cold = marked.where(F.col("_hot").isNull()).drop("_hot").withColumn("_slice", F.lit(0).cast("bigint"))
    sliced, carried = _sliced(marked.where("_hot").drop("_hot"), windows, scope, slice_rows, cell_seconds)
    nothing = F.lit(None).cast(walk.schema["_payload"].dataType)
    return _count_live(cold.unionByName(sliced).unionByName(carried.withColumn("_payload", nothing)), windows, scope)


def _count_live(walk: DataFrame, windows: dict[str, int], scope) -> DataFrame:
    so_far = W.partitionBy(*scope, "_card", "_slice").orderBy("_at", "_kind", "_order").rowsBetween(W.unboundedPreceding, W.currentRow)
    live = {name: F.sum(f"_live_{i}").over(so_far) for i, name in enumerate(windows)}
    return (
        walk.withColumns(live)
        .where((F.col("_kind") == ARRIVAL) & F.col("_payload").isNotNull())
        .select("_payload.*", *[F.greatest(F.col(name) - 1, F.lit(0)).cast("bigint").alias(name) for name in windows])
    )


def _rows(df: DataFrame, payload: Column, card: str, ts: str, order: str, amount: str, scope) -> DataFrame:
    return df.select(
        *scope,
        F.col(card).alias("_card"),
        F.unix_micros(F.col(ts)).alias("_us"),
        F.col(order).alias("_order"),
        F.when(F.col(amount).isNotNull() & F.col(ts).isNotNull(), 1).otherwise(0).cast("bigint").alias("_counts"),
        payload.alias("_payload"),
    )


def _walk(moves: DataFrame, windows: dict[str, int], scope) -> DataFrame:
    """One arrival and one expiry per window for every transaction; only arrivals carry the row itself."""
    nothing = F.lit(None).cast(moves.schema["_payload"].dataType)

    def move(at: Column, kind: int, change: list[Column], payload: Column) -> Column:
        return F.struct(
            at.alias("_at"), F.lit(kind).alias("_kind"),
            *[c.alias(f"_live_{i}") for i, c in enumerate(change)], payload.alias("_payload"),
        )

    plus, minus, zero = F.col("_counts"), -F.col("_counts"), F.lit(0).cast("bigint")
    steps = [move(F.col("_us"), ARRIVAL, [plus] * len(windows), F.col("_payload"))]
    for i, seconds in enumerate(windows.values()):
        change = [minus if j == i else zero for j in range(len(windows))]
        steps.append(move(F.col("_us") + seconds * 1_000_000, EXPIRY, change, nothing))
    return moves.select(*scope, "_card", "_order", F.inline(F.array(*steps)))


def _sliced(walk: DataFrame, windows: dict[str, int], scope, slice_rows: int, cell_seconds: float) -> tuple[DataFrame, DataFrame]:
    """The moves of hot cards with their slice, and a carry row per slice: what is live when it begins, the
    running total of everything before it. A card's cells are ordered in one task, one narrow row a cell."""
    unit = int(cell_seconds * 1_000_000)
    changes = [f"_live_{i}" for i in range(len(windows))]
    celled = walk.withColumn("_cell", F.floor(F.col("_at") / unit))
    before = W.partitionBy(*scope, "_card").orderBy("_cell").rowsBetween(W.unboundedPreceding, -1)
    counted = celled.groupBy(*scope, "_card", "_cell").agg(F.count(F.lit(1)).alias("_n"), *[F.sum(c).alias(c) for c in changes])
    cells = stored(counted.select(
        *scope, "_card", "_cell", F.floor(F.coalesce(F.sum("_n").over(before), F.lit(0)) / slice_rows).alias("_slice"),
        *[F.coalesce(F.sum(c).over(before), F.lit(0)).alias(c) for c in changes]), "velocity-cells")
    keys = [*scope, "_card", "_cell"]
    place = cells.select(*[F.col(k).alias(f"_of{k}") for k in keys], "_slice")
    on = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_of{k}")) for k in keys])
    sliced = celled.join(place, on).drop("_cell", *[f"_of{k}" for k in keys])
    carried = cells.groupBy(*scope, "_card", "_slice").agg(F.min("_cell").alias("_first"), *[F.min_by(c, "_cell").alias(c) for c in changes]).select(
        *scope, "_card", F.lit(None).cast(walk.schema["_order"].dataType).alias("_order"), (F.col("_first") * unit).alias("_at"), F.lit(CARRY).alias("_kind"),
        *changes, "_slice")
    return sliced, carried


def velocity_violations(df: DataFrame, cutoff: Column, **kw) -> DataFrame:
    """Does velocity look backward only? Counts first rows of a card with a non-zero value, and rows
    before ``cutoff`` whose value changes once everything after it is removed."""
    windows = kw.get("windows") or WINDOWS
    key, card, ts = kw.get("order", "trans_num"), kw.get("card", "cc_num"), kw.get("ts", "trans_ts")
    slim = df.select(key, card, ts, kw.get("amount", "amt"))
    full = card_velocity(slim, **kw)
    part = card_velocity(slim.where(F.col(ts) <= cutoff), **kw).select(
        F.col(key), *[F.col(n).alias(f"_part_{n}") for n in windows]
    )
    differs = reduce(lambda a, b: a | b, [F.col(n) != F.col(f"_part_{n}") for n in windows])
    nonzero = reduce(lambda a, b: a | b, [F.col(f"_first.{n}") != 0 for n in windows])
    firsts = (
        full.groupBy(card)
        .agg(F.min_by(F.struct(*windows), F.struct(ts, key)).alias("_first"))
        .agg(F.count(F.lit(1)).alias("cards"), F.count_if(nonzero).alias("nonzero_first"))
    )
    changed = full.join(part, key).agg(F.count(F.lit(1)).alias("rows_compared"), F.count_if(differs).alias("changed_rows"))
    stats = changed.select(F.struct("rows_compared", "changed_rows")).scalar()
    return firsts.select(
        "cards", "nonzero_first", stats["rows_compared"].alias("rows_compared"), stats["changed_rows"].alias("changed_rows")
    )
