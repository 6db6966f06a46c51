"""Streams over the transaction table, fed as files in portions of event time and closed at the end."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import functions as F

from riskspark.catalog import sql as S
from riskspark.catalog.registry import query
from riskspark.catalog.views import txn, txn_dense, with_surrogates
from riskspark.operators.features import Baselines
from riskspark.operators.rules import WEIGHTED_RULES, fired
from riskspark.session import shared_folder
from riskspark.streaming import scoring
from riskspark.streaming.keyed import closing_row, with_velocity

SLICES = 4
RULES = {r.rule_id: r for r in WEIGHTED_RULES}


def _share(df):
    """Where in the time span of ``df`` a row lies, in portions from 0 to SLICES - 1."""
    span = df.agg(F.struct(F.min("trans_ts").alias("lo"), F.max("trans_ts").alias("hi"))).scalar()
    us = lambda c: F.unix_micros(c)
    return F.least(F.floor((us("trans_ts") - us("_span.lo")) / (us("_span.hi") - us("_span.lo")) * SLICES), F.lit(SLICES - 1)), span


def _portioned(df):
    place, span = _share(df)
    return df.withColumn("_span", span).withColumn("_slice", place).drop("_span")


def _replay(placed, path, run):
    """Let the rows arrive in the portions of ``_slice``, then a closing row. After each, ``run`` starts the
    query, which resumes from its checkpoint and stops when the portion is used up."""
    rows = placed.drop("_slice")
    spark = rows.sparkSession
    newest = rows.agg(F.max("trans_ts")).first()[0]
    for i in range(SLICES + 1):
        if i < SLICES:
            placed.where(F.col("_slice") == i).drop("_slice").write.mode("append").parquet(f"{path}/in")
        elif newest is not None:
            closing_row(rows, newest + timedelta(days=4)).write.mode("append").parquet(f"{path}/in")
        run(scoring.read_transactions(spark, f"{path}/in", rows.schema)).awaitTermination()


def _append(path, out, partitions=None):
    return scoring.append_to(out, f"{path}/out", f"{path}/checkpoint", partitions)


def _replay_scored(spark, sf_dir, path, finish):
    """Score the stream with baselines of the whole table and append ``finish`` of it."""
    df = txn_dense(spark, sf_dir)
    base = Baselines.fit(df)
    _replay(_portioned(df), path, lambda stream: _append(path, finish(scoring.score_stream(stream, base, with_surrogates)), scoring.state_partitions(spark)))
    return spark.read.parquet(f"{path}/out")


_DENSE_SCORED = S.DENSE + S.features("dense") + S.SEVERITIES + S.surrogates("sig", "comp") + f""",
scored0 AS (SELECT *, {S.fused('0.5::DOUBLE', '0.25::DOUBLE', '0.25::DOUBLE')} AS hybrid_score FROM comp),
scored AS (SELECT *, {S.tier()} AS risk_level FROM scored0)"""


@query(
    "st01_stream_scoring",
    f"""WITH {_DENSE_SCORED} SELECT trans_num, trans_velocity_1h, trans_velocity_24h, trans_velocity_1h >= 3 AS velocity_rule,
      s4 IS NOT NULL AS velocity_signal, behavioral_score, hybrid_score, risk_level FROM scored""",
)
def stream_scoring(spark, sf_dir):
    """Velocity by keyed state feeds rule, signal and fused score; equal to the batch."""
    path = shared_folder(spark, "stream-score")

    def finish(scored):
        burst = (F.col("trans_velocity_1h") >= 2) | (F.col("trans_velocity_24h") >= 4)
        return scored.select(
            "trans_num", "trans_velocity_1h", "trans_velocity_24h", fired(scored, RULES["R2_VELOCITY_SPIKE"]).alias("velocity_rule"),
            burst.alias("velocity_signal"), "behavioral_score", "hybrid_score", "risk_level")

    return _replay_scored(spark, sf_dir, path, finish)


def _stream_velocity(spark, sf_dir, path, placed, **options):
    keep = ("trans_num", "trans_velocity_1h", "trans_velocity_24h")
    _replay(placed, path, lambda stream: _append(path, with_velocity(stream, **options).select(*keep), scoring.state_partitions(spark)))
    return spark.read.parquet(f"{path}/out")


_VELOCITY = f"WITH {S.DENSE}{S.velocity('dense', 'v')} SELECT trans_num, trans_velocity_1h, trans_velocity_24h FROM v"


@query("st02_stream_velocity", _VELOCITY)
def stream_velocity(spark, sf_dir):
    """Rows arrive out of order; half of those in the last half hour of a portion come with the next one.
    Late rows within the delay count for later rows, so the result is the batch windows."""
    rows = txn_dense(spark, sf_dir).select("trans_num", "trans_ts", "cc_num", "amt")
    placed = _portioned(rows)
    last = placed.groupBy("_slice").agg(F.max("trans_ts").alias("_last"))
    held = (F.col("trans_ts") >= F.col("_last") - F.expr("interval 30 minutes")) & (F.xxhash64("trans_num") % 2 == 0)
    late = placed.join(F.broadcast(last), "_slice").withColumn("_slice", F.when(held & (F.col("trans_ts") < F.col("_last")) & (F.col("_slice") < SLICES - 1), F.col("_slice") + 1).otherwise(F.col("_slice"))).drop("_last")
    return _stream_velocity(spark, sf_dir, shared_folder(spark, "stream-velocity"), late.select(*rows.columns, "_slice"))


@query("st02b_hot_cards", _VELOCITY)
def stream_hot_cards(spark, sf_dir):
    """The card with most rows (least id of them) sliced by the hour, the others whole."""
    rows = txn_dense(spark, sf_dir).select("trans_num", "trans_ts", "cc_num", "amt")
    top = rows.groupBy("cc_num").count().orderBy(F.desc("count"), "cc_num").limit(1).collect()  # one row
    return _stream_velocity(
        spark, sf_dir, shared_folder(spark, "stream-hot"), _portioned(rows), hot_cards=[r["cc_num"] for r in top], slice_seconds=3600)


# The resent rows whose first arrival has left the state: its time plus the delay is not after the watermark
# when the next portion comes, and the resent row itself is not late.
_DEDUP = f"""
WITH {S.TXN}, b AS (SELECT epoch_us(min(trans_ts)) AS lo, epoch_us(max(trans_ts)) AS hi FROM txn),
placed AS (
  SELECT trans_num, amt, epoch_us(trans_ts) AS us, least(floor((epoch_us(trans_ts) - lo)::DOUBLE / (hi - lo) * {SLICES}), {SLICES - 1}) AS portion, (hi - lo) // {SLICES} AS shift, lo, hi FROM txn, b),
resent AS (
  SELECT trans_num, amt, us + shift AS us, portion + 1 AS portion, us AS first_us FROM placed WHERE trans_num::BIGINT % 10 = 5 AND portion < {SLICES - 1}),
delivered AS (SELECT us, portion FROM placed UNION ALL SELECT us, portion FROM resent),
marks AS (SELECT portion + 1 AS portion, max(max(us)) OVER (ORDER BY portion) // 1000 * 1000 - 3600000000 AS mark FROM delivered GROUP BY portion)
SELECT trans_num, amt, us FROM placed
UNION ALL
SELECT trans_num, amt, us FROM resent JOIN marks USING (portion) WHERE first_us + 3600000000 <= mark AND us > mark
"""


@query("st03_stream_dedup", _DEDUP)
def stream_dedup(spark, sf_dir):
    """Copies in a later portion, after a restart: exact ones (a tenth of the rows) never come out again, since
    the state or the watermark stops them. Of rows resent with a later time (another tenth), those within
    the delay of the first are dropped, the others come out once more."""
    path = shared_folder(spark, "stream-dedup")
    df = txn(spark, sf_dir).select("trans_num", "trans_ts", "amt")
    placed, (_, span) = _portioned(df), _share(df)
    later = placed.where(F.col("_slice") < SLICES - 1).withColumn("_slice", F.col("_slice") + 1)
    number = F.col("trans_num").cast("bigint")
    us = lambda c: F.unix_micros(c)
    moved = later.where(number % 10 == 5).withColumn("_span", span).withColumn(
        "trans_ts", F.timestamp_micros(us("trans_ts") + F.expr(f"(unix_micros(_span.hi) - unix_micros(_span.lo)) div {SLICES}"))).drop("_span")
    every = placed.unionByName(later.where(number % 10 == 0)).unionByName(moved)
    _replay(every, path, lambda stream: _append(path, scoring.deduplicated(stream).select("trans_num", "amt", F.unix_micros("trans_ts").alias("us"))))
    return spark.read.parquet(f"{path}/out")


@query(
    "st04_tier_counts",
    f"""WITH {_DENSE_SCORED} SELECT epoch_us(date_trunc('hour', trans_ts)) AS start_us, risk_level, count(*) AS total, CAST(sum(is_fraud) AS BIGINT) AS fraud_count FROM scored GROUP BY 1, 2""",
)
def stream_tiers(spark, sf_dir):
    """Every hour and tier; the end of the replay closes the last windows."""
    path = shared_folder(spark, "stream-tiers")
    return _replay_scored(spark, sf_dir, path, scoring.tier_counts).select(F.unix_micros("window.start").alias("start_us"), "risk_level", "total", "fraud_count")


@query(
    "st04b_sliding_alerts",
    f"""WITH {_DENSE_SCORED}, hi AS (SELECT * FROM scored WHERE risk_level = 'HIGH RISK'),
    w AS (SELECT epoch_us(date_trunc('hour', trans_ts)) - back * 3600000000 AS start_us, risk_level, is_fraud FROM hi CROSS JOIN (VALUES (0), (1)) b(back))
    SELECT start_us, risk_level, count(*) AS total, CAST(sum(is_fraud) AS BIGINT) AS fraud_count FROM w GROUP BY ALL""",
)
def stream_sliding(spark, sf_dir):
    """High-tier rows per sliding two hours, every hour."""
    path = shared_folder(spark, "stream-alerts")
    counts = lambda scored: scoring.tier_counts(scoring.alerts(scored), "2 hours", "1 hour")
    return _replay_scored(spark, sf_dir, path, counts).select(F.unix_micros("window.start").alias("start_us"), "risk_level", "total", "fraud_count")
