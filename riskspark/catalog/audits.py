"""Leakage audit."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskspark.catalog import sql as S
from riskspark.catalog.joins import _OVERLAPPING, _with_overlap
from riskspark.catalog.registry import query
from riskspark.catalog.views import split_txn, stored_split, txn_dense
from riskspark.config import FEATURES
from riskspark.operators import audit
from riskspark.operators.features import Baselines, add_features, global_baselines
from riskspark.operators.velocity import velocity_violations
from riskspark.session import stored

_PAIR = "count(*) FILTER (list_contains(s, '{a}') AND list_contains(s, '{b}')) AS {a}_{b}_overlap"


@query(
    "lk01_id_overlap",
    f"WITH {_OVERLAPPING}, g AS (SELECT trans_num, list(DISTINCT split) AS s FROM seen GROUP BY trans_num) SELECT " + ", ".join(_PAIR.format(a=a, b=b) for a, b in audit.PAIRS) + " FROM g",
)
def id_overlap(spark, sf_dir):
    return audit.id_overlap(_with_overlap(spark, sf_dir))


_TRAIN = S.SPLIT + ", train AS (SELECT * FROM parts WHERE split = 'train')"
TRAIN_FEAT = _TRAIN + S.features("train")


def train_features(spark, sf_dir):
    train = stored_split(spark, sf_dir).where("split = 'train'")
    return add_features(train, Baselines.fit(train))


@query(
    "lk02_label_correlation",
    f"WITH {TRAIN_FEAT}, c AS (" + " UNION ALL ".join(f"SELECT '{f}' AS feature, {S.r(f'corr({f}, is_fraud)', 4)} AS correlation FROM feat" for f in FEATURES)
    + ") SELECT *, abs(correlation) > 0.9 AS suspicious FROM c",
)
def label_correlation(spark, sf_dir):
    return audit.suspicious_features(train_features(spark, sf_dir))


@query(
    "lk03_fit_isolation",
    f"""WITH {_TRAIN}, a AS (SELECT avg(amt) AS e FROM train),
    b AS (SELECT 'train' AS fitted_on, sum(amt) / count(*) AS l FROM parts WHERE split = 'train' UNION ALL SELECT 'all', avg(amt) FROM parts)
    SELECT fitted_on, {S.r('e', 4)} AS expected_train_mean, {S.r('l', 4)} AS learned_mean, {S.r('abs(e - l)', 6)} AS difference, abs(e - l) < 1e-4 AS passed FROM a, b""",
)
def fit_isolation(spark, sf_dir):
    """Baselines fitted on the training rows pass, baselines fitted on everything do not."""
    parts = stored_split(spark, sf_dir)
    train = parts.where("split = 'train'")
    good = audit.fit_isolation(train, global_baselines(train)).withColumn("fitted_on", F.lit("train"))
    bad = audit.fit_isolation(train, global_baselines(parts)).withColumn("fitted_on", F.lit("all"))
    return good.unionByName(bad)


def _look_ahead(src: str) -> str:
    """look: velocity over all rows against velocity over the rows up to the middle of the time range."""
    return (
        f", cut AS (SELECT make_timestamp((min(epoch_us(trans_ts)) + max(epoch_us(trans_ts))) // 2) AS middle FROM {src}), early AS (SELECT * FROM {src} WHERE trans_ts <= (SELECT middle FROM cut))"
        + S.velocity(src, "v_all") + S.velocity("early", "v_early")
        + """, firsts AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY cc_num ORDER BY trans_ts, trans_num) AS rn FROM v_all) WHERE rn = 1),
    f AS (SELECT count(*) AS cards, count(*) FILTER (trans_velocity_1h <> 0 OR trans_velocity_24h <> 0) AS nonzero_first FROM firsts),
    look AS (SELECT cards, nonzero_first, count(*) AS rows_compared,
      count(*) FILTER (a.trans_velocity_1h <> e.trans_velocity_1h OR a.trans_velocity_24h <> e.trans_velocity_24h) AS changed_rows
      FROM v_all a JOIN v_early e USING (trans_num) CROSS JOIN f GROUP BY cards, nonzero_first)"""
    )


def _middle(df):
    """The middle of the table's own time range."""
    us = F.unix_micros("trans_ts")
    return df.agg(F.timestamp_micros(F.floor((F.min(us) + F.max(us)) / 2).cast("bigint"))).scalar()


@query("lk04_velocity_direction", f"WITH {S.DENSE}{_look_ahead('dense')} SELECT cards, nonzero_first, rows_compared, changed_rows FROM look")
def velocity_direction(spark, sf_dir):
    df = txn_dense(spark, sf_dir)
    return velocity_violations(df, _middle(df))


_RATE = "avg(is_fraud) FILTER (split = '{s}') * 100"


@query(
    "lk05_prevalence",
    f"WITH {S.SPLIT}, a AS (SELECT {_RATE.format(s='test')} AS t, {_RATE.format(s='train')} AS r FROM parts) SELECT {S.r('t', 2)} AS test_fraud_rate_percent, "
    f"{S.r('r', 2)} AS train_fraud_rate_percent, t < 5 AND abs(t - r) < 0.2 AS passed FROM a",
)
def prevalence(spark, sf_dir):
    return audit.prevalence(split_txn(spark, sf_dir))


@query(
    "lk06_audit_report",
    f"WITH {TRAIN_FEAT}{_look_ahead('parts')}, a AS (SELECT avg(is_fraud) FILTER (split = 'test') * 100 AS t, avg(is_fraud) FILTER (split = 'train') * 100 AS r FROM parts), "
    "i AS (SELECT abs((SELECT avg(amt) FROM parts WHERE split = 'train') - (SELECT global_mean FROM gbase)) AS gap), "
    "c AS (" + " UNION ALL ".join(f"SELECT abs({S.r(f'corr({f}, is_fraud)', 4)}) AS v FROM feat" for f in FEATURES) + "), "
    "k AS (SELECT 'cross_split_id_overlap' AS check_name, count(*) = count(DISTINCT trans_num) AS passed FROM parts UNION ALL "
    "SELECT 'target_feature_correlation', max(v) <= 0.9 FROM c UNION ALL SELECT 'preprocessor_partition_isolation', gap < 1e-4 FROM i UNION ALL "
    "SELECT 'temporal_velocity_direction', nonzero_first = 0 AND changed_rows = 0 FROM look UNION ALL SELECT 'test_set_distribution_authenticity', t < 5 AND abs(t - r) < 0.2 FROM a) "
    "SELECT * FROM k UNION ALL SELECT 'overall_audit_passed', bool_and(passed) FROM k",
)
def report(spark, sf_dir):
    parts = stored_split(spark, sf_dir)
    train = parts.where("split = 'train'")
    base = Baselines.fit(train)
    return audit.audit_report(parts, stored(add_features(train, base), "train-features"), base.globals_, _middle(parts))
