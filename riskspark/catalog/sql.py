"""Building blocks of the SQL oracles. They restate the semantics independently of the operators."""

from __future__ import annotations

TXN = """
k_events AS (SELECT *, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events),
txn AS (
  SELECT CAST(event_id AS VARCHAR) AS trans_num, ts AS trans_ts, user_id AS cc_num,
    CASE event_type WHEN 'click' THEN 'shopping_net' WHEN 'view' THEN 'grocery_pos' WHEN 'purchase' THEN 'misc_net'
                    WHEN 'signup' THEN 'travel' WHEN 'error' THEN 'shopping_pos' END AS category,
    value * 10::DOUBLE AS amt,
    -60::DOUBLE + ((user_id * 7919) % 12000)::DOUBLE / 100::DOUBLE AS lat,
    -180::DOUBLE + ((user_id * 104729) % 36000)::DOUBLE / 100::DOUBLE AS long,
    (-60::DOUBLE + ((user_id * 7919) % 12000)::DOUBLE / 100::DOUBLE)
      + (CASE WHEN k < 5 THEN 20::DOUBLE ELSE ((k % 10) - 5)::DOUBLE / 100::DOUBLE END) AS merch_lat,
    (-180::DOUBLE + ((user_id * 104729) % 36000)::DOUBLE / 100::DOUBLE) + ((k % 7) - 3)::DOUBLE / 100::DOUBLE AS merch_long,
    CASE WHEN user_id % 97 <> 0 THEN make_date(1940 + (user_id * 31) % 70, 1 + user_id % 12, 1 + user_id % 28) END AS dob,
    CASE WHEN (k < 5 AND value > 60) OR value > 250 THEN 1 ELSE 0 END AS is_fraud
  FROM k_events)"""

DENSE = TXN + ", dense AS (SELECT * REPLACE (cc_num % 15 AS cc_num) FROM txn)"

DIRTY = TXN + """,
dirty AS (
  SELECT t.* REPLACE (
      CASE WHEN e % 103 <> 0 THEN CASE WHEN e % 107 = 0 THEN 0::DOUBLE ELSE amt END END AS amt,
      CASE WHEN e % 109 <> 0 THEN lat END AS lat,
      CASE WHEN e % 113 = 0 THEN 95::DOUBLE ELSE merch_lat END AS merch_lat,
      CASE WHEN e % 127 <> 0 THEN category END AS category),
    e AS event_id, copy_no
  FROM (SELECT *, CAST(trans_num AS BIGINT) AS e FROM txn) t
  JOIN (SELECT 0 AS copy_no UNION ALL SELECT 1) c ON c.copy_no = 0 OR t.e % 101 = 0),
firsts AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY trans_num ORDER BY event_id, copy_no) AS rn FROM dirty) WHERE rn = 1),
paid AS (SELECT * FROM firsts WHERE amt > 0),
located AS (
  SELECT * FROM paid WHERE NOT coalesce(lat < -90 OR lat > 90, false) AND NOT coalesce(long < -180 OR long > 180, false)
    AND NOT coalesce(merch_lat < -90 OR merch_lat > 90, false) AND NOT coalesce(merch_long < -180 OR merch_long > 180, false))"""

ORDERS = """
otxn AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS trans_num, o_orderdate AS trans_ts, o_custkey AS cc_num, o_totalprice AS amt,
         c_mktsegment AS category
  FROM orders JOIN customer ON o_custkey = c_custkey)"""


def r(x: str, digits: int) -> str:
    """Half-even rounding on the scaled value."""
    return f"round_even(({x}) * 1e{digits}, 0) / 1e{digits}" if digits else f"round_even(({x})::DOUBLE, 0)"


def fixed(x: str, digits: int) -> str:
    return f"printf('%.{digits}f', {r(x, digits)})"


def pct(part: str, whole: str) -> str:
    return f"(({part})::DOUBLE / greatest({whole}, 1)::DOUBLE * 100::DOUBLE)"


def div(a: str, b: str) -> str:
    return f"coalesce(({a})::DOUBLE / nullif(({b})::DOUBLE, 0), 0)"


KM = (
    "2 * 6371.0::DOUBLE * atan2(sqrt(hv), sqrt(1 - hv))"
)
HV = (
    "(power(sin(radians(merch_lat - lat) / 2), 2) + cos(radians(lat)) * cos(radians(merch_lat)) "
    "* power(sin(radians(merch_long - long) / 2), 2))"
)


def distance(src: str, name: str = "dist") -> str:
    return f", {name} AS (SELECT * EXCLUDE (hv), {KM} AS haversine_distance_km FROM (SELECT *, {HV} AS hv FROM {src}))"


def baselines(src: str = "txn") -> str:
    return f""",
gbase AS (SELECT avg(amt) AS global_mean, quantile_cont(amt, 0.5) AS global_median, avg(is_fraud) AS global_rate FROM {src}),
cards AS (SELECT cc_num, avg(amt) AS card_mean FROM {src} WHERE cc_num IS NOT NULL GROUP BY cc_num),
cats AS (SELECT category, quantile_cont(amt, 0.5) AS category_median, avg(is_fraud) AS category_rate
         FROM {src} WHERE category IS NOT NULL GROUP BY category)"""


def velocity(src: str, out: str, scope: str = "", columns: str = "*") -> str:
    keys = f"{scope}, cc_num" if scope else "cc_num"
    return f""", {out} AS (
  SELECT {columns},
    count(*) OVER (PARTITION BY {keys} ORDER BY epoch_us(trans_ts) RANGE BETWEEN 3599999999 PRECEDING AND 1 PRECEDING)
      + row_number() OVER (PARTITION BY {keys}, trans_ts ORDER BY trans_num) - 1 AS trans_velocity_1h,
    count(*) OVER (PARTITION BY {keys} ORDER BY epoch_us(trans_ts) RANGE BETWEEN 86399999999 PRECEDING AND 1 PRECEDING)
      + row_number() OVER (PARTITION BY {keys}, trans_ts ORDER BY trans_num) - 1 AS trans_velocity_24h
  FROM {src})"""


def features(src: str = "txn", fit: str | None = None, scope: str = "") -> str:
    """feat: every feature on the row, baselines fitted on ``fit``."""
    return (
        baselines(fit or src)
        + distance(src)
        + velocity("dist", "vel", scope)
        + """,
feat AS (
  SELECT v.*, CAST(hour(trans_ts) AS INTEGER) AS hour, CAST(isodow(trans_ts) - 1 AS INTEGER) AS day_of_week,
    CASE WHEN hour(trans_ts) BETWEEN 0 AND 5 THEN 1 ELSE 0 END AS is_night_transaction,
    least(greatest(coalesce((year(trans_ts) - year(dob))::DOUBLE, 40), 18), 100) AS customer_age,
    amt / (coalesce(card_mean, global_mean) + 1e-5) AS amt_to_user_avg_ratio,
    amt / (coalesce(category_median, global_median) + 1e-5) AS amt_to_cat_median_ratio,
    coalesce(category_rate, global_rate) AS category_fraud_rate
  FROM vel v LEFT JOIN cards USING (cc_num) LEFT JOIN cats USING (category) CROSS JOIN gbase)"""
    )


SEVERITIES = """,
sev AS (
  SELECT *,
    CASE WHEN amt >= 500 AND amt_to_cat_median_ratio >= 3 THEN least(1::DOUBLE, amt / 1000::DOUBLE * 0.8::DOUBLE) END AS s1,
    CASE WHEN amt_to_user_avg_ratio >= 4 THEN least(1::DOUBLE, amt_to_user_avg_ratio / 8) END AS s2,
    CASE WHEN haversine_distance_km >= 300 THEN least(1::DOUBLE, haversine_distance_km / 1200) END AS s3,
    CASE WHEN trans_velocity_1h >= 2 THEN least(1::DOUBLE, trans_velocity_1h / 3::DOUBLE)
         WHEN trans_velocity_24h >= 4 THEN least(1::DOUBLE, trans_velocity_24h / 6::DOUBLE) END AS s4,
    CASE WHEN is_night_transaction = 1 THEN CASE WHEN amt < 200 THEN 0.7::DOUBLE ELSE 1::DOUBLE END END AS s5,
    CASE WHEN lower(category) IN ('shopping_net', 'misc_net', 'shopping_pos') AND amt >= 250 THEN 0.8::DOUBLE END AS s6
  FROM feat),
sig AS (
  SELECT *,
    least(greatest(round_even((coalesce(25 * s1, 0) + coalesce(30 * s2, 0) + coalesce(20 * s3, 0) + coalesce(20 * s4, 0)
      + coalesce(15 * s5, 0) + coalesce(10 * s6, 0)) * 10, 0) / 10, 0), 100) AS behavioral_score,
    (s1 IS NOT NULL)::INT + (s2 IS NOT NULL)::INT + (s3 IS NOT NULL)::INT + (s4 IS NOT NULL)::INT
      + (s5 IS NOT NULL)::INT + (s6 IS NOT NULL)::INT AS signal_count,
    concat_ws('; ', CASE WHEN s1 IS NOT NULL THEN 'Extreme Amount Outlier' END, CASE WHEN s2 IS NOT NULL THEN 'Cardholder Spend Spike' END,
      CASE WHEN s3 IS NOT NULL THEN 'Geographical Jump' END, CASE WHEN s4 IS NOT NULL THEN 'High Velocity Burst' END,
      CASE WHEN s5 IS NOT NULL THEN 'Late Night / Off-Hours' END, CASE WHEN s6 IS NOT NULL THEN 'High-Dispute Sector' END) AS signal_names
  FROM sev)"""

P_ML = r("least(1::DOUBLE, amt_to_user_avg_ratio / 10)", 6)
S_ANOM = r("least(100::DOUBLE, haversine_distance_km / 20)", 6)


def surrogates(src: str, out: str) -> str:
    return f", {out} AS (SELECT *, {P_ML} AS p_ml, {S_ANOM} AS s_anom FROM {src})"


def fused(w_ml: str, w_anomaly: str, w_rules: str) -> str:
    return f"CAST(least(greatest(round_even({w_ml} * (p_ml * 100) + {w_anomaly} * s_anom + {w_rules} * behavioral_score, 0), 0), 100) AS INTEGER)"


def tier(score: str = "hybrid_score", low: str = "35", medium: str = "69") -> str:
    return f"CASE WHEN {score} <= {low} THEN 'LOW RISK' WHEN {score} <= {medium} THEN 'MEDIUM RISK' ELSE 'HIGH RISK' END"


COMPONENTS = TXN + features() + SEVERITIES + surrogates("sig", "comp")
SCORED = COMPONENTS + f""",
scored0 AS (SELECT *, {fused('0.5::DOUBLE', '0.25::DOUBLE', '0.25::DOUBLE')} AS hybrid_score FROM comp),
scored AS (SELECT *, {tier()} AS risk_level FROM scored0)"""

PROBS = TXN + baselines() + distance("txn") + """,
ratios AS (SELECT d.*, amt / (coalesce(card_mean, global_mean) + 1e-5) AS amt_to_user_avg_ratio
           FROM dist d LEFT JOIN cards USING (cc_num) CROSS JOIN gbase)""" + surrogates("ratios", "probs")


def split(src: str, out: str) -> str:
    """Exact 70/15/15 split per class in hash order; largest remainders, ties to the smaller class."""
    return f""",
sizes AS (SELECT is_fraud, count(*) AS n, sum(count(*)) OVER () AS t FROM {src} GROUP BY is_fraud),
held AS (SELECT *, ceil(0.3::DOUBLE * t) AS h FROM sizes),
tr0 AS (SELECT *, (t - h) * n / t AS ex FROM held),
tr AS (SELECT *, floor(ex) + CASE WHEN row_number() OVER (ORDER BY ex - floor(ex) DESC, n, is_fraud)
         <= (t - h) - sum(floor(ex)) OVER () THEN 1 ELSE 0 END AS n_train FROM tr0),
va0 AS (SELECT *, (h - ceil(0.5::DOUBLE * h)) * (n - n_train) / sum(n - n_train) OVER () AS ev FROM tr),
va AS (SELECT *, floor(ev) + CASE WHEN row_number() OVER (ORDER BY ev - floor(ev) DESC, n, is_fraud)
         <= (h - ceil(0.5::DOUBLE * h)) - sum(floor(ev)) OVER () THEN 1 ELSE 0 END AS n_val FROM va0),
{out} AS (
  SELECT s.* EXCLUDE (rn), CASE WHEN rn <= n_train THEN 'train' WHEN rn <= n_train + n_val THEN 'val' ELSE 'test' END AS split
  FROM (SELECT *, row_number() OVER (PARTITION BY is_fraud ORDER BY md5(concat_ws('|', 's42', trans_num)), trans_num) AS rn FROM {src}) s
  JOIN va USING (is_fraud))"""


VALID = """,
valid AS (SELECT * FROM txn WHERE amt > 0 AND abs(lat) <= 90 AND abs(long) <= 180 AND abs(merch_lat) <= 90 AND abs(merch_long) <= 180)"""
SPLIT = TXN + VALID + split("valid", "parts")
SPLIT_PROBS = SPLIT + baselines("parts") + distance("parts") + """,
ratios AS (SELECT d.*, amt / (coalesce(card_mean, global_mean) + 1e-5) AS amt_to_user_avg_ratio
           FROM dist d LEFT JOIN cards USING (cc_num) CROSS JOIN gbase)""" + surrogates("ratios", "probs")


def confusion(src: str, flag: str, out: str = "cm", by: str = "") -> str:
    g, s = (f"GROUP BY {by}", f"{by},") if by else ("", "")
    return f""", {out} AS (
  SELECT {s} count(*) FILTER (is_fraud = 1 AND ({flag})) AS tp, count(*) FILTER (is_fraud = 0 AND ({flag})) AS fp,
    count(*) FILTER (is_fraud = 1 AND NOT ({flag})) AS fn, count(*) FILTER (is_fraud = 0 AND NOT ({flag})) AS tn,
    coalesce(sum(amt) FILTER (is_fraud = 1 AND ({flag})), 0) AS tp_amt, coalesce(sum(amt) FILTER (is_fraud = 0 AND ({flag})), 0) AS fp_amt,
    coalesce(sum(amt) FILTER (is_fraud = 1 AND NOT ({flag})), 0) AS fn_amt
  FROM {src} {g})"""


PRECISION = r(div("tp", "tp + fp"), 4)
RECALL = r(div("tp", "tp + fn"), 4)
F1 = r(div("2 * tp", "2 * tp + fp + fn"), 4)
F2 = r(div("5 * tp", "5 * tp + 4 * fn + fp"), 4)
FPR = r(div("fp", "fp + tn"), 4)
RATES = f"{PRECISION} AS precision, {RECALL} AS recall, {F1} AS f1"
RATES5 = f"{RATES}, {F2} AS f2, {FPR} AS fpr"


def costs(operational: str = "0") -> str:
    fn = f"fn_amt + fn * 20 + fn * {operational}"
    fp = "fp_amt * 0.2::DOUBLE + fp * 10"
    saved = "tp_amt + tp * 20"
    return (
        f"{r(fn, 2)} AS fn_cost, {r(fp, 2)} AS fp_cost, {r(f'{fn} + {fp}', 2)} AS total_cost, "
        f"{r(saved, 2)} AS fraud_loss_prevented, {r(f'{saved} - ({fp})', 2)} AS net_capital_saved"
    )


def curve(src: str, score: str, by: str = "", out: str = "curve") -> str:
    """Cumulative counts by descending distinct score."""
    s, p = (f"{by},", f"PARTITION BY {by}") if by else ("", "")
    return f""",
{out}_h AS (SELECT {s} {score} AS score, count(*) FILTER (is_fraud = 1) AS pos, count(*) FILTER (is_fraud = 0) AS neg
  FROM {src} GROUP BY ALL),
{out} AS (SELECT *, sum(pos) OVER ({p} ORDER BY score DESC) AS tp, sum(neg) OVER ({p} ORDER BY score DESC) AS fp,
    sum(pos) OVER ({p}) AS positives, sum(neg) OVER ({p}) AS negatives FROM {out}_h)"""


def area(src: str = "curve", by: str = "", out: str = "area", digits: int = 4) -> str:
    s, p, g = (f"{by},", f"PARTITION BY {by}", f"GROUP BY {by}") if by else ("", "", "")
    return f""",
{out}_p AS (SELECT {s} score, {div('tp', 'tp + fp')} AS y, {div('tp', 'positives')} AS x, {div('fp', 'negatives')} AS f FROM {src}),
{out}_l AS (SELECT *, lag(y, 1, 1) OVER ({p} ORDER BY score DESC) AS y0, lag(x, 1, 0) OVER ({p} ORDER BY score DESC) AS x0,
    lag(f, 1, 0) OVER ({p} ORDER BY score DESC) AS f0 FROM {out}_p),
{out} AS (SELECT {s} {r('sum((x - x0) * (y + y0) / 2)', digits)} AS pr_auc, {r('sum((f - f0) * (x + x0) / 2)', digits)} AS roc_auc
  FROM {out}_l {g})"""
