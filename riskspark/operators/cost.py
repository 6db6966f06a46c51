"""Money cost of decisions, threshold sweeps in one pass, cost-optimal cut-offs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskspark.config import WITH_OPERATIONS, CostConfig
from riskspark.functions.numeric import half_even, ratio

CELLS = ("tp", "fp", "fn", "tn")


def confusion(df: DataFrame, flagged: Column, label: str = "is_fraud", amount: str | None = "amt", by: Sequence[str] = ()) -> DataFrame:
    """Confusion counts, and the amount in each cell, in one aggregation."""
    pos = F.col(label) == 1
    cells = {"tp": pos & flagged, "fp": ~pos & flagged, "fn": pos & ~flagged, "tn": ~pos & ~flagged}
    aggs = [F.count_if(c).alias(n) for n, c in cells.items()]
    if amount:
        aggs += [F.coalesce(F.sum(F.when(c, F.col(amount))), F.lit(0.0)).alias(f"{n}_amt") for n, c in cells.items()]
    return df.groupBy(*by).agg(*aggs)


def counted_confusion(df: DataFrame, flagged: Column, label: str = "is_fraud", rows: str = "n", amount: str = "amount") -> DataFrame:
    """The same from rows that stand for ``rows`` transactions of ``amount`` together."""
    pos = F.col(label) == 1
    cells = {"tp": pos & flagged, "fp": ~pos & flagged, "fn": pos & ~flagged, "tn": ~pos & ~flagged}
    total = lambda c, x, none: F.coalesce(F.sum(F.when(c, F.col(x))), none)
    return df.agg(
        *[total(c, rows, F.lit(0).cast("bigint")).alias(n) for n, c in cells.items()], *[total(c, amount, F.lit(0.0)).alias(f"{n}_amt") for n, c in cells.items()])


def rates() -> dict[str, Column]:
    """Ratios of the confusion counts; an undefined ratio is 0."""
    tp, fp, fn, tn = (F.col(c) for c in CELLS)
    return {
        "precision": half_even(ratio(tp, tp + fp), 4),
        "recall": half_even(ratio(tp, tp + fn), 4),
        "f1": half_even(ratio(2 * tp, 2 * tp + fp + fn), 4),
        "f2": half_even(ratio(5 * tp, 5 * tp + 4 * fn + fp), 4),
        "fpr": half_even(ratio(fp, fp + tn), 4),
        "fnr": half_even(ratio(fn, fn + tp), 4),
        "accuracy": half_even(ratio(tp + tn, tp + fp + fn + tn), 4),
        "specificity": half_even(ratio(tn, tn + fp), 4),
    }


def costs(cfg: CostConfig = WITH_OPERATIONS) -> dict[str, Column]:
    """Cost columns from confusion counts and amounts; cents are rounded last."""
    missed = F.col("fn_amt") + F.col("fn") * cfg.chargeback_fee + F.col("fn") * cfg.operational_cost
    declined = F.col("fp_amt") * cfg.merchant_margin + F.col("fp") * cfg.customer_friction
    prevented = F.col("tp_amt") + F.col("tp") * cfg.chargeback_fee
    return {
        "fn_cost": half_even(missed, 2),
        "fp_cost": half_even(declined, 2),
        "total_cost": half_even(missed + declined, 2),
        "fraud_loss_prevented": half_even(prevented, 2),
        "net_capital_saved": half_even(prevented - declined, 2),
    }


def cost_breakdown(df: DataFrame, flagged: Column, cfg: CostConfig = WITH_OPERATIONS, by: Sequence[str] = ()) -> DataFrame:
    picked = {n: c for n, c in rates().items() if n in ("precision", "recall", "f1")}
    return confusion(df, flagged, by=by).withColumns({**picked, **costs(cfg)}).drop(*[f"{c}_amt" for c in CELLS])


def sweep_counts(df: DataFrame, score: str, thresholds: Sequence, label: str = "is_fraud", amount: str = "amt", by: Sequence[str] = ()) -> DataFrame:
    """Confusion counts and amounts at every threshold from one aggregation of the data.

    Rows are counted per interval between thresholds (at most one more row than
    thresholds per group), and each threshold sums the intervals above it.
    """
    steps = sorted(thresholds)
    grid = F.array(*[F.lit(t) for t in steps])
    rows = df
    if dict(df.dtypes)[score] in ("int", "bigint"):  # a bounded score domain: place each score once
        rows = df.groupBy(*by, score, label).agg(F.count(F.lit(1)).alias("_n"), F.sum(amount).alias("_amt"))
    else:
        rows = df.select(*by, score, label, F.lit(1).cast("bigint").alias("_n"), F.col(amount).alias("_amt"))
    passed = sum((F.col(score) >= t).cast("int") for t in steps)
    pos = F.col(label) == 1

    def total(condition: Column, what: str) -> Column:
        return F.coalesce(F.sum(F.when(condition, F.col(what))), F.lit(0).cast("double" if what == "_amt" else "bigint"))

    intervals = rows.withColumn("_passed", passed).groupBy(*by, "_passed").agg(
        total(pos, "_n").alias("_pos"), total(~pos, "_n").alias("_neg"),
        total(pos, "_amt").alias("_pos_amt"), total(~pos, "_amt").alias("_neg_amt"),
    )
    at = intervals.select("*", F.posexplode(grid).alias("_index", "threshold"))
    above = F.col("_passed") > F.col("_index")

    def cell(condition: Column, what: str) -> Column:
        zero = F.lit(0).cast("double" if what.endswith("amt") else "bigint")
        return F.sum(F.when(condition, F.col(what)).otherwise(zero))

    return at.groupBy(*by, "threshold").agg(
        cell(above, "_pos").alias("tp"), cell(above, "_neg").alias("fp"),
        cell(~above, "_pos").alias("fn"), cell(~above, "_neg").alias("tn"),
        cell(above, "_pos_amt").alias("tp_amt"), cell(above, "_neg_amt").alias("fp_amt"),
        cell(~above, "_pos_amt").alias("fn_amt"), cell(~above, "_neg_amt").alias("tn_amt"),
    )


def sweep(
    df: DataFrame, score: str, thresholds: Sequence = tuple(range(1, 100)), cfg: CostConfig = WITH_OPERATIONS, by: Sequence[str] = (), **columns
) -> DataFrame:
    """Rates and costs at every threshold."""
    wanted = {n: c for n, c in rates().items() if n in ("precision", "recall", "f1", "f2", "fpr")}
    counts = sweep_counts(df, score, thresholds, by=by, **columns)
    return counts.withColumns({**wanted, **costs(cfg)}).drop(*[f"{c}_amt" for c in CELLS])


def cheapest(swept: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """The row of least total cost; equal costs go to the lowest threshold."""
    rest = [c for c in swept.columns if c not in by]
    best = F.min_by(F.struct(*rest), F.struct("total_cost", "threshold")).alias("_best")
    return swept.groupBy(*by).agg(best).select(*by, "_best.*")


def policy_columns(cfg: CostConfig) -> list[Column]:
    """Approving everything against the policy at hand, from confusion counts and amounts."""
    unmitigated = F.col("tp_amt") + F.col("fn_amt") + (F.col("tp") + F.col("fn")) * cfg.chargeback_fee
    missed = F.col("fn_amt") + F.col("fn") * (cfg.chargeback_fee + cfg.operational_cost)
    declined = F.col("fp_amt") * cfg.merchant_margin + F.col("fp") * cfg.customer_friction
    saved = unmitigated - (missed + declined)
    return [
        half_even(unmitigated, 2).alias("unmitigated_cost"),
        half_even(declined, 2).alias("fp_cost"),
        half_even(missed, 2).alias("fn_cost"),
        half_even(missed + declined, 2).alias("total_cost"),
        half_even(saved, 2).alias("net_savings"),
        half_even(ratio(saved, unmitigated) * 100.0, 2).alias("preservation_pct"),
    ]


def policy_comparison(df: DataFrame, flagged: Column, cfg: CostConfig) -> DataFrame:
    return confusion(df, flagged).select(*policy_columns(cfg))
