"""Temperature mixing of sources, in DataFrame functions only.

Source s holds the share p_s of all tokens (runs of non-blanks). Weights are w_s = p_s^a / sum p^a. The
exponent a in [0, 1] is bisected to the flattest mixture that keeps a limit:
* ``repeats``: no source is passed over more often than ``limit`` times;
* ``entropy``: the weights' entropy is at least ``limit`` nats (the mixture closest to the shares).
Without a token budget the mixture is as small as can be with every document in it at least once: the
largest source is used once, the others are repeated. A budget cuts each source's stream at its weight.

Block permutations: a source is a stream of epochs, each a fresh permutation of its documents by hash. A
document in epoch e starts at e times the source's tokens plus the tokens before it in the permutation.
It is taken while it starts before the source's budget, and falls into the block that its start has
reached: every block holds each source's quota of tokens, up to one document.

Sums before a document are two-level: sqrt(n) hash buckets a source, their totals summed up, then a
window per bucket, so a source with a third of all rows spreads over many tasks. Source statistics are
a table joined by checked size; the bisection sends a fixed number of sums to the driver per step.

Null and empty texts have no tokens; they are taken once while their source is used whole. A null source
is the source ''. Rows of equal id and text are neighbours in each permutation. Empty tables give empty
results. A single source has weight 1.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskspark.llm.common import joined_by_key, stored

TOKEN = r"[^\x20\x09-\x0D]+"
DIGITS = 6  # of the exponent
HALVINGS = 4  # per pass over the source table


def token_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(TOKEN)), F.lit(0)).cast("long")


def bisected(sources: DataFrame, total: int, most: int, target: str, limit: float) -> float:
    """The least exponent within the repetition limit, or the greatest that reaches the entropy."""
    share = F.col("tokens") / F.lit(float(total))

    def kept(points: list[float]) -> list[bool]:
        if target == "repeats":
            # passes over source s relative to the largest one, which is used once
            sums = [F.max(F.pow(share / F.lit(most / total), F.lit(a - 1.0))) for a in points]
            return [v <= limit for v in sources.agg(*sums).first()]
        cols = []
        for a in points:
            z = F.sum(F.pow(share, F.lit(a)))
            cols.append(F.log(z) - F.lit(a) * F.sum(F.pow(share, F.lit(a)) * F.log(share)) / z)
        return [v >= limit for v in sources.agg(*cols).first()]

    low, high, parts = 0.0, 1.0, 2**HALVINGS
    ends = kept([low, high])
    if target == "repeats" and ends[0]:
        return low
    if target == "entropy" and (ends[1] or not ends[0]):
        return high if ends[1] else low
    while high - low > 10.0 ** -(DIGITS + 2):
        step = (high - low) / parts
        points = [low + step * i for i in range(1, parts)]
        # repeats: false then true, entropy: true then false
        flags = [f == (target == "entropy") for f in kept(points)]
        at = flags.index(False) if False in flags else parts - 1
        low, high = low + step * at, low + step * (at + 1)
    scale = 10**DIGITS
    return math.ceil(high * scale - 1e-3) / scale if target == "repeats" else math.floor(low * scale + 1e-3) / scale


def weighted_sources(rows: DataFrame, target: str, limit: float, budget: int | None, block_tokens: int) -> DataFrame:
    """source, tokens, n, weight, budget, quota for every source."""
    sources = stored(rows.groupBy("source").agg(F.sum("tokens").alias("tokens"), F.count("*").alias("n")), "mixing-sources")
    total, most = sources.agg(F.sum("tokens"), F.max("tokens")).first()
    if not total:
        return sources.withColumns({"weight": F.lit(0.0), "budget": F.lit(0).cast("long"), "quota": F.lit(1).cast("long")})
    used = sources.where("tokens > 0")
    a = bisected(used, total, most, target, limit)
    raised = F.when(F.col("tokens") > 0, F.pow(F.col("tokens") / F.lit(float(total)), F.lit(a))).otherwise(F.lit(0.0))
    norm = used.agg(F.sum(raised)).first()[0]
    weight = raised / F.lit(norm)
    if budget is None:
        tokens = F.round(F.lit(float(most)) * F.pow(F.col("tokens") / F.lit(float(most)), F.lit(a)))
        tokens = F.greatest(tokens.cast("long"), F.col("tokens"))
    else:
        tokens = F.round(weight * F.lit(float(budget))).cast("long")
    return stored(sources.select(
        "source", "tokens", "n", weight.alias("weight"), F.when(F.col("tokens") > 0, tokens).otherwise(0).cast("long").alias("budget"),
        F.greatest(F.round(weight * F.lit(float(block_tokens))).cast("long"), F.lit(1)).alias("quota")), "mixing-weights")


def mixture(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", target: str = "repeats",
            limit: float = 2.0, budget: int | None = None, block_tokens: int = 1_000_000, seed: int = 1) -> DataFrame:
    """id_col, source, text_md5, n_tokens, epoch, start_token, block, order_key: a row per use of a document."""
    if target not in ("repeats", "entropy"):
        raise ValueError("target is repeats or entropy")
    rows = stored(docs.select(
        F.col(id_col).alias("id"), F.coalesce(F.col(source_col).cast("string"), F.lit("")).alias("source"), token_count(F.col(text_col)).alias("tokens"),
        F.md5(F.coalesce(F.col(text_col), F.lit("")).cast("binary")).alias("text_md5")), "mixing-rows")
    sources = weighted_sources(rows, target, limit, budget, block_tokens)
    stats = sources.select("source", F.col("tokens").alias("all_tokens"), "n", "budget", "quota")
    epochs = F.coalesce(F.greatest(F.ceil(F.col("budget") / F.nullif(F.col("all_tokens"), F.lit(0))), F.lit(1)), F.lit(1)).cast("int")
    key = F.md5(F.concat_ws("|", F.lit(str(seed)), F.col("epoch").cast("string"), F.coalesce(F.col("id").cast("string"), F.lit("")), F.col("text_md5")).cast("binary"))
    drawn = (
        joined_by_key(rows, stats, ["source"]).withColumn("epoch", F.explode(F.sequence(F.lit(0), epochs - 1)))
        .withColumn("order_key", key)
        .withColumn("bucket", F.shiftright(F.conv(F.substring("order_key", 1, 6), 16, 10).cast("long") * F.ceil(F.sqrt("n")), 24))
    )
    totals = drawn.groupBy("source", "epoch", "bucket").agg(F.sum("tokens").alias("in_bucket"))
    before = Window.partitionBy("source", "epoch").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = stored(totals.select("source", "epoch", "bucket", F.coalesce(F.sum("in_bucket").over(before), F.lit(0)).alias("offset")), "mixing-offsets")
    within = Window.partitionBy("source", "epoch", "bucket").orderBy("order_key").rowsBetween(Window.unboundedPreceding, -1)
    summed = drawn.withColumn("inside", F.coalesce(F.sum("tokens").over(within), F.lit(0)))
    start = F.col("epoch") * F.col("all_tokens") + F.col("offset") + F.col("inside")
    placed = joined_by_key(summed, offsets, ["source", "epoch", "bucket"]).withColumn("start_token", start)
    taken = (F.col("start_token") < F.col("budget")) | ((F.col("epoch") == 0) & (F.col("budget") >= F.col("all_tokens")))
    return placed.where(taken).select(
        F.col("id").alias(id_col), "source", "text_md5", F.col("tokens").alias("n_tokens"), "epoch", "start_token",
        F.expr("start_token div quota").alias("block"), "order_key")


def mixed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", **options) -> DataFrame:
    """The columns of ``docs``, each row as often as the mixture uses it."""
    found = mixture(docs, id_col, text_col, source_col, **options)
    uses = found.groupBy(F.col(id_col).alias("__id"), F.col("source").alias("__source"), F.col("text_md5").alias("__md5"), "epoch").agg(F.count("*").alias("rows"))
    # rows of equal id and text are used equally often in whole epochs; a cut inside of them uses the first
    uses = uses.groupBy("__id", "__source", "__md5").agg(F.sum("rows").alias("__uses"), F.max("rows").alias("__rows"))
    text = F.md5(F.coalesce(docs[text_col], F.lit("")).cast("binary"))
    on = docs[id_col].eqNullSafe(uses["__id"]) & (text == uses["__md5"]) & (F.coalesce(docs[source_col].cast("string"), F.lit("")) == uses["__source"])
    joined = docs.join(uses, on).select(*[docs[c] for c in docs.columns], F.ceil(F.col("__uses") / F.col("__rows")).cast("int").alias("__n"))
    return joined.withColumn("__n", F.explode(F.sequence(F.lit(1), F.col("__n")))).drop("__n")
