"""Left lookup joins that survive hot keys and lookups of any size."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BROADCAST_ROWS = 500_000
HOT_ROWS = 1_000_000
HOT_KEYS = 10_000
SALTS = 64


def fits(df: DataFrame, rows: int | None = None) -> bool:
    """Does the written table hold at most ``rows`` rows? Answered from file footers."""
    return df.count() <= (BROADCAST_ROWS if rows is None else rows)


def hot_keys(df: DataFrame, key: str, rows_column: str, hot_rows: int | None = None, keys: int = HOT_KEYS) -> DataFrame:
    """The heaviest keys above ``hot_rows``. At most ``keys`` of them, so broadcasting them is bounded;
    callers must be exact for any choice of hot keys."""
    return (
        df.where(F.col(rows_column) >= (HOT_ROWS if hot_rows is None else hot_rows))
        .orderBy(F.col(rows_column).desc(), F.col(key))
        .limit(keys)
    )


def lookup_join(
    df: DataFrame,
    lookup: DataFrame,
    key: str,
    small: bool,
    rows_column: str | None = None,
    salt_by: str | None = None,
    hot_rows: int | None = None,
) -> DataFrame:
    """Left join of a table with one row per key.

    ``small`` is the outcome of a size check: then the lookup is broadcast and
    the big side is not moved. Otherwise the hot keys (``rows_column`` holds the
    fitted row count per key) are served from a bounded broadcast, their rows
    are spread over salts no lookup row carries, and only the cold rest meets
    the lookup in a shuffle join.
    """
    values = [c for c in lookup.columns if c not in (key, rows_column)]
    slim = lookup.select(key, *values)
    if small:
        return df.join(F.broadcast(slim), key, "left")
    if rows_column is None or salt_by is None:
        return df.join(slim, key, "left")
    hot = hot_keys(lookup, key, rows_column, hot_rows).select(
        key, F.lit(True).alias("_hot"), *[F.col(c).alias(f"_hot_{c}") for c in values]
    )
    served = F.coalesce(F.col("_hot"), F.lit(False)) | F.col(key).isNull()  # a null key finds nothing wherever it goes
    spread = F.when(served, F.pmod(F.xxhash64(salt_by), F.lit(SALTS)) + 1).otherwise(F.lit(0).cast("bigint"))
    cold = slim.withColumn("_salt", F.lit(0).cast("bigint"))
    joined = (
        df.join(F.broadcast(hot), key, "left")
        .withColumn("_salt", spread)
        .join(cold, [key, "_salt"], "left")
        .withColumns({c: F.coalesce(F.col(f"_hot_{c}"), F.col(c)) for c in values})
    )
    return joined.drop("_hot", "_salt", *[f"_hot_{c}" for c in values])
