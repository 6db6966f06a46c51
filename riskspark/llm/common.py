"""Shared pieces: reading tables, Arrow row functions, written tables, prefix sums, components.

Every operator takes ``id_col`` and ``text_col`` names and reads nothing else unless its docstring
says so. An input column named like a result column is replaced by the result.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from riskspark.session import shared_folder


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """Write to the shared folder and read back: cuts lineage and survives lost executors. The write's
    shuffle files go when it has ended, not when the driver happens to collect garbage."""
    spark, cleanup = df.sparkSession, "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    path, before = shared_folder(spark, purpose), spark.conf.get(cleanup)
    spark.conf.set(cleanup, "true")
    try:
        df.write.mode("overwrite").parquet(path)
    finally:
        spark.conf.set(cleanup, before)
    return spark.read.schema(df.schema).parquet(path)


def schema_of(ddl: str) -> T.StructType:
    return T.StructType.fromDDL(ddl)


def map_batches(df: DataFrame, fn: Callable[..., list], ddl: str, keep: bool = False) -> DataFrame:
    """``fn(*columns as lists)`` returns one list of values per column of ``ddl``.

    With ``keep`` the input columns stay before the new ones, which then need a value per row.
    """
    new = schema_of(ddl)
    stay = [f for f in df.schema.fields if f.name not in new.names] if keep else []
    out = T.StructType([*stay, *new.fields])
    arrow, names, old = to_arrow_schema(out), new.names, [f.name for f in stay]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = fn(*[c.to_pylist() for c in batch.columns])
            arrays = [batch.column(batch.schema.get_field_index(n)) for n in old]
            arrays += [pa.array(v, type=arrow.field(n).type) for n, v in zip(names, made, strict=True)]
            yield pa.RecordBatch.from_arrays(arrays, schema=pa.schema([*[pa.field(n, a.type) for n, a in zip(old, arrays)], *[arrow.field(n) for n in names]]))

    return df.mapInArrow(run, out)


def unused(df: DataFrame, name: str) -> str:
    """``name``, or a longer one where an input column has it."""
    while name in df.columns:
        name += "_"
    return name


def with_results(df: DataFrame, text_col: str, fn: Callable[[str | None], tuple], ddl: str) -> DataFrame:
    """One result row per input row: every input column, then the columns of ``ddl`` from ``fn(text)``."""
    new, text = schema_of(ddl), unused(df, "__text")
    width = len(new.names)
    stay = [c for c in df.columns if c not in new.names]
    out = T.StructType([*[df.schema[c] for c in stay], *new.fields])
    arrow = to_arrow_schema(out)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [fn(t.as_py()) for t in batch.column(len(stay))]  # one text at a time in Python
            made = list(zip(*rows)) if rows else [()] * width
            arrays = [batch.column(i) for i in range(len(stay))]
            arrays += [pa.array(list(v), type=arrow.field(len(stay) + i).type) for i, v in enumerate(made)]
            fields = [pa.field(n, a.type) for n, a in zip(stay, arrays)] + [arrow.field(len(stay) + i) for i in range(width)]
            yield pa.RecordBatch.from_arrays(arrays, schema=pa.schema(fields))

    return df.select(*[F.col(f"`{c}`") for c in stay], F.col(f"`{text_col}`").alias(text)).mapInArrow(run, out)


def row_key(id_col: str, text_col: str) -> Column:
    """Rows with the same id and text share a key; they get the same result. Never null."""
    return F.concat_ws(":", F.coalesce(F.col(id_col).cast("string"), F.lit("-")), F.hex(F.xxhash64(text_col)), F.coalesce(F.octet_length(text_col), F.lit(-1)).cast("string"))


def joined_by_key(rows: DataFrame, small: DataFrame, on: list[str], how: str = "left", limit: int = 200_000) -> DataFrame:
    """Join with a written lookup of one row per key: broadcast when its counted rows are at most
    ``limit``, otherwise a shuffle join that Spark may split where a key is hot."""
    few = small.count() <= limit
    return rows.join(F.broadcast(small) if few else small.hint("merge"), on, how)


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """Connected components of an undirected edge table (a, b: long): node, root.

    Contraction: each round every node moves to the neighbour of least random rank, edges between
    moved nodes stay, and only nodes that something moved to live on, so chains as well as stars
    shrink by a constant share a round. Every round is a written table; nothing is collected.
    """
    def rank(c: str, k: int) -> Column:
        return F.struct(F.xxhash64(F.col(c), F.lit(k)).alias("h"), F.col(c).alias("n"))

    edges = stored(edges.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "edges")
    nodes = stored(edges.select(F.col("a").alias("node")).union(edges.select("b")).distinct().withColumn("root", F.col("node")), "nodes")
    for k in range(max_rounds):
        if edges.isEmpty():
            return nodes
        both = edges.union(edges.select("b", "a"))
        moves = stored(
            both.groupBy(F.col("a").alias("old")).agg(F.min(rank("b", k)).alias("r"))
            .select("old", F.least(F.col("r"), rank("old", k))["n"].alias("new")), "moves")
        nodes = stored(nodes.join(moves, nodes.root == moves.old, "left").select("node", F.coalesce("new", "root").alias("root")), "nodes")
        at = [moves.select(F.col("old").alias(c), F.col("new").alias(f"to_{c}")) for c in ("a", "b")]
        edges = stored(
            edges.join(at[0], "a").join(at[1], "b").where("to_a <> to_b")
            .select(F.least("to_a", "to_b").alias("a"), F.greatest("to_a", "to_b").alias("b")).distinct(), "edges")
    raise RuntimeError(f"components did not settle in {max_rounds} rounds")
