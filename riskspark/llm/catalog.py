"""Registered corpus queries and their SQL; the thin opN queries derive their columns from the operators."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from riskspark.llm import bytecnn, decontaminate, lines, merkle, mixing, quality, repeats, runs, secrets, shards, simhash, toxicity, warc
from riskspark.llm.common import table
from riskspark.llm.sql import ORACLES
from riskspark.session import shared_folder

Query = Callable[[SparkSession, str], DataFrame]


def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = mixing.mixture(table(spark, sf_dir, "documents"), target="repeats", limit=2.0)
    return found.select("doc_id", "source", "n_tokens", "epoch", "start_token", "block")


def op2_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: lines, removed lines with their code point offsets, a digest of what stays, lines that other documents hold."""
    found = lines.deduplicated(table(spark, sf_dir, "documents"))
    spans = F.array_join(F.transform("removed_spans", lambda s: F.concat_ws(":", s["start"].cast("string"), s["end"].cast("string"))), ",")
    return found.select(
        "doc_id", "n_units", "n_removed", "removed_chars", spans.alias("removed_spans"), F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"),
        "n_repeated", "repeated_words", "n_long_repeated")


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = toxicity.scored(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return found.select("doc_id", "held_out", "score", "predicted")


def op4_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = repeats.deduplicated(table(spark, sf_dir, "documents"), length=200)
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


def op5_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shards.sharded(table(spark, sf_dir, "documents"), shards=24)


def op6_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.scan(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


def op7_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.scanned(table(spark, sf_dir, "documents"))
    base = F.filter("parts", lambda p: p["kind"].isin(*secrets.BASE))
    count = lambda kind: F.size(F.filter("parts", lambda p: p["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return found.select(
        "doc_id", *map(count, secrets.BASE), F.sha2(secrets.joined_spans(base).cast("binary"), 256).alias("base_sha256"),
        secrets.joined_spans(F.col("parts")).alias("spans"))


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = quality.judged(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_folder(spark, "warc")
    warc.write_archive(table(spark, sf_dir, "pages"), path)
    return warc.captures(warc.read_archive(spark, path))


def op11_quality_network(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = bytecnn.scored(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return found.select("doc_id", "held_out", "score", "predicted")


def op12_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Proofs of all documents; where 5 divides the id's crc32, of a document whose text was lower-cased since."""
    return merkle.verified(table(spark, sf_dir, "documents"), claim=merkle.tampered_leaf())


def op13_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of each document, repetitions planted in a tenth of them first."""
    found = runs.found(runs.with_planted(table(spark, sf_dir, "documents")))
    best = F.array_max(F.transform("runs", lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("from"), (-r["period"]).alias("by"))))
    line = F.transform("runs", lambda r: F.concat(r["start"].cast("string"), F.lit(","), r["length"].cast("string"), F.lit(","), r["period"].cast("string"), F.lit("\n")))
    made = found.withColumn("best", best)
    return made.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), (-F.col("best.from")).alias("start"), F.col("best.length").alias("length"),
        (-F.col("best.by")).alias("period"), F.expr("1000 * best.length div -best.by").alias("exponent_milli"),
        F.sha2(F.array_join(line, "").cast("binary"), 256).alias("runs_sha256"), F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus_pipeline.run(spark, sf_dir)


QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (
        op1_mixing, op2_lines, op3_toxicity, op4_repeats, op5_shards, op6_decontaminate, op7_secrets, op8_quality, op9_simhash,
        op10_warc, op11_quality_network, op12_manifest, op13_runs, pipeline,
    )
}


def queries() -> dict[str, Query]:
    return dict(QUERIES)


def oracles() -> dict[str, str]:
    return {name: sql for name, sql in ORACLES.items() if sql is not None}
