"""Queries over manifests: latest records, cursors, statistics, status, receipts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.values import clock, receipt_path, shard_path


def shard_manifest(rows: DataFrame, shard_col: str = "source_shard", row_col: str = "source_row_index", name: Column | None = None) -> DataFrame:
    """One record per (split, shard_index): counts, sums, source shards, last source position."""
    key = F.struct(F.col(shard_col), F.col(row_col))
    out = rows.groupBy("split", "shard_index").agg(
        F.count(F.lit(1)).alias("examples"),
        F.sum(F.col("audio_seconds").cast("double")).alias("audio_seconds"),
        F.sum(F.col("semantic_length").cast("bigint")).alias("semantic_tokens"),
        F.sort_array(F.collect_set(shard_col)).alias("source_shards"),
        F.max(key).alias("last"),
    )
    path = shard_path(F.col("split"), F.col("shard_index")) if name is None else name
    return out.select(
        "split", "shard_index", path.alias("path"), F.lit("complete").alias("status"), "examples", "audio_seconds", "semantic_tokens", "source_shards",
        F.col(f"last.{shard_col}").alias("last_source_shard"), F.col(f"last.{row_col}").alias("last_source_row_index"),
    )


def latest(manifest: DataFrame) -> DataFrame:
    """Completed records; of several for one (split, shard_index), the last line."""
    w = Window.partitionBy("split", "shard_index").orderBy(F.desc("line_no"))
    return manifest.where("status = 'complete'").withColumn("nth", F.row_number().over(w)).where("nth = 1").drop("nth")


def resume_state(manifest: DataFrame, splits: DataFrame) -> DataFrame:
    """Per split: next shard index, cursor (null when there is none), and restored totals."""
    cursor = F.struct("last_source_shard", "last_source_row_index")
    done = manifest.groupBy("split").agg(
        F.max("shard_index").alias("top"), F.max_by(cursor, "shard_index").alias("cursor"), F.sum("examples").alias("examples"),
        F.sum("audio_seconds").alias("audio_seconds"), F.sum("semantic_tokens").alias("semantic_tokens"),
    )
    return splits.join(done, "split", "left").select(
        "split", (F.coalesce("top", F.lit(-1)) + 1).cast("bigint").alias("next_shard_index"), "cursor.last_source_shard", "cursor.last_source_row_index",
        F.coalesce("examples", F.lit(0)).cast("bigint").alias("examples"), F.coalesce("audio_seconds", F.lit(0.0)).alias("audio_seconds"),
        F.coalesce("semantic_tokens", F.lit(0)).cast("bigint").alias("semantic_tokens"),
    )


def split_completion(rows: DataFrame, completed: DataFrame) -> DataFrame:
    """Splits not completed yet, with the last source position looked at, failures included."""
    last = rows.groupBy("split").agg(F.max(F.struct("source_shard", "source_row_index")).alias("last"), F.count(F.lit(1)).alias("rows_seen"))
    return last.join(completed.select("split"), "split", "left_anti").select("split", "last.source_shard", "last.source_row_index", "rows_seen")


def missing_splits(expected: DataFrame, completed: DataFrame) -> DataFrame:
    return expected.select("split").distinct().join(completed.where("status = 'complete'").select("split"), "split", "left_anti").orderBy("split")


def status_summary(manifest: DataFrame, expected: DataFrame) -> DataFrame:
    """Per split: shards, examples, hours, percent of the expected hours (at most 100), tokens, and the time as a clock."""
    done = manifest.groupBy("split").agg(
        F.count(F.lit(1)).alias("shards"), F.sum("examples").alias("examples"), F.sum("audio_seconds").alias("seconds"), F.sum("semantic_tokens").alias("semantic_tokens")
    )
    hours = F.col("seconds") / 3600
    return done.join(expected, "split", "left").select(
        "split", "shards", "examples", hours.alias("hours"), (F.least(hours / F.col("expected_hours"), F.lit(1.0)) * 100).alias("percent"),
        "semantic_tokens", clock(F.col("seconds")).alias("clock"),
    ).orderBy("split")


def totals(manifest: DataFrame) -> DataFrame:
    z = lambda c, kind: F.coalesce(F.sum(c), F.lit(0)).cast(kind).alias(c)
    return manifest.agg(F.count(F.lit(1)).alias("shards"), z("examples", "bigint"), z("audio_seconds", "double"), z("semantic_tokens", "bigint"))


def processing_stats(manifest: DataFrame, failures: DataFrame) -> DataFrame:
    """One row: totals and the number of distinct failed source rows."""
    n = failures.select("source_shard", "source_row_index").distinct().agg(F.count(F.lit(1)).alias("failures"))
    return totals(manifest).join(n)


def receipt_diff(manifest: DataFrame, receipts: DataFrame) -> DataFrame:
    """upload (no receipt), skip (same checksum) or conflict, per completed shard."""
    r = receipts.select("receipt", F.col("sha256").alias("receipt_sha"))
    action = F.when(F.col("receipt_sha").isNull(), "upload").when(F.col("receipt_sha") == F.col("sha256"), "skip").otherwise("conflict")
    return manifest.withColumn("receipt", receipt_path(F.col("path"))).join(r, "receipt", "left").select("split", "shard_index", "path", "receipt", action.alias("action"))


def progress(batches: DataFrame, expected_seconds: dict[str, float], elapsed: Column) -> DataFrame:
    """Running totals of each split's batches with speed, fraction and remaining time; elapsed is given as data."""
    w = Window.partitionBy("split").orderBy("batch_id").rowsBetween(Window.unboundedPreceding, 0)
    b = batches.select("split", "batch_id", *[F.sum(c).over(w).alias(c) for c in ("examples", "audio_seconds", "semantic_tokens")], elapsed.alias("elapsed_seconds"))
    total = F.coalesce(*[F.when(F.col("split") == k, F.lit(float(v))) for k, v in expected_seconds.items()], F.lit(None).cast("double"))
    speed = F.col("audio_seconds") / F.nullif(F.col("elapsed_seconds"), F.lit(0.0))
    t = F.nullif(total, F.lit(0.0))
    live = F.when(speed > 0, speed)
    return b.select(
        "*", speed.alias("audio_seconds_per_second"), (1 / live).alias("realtime_factor"), F.when(t.isNotNull(), F.least(F.col("audio_seconds") / t, F.lit(1.0))).alias("progress_fraction"),
        F.when(t.isNotNull(), F.greatest(t - F.col("audio_seconds"), F.lit(0.0)) / live).alias("eta_seconds"),
    )


def last_line(metrics: DataFrame, order: str) -> DataFrame:
    return metrics.orderBy(F.desc(order)).limit(1)
