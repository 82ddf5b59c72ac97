"""Checks over a written cache, as one scan of three columns."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def validate_shards(manifest: DataFrame, rows: DataFrame, expect_checksum: bool = False) -> DataFrame:
    """Per manifest record the first problem, or null: duplicate path, missing file, checksum, row count, code lengths.

    rows: path, semantic_codes or n_codes, semantic_length, audio_seconds of what is stored; manifest may have
    actual_sha256 beside sha256 when checksums are wanted.
    """
    n = F.size("semantic_codes") if "semantic_codes" in rows.columns else F.col("n_codes")
    stored = rows.groupBy("path").agg(
        F.count(F.lit(1)).alias("stored"), F.bool_and(F.col("semantic_length") == n).alias("lengths_ok"),
        F.sum(F.col("audio_seconds").cast("double")).alias("stored_seconds"), F.sum(F.col("semantic_length").cast("bigint")).alias("stored_tokens"),
    )
    repeats = manifest.groupBy("path").agg(F.count(F.lit(1)).alias("times"))
    checks = [F.when(F.col("times") > 1, "duplicate path"), F.when(F.col("stored").isNull(), "missing file")]
    if expect_checksum:
        checks.append(F.when(~F.col("sha256").eqNullSafe(F.col("actual_sha256")), "checksum differs"))
    checks += [F.when(F.col("stored") != F.col("examples"), "row count differs"), F.when(~F.col("lengths_ok"), "code length differs")]
    return manifest.join(repeats, "path").join(stored, "path", "left").select("split", "shard_index", "path", F.coalesce(*checks).alias("problem"), "stored", "stored_seconds", "stored_tokens")


def validation_totals(checked: DataFrame) -> DataFrame:
    ok = checked.where("problem is null")
    return ok.agg(
        F.count(F.lit(1)).alias("shards"), F.coalesce(F.sum("stored"), F.lit(0)).cast("bigint").alias("examples"),
        F.coalesce(F.sum("stored_seconds"), F.lit(0.0)).alias("audio_seconds"), F.coalesce(F.sum("stored_tokens"), F.lit(0)).cast("bigint").alias("semantic_tokens"),
    )


def invariants(rows: DataFrame, codebook: int = 2_048, rate: float = 12.5, tolerance: float = 0.1) -> DataFrame:
    """Counts of rows that break what the format promises beyond a row's own rules."""
    repeated = rows.groupBy("sample_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1").agg(F.count(F.lit(1)).alias("repeated_sample_ids"))
    bad = lambda c, name: F.sum(c.cast("bigint")).alias(name)
    seconds = F.col("source_num_samples") / F.col("source_sample_rate")
    frames = F.abs(F.col("semantic_length") - F.col("audio_seconds") * rate)
    other = rows.agg(
        F.count(F.lit(1)).alias("rows"), bad(F.abs(seconds - F.col("audio_seconds")) > tolerance, "duration_off"),
        bad((F.array_max("semantic_codes") >= codebook) | (F.array_min("semantic_codes") < 0), "codes_out_of_range"), bad(frames > 1, "frames_off"),
    )
    return other.join(repeated)


def distribution(rows: DataFrame) -> DataFrame:
    """Per split: minimum, maximum and mean of seconds and code lengths."""
    return rows.groupBy("split").agg(
        F.count(F.lit(1)).alias("examples"),
        *[f(c).cast("double").alias(f"{n}_{c}") for c in ("audio_seconds", "semantic_length") for n, f in (("min", F.min), ("max", F.max), ("avg", F.avg))],
    )


def failures_by_type(failures: DataFrame) -> DataFrame:
    """Failed source rows per split and type of error, a row that is listed again counted once, and their share of the split's."""
    rows = failures.select("source_split", "source_shard", "source_row_index", "error_type").distinct()
    n = rows.groupBy("source_split", "error_type").agg(F.count(F.lit(1)).alias("failures"))
    every = n.groupBy(F.col("source_split").alias("of_split")).agg(F.sum("failures").alias("all_failures"))
    joined = n.join(every, F.col("source_split").eqNullSafe(F.col("of_split")))
    return joined.select("source_split", "error_type", "failures", (F.col("failures") / F.col("all_failures")).alias("share"))
