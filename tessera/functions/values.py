"""Scalar columns: identifiers, durations, frames, paths and formats."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SAMPLE_RATE, FRAME_RATE, CODEBOOK = 24_000, 12.5, 2_048


def frame_size(sample_rate: int = SAMPLE_RATE, frame_rate: float = FRAME_RATE) -> int:
    return round(sample_rate / frame_rate)


def sample_id(config: Column, split: Column, shard: Column, row: Column) -> Column:
    """The first 32 hex digits of the SHA-256 of config:split:shard:row (of the source)."""
    return F.substring(F.sha2(F.concat_ws(":", config, split, shard, row.cast("string")), 256), 1, 32)


def duration(num_samples: Column, rate: Column) -> Column:
    """Seconds in double; a writer narrows them to float."""
    return num_samples.cast("double") / rate.cast("double")


def frame_count(model_samples: Column, size: int | None = None) -> Column:
    return F.ceil(model_samples / F.lit(size or frame_size())).cast("int")


def trimmed(codes: Column, frames: Column) -> Column:
    return F.slice(codes, 1, frames)


def codebook(codebooks: Column, k: int) -> Column:
    """Codebook k (from 0) of an array of code lists; raises where there is none."""
    return F.when(F.size(codebooks) > k, F.get(codebooks, F.lit(k))).otherwise(F.raise_error(F.lit(f"codebook {k} is out of range")))


def mono(left: Column, right: Column) -> Column:
    """Mean of two channels of equal length."""
    return F.zip_with(left, right, lambda a, b: (a + b) / 2)


def first_truthy(*cols: Column, default: Column) -> Column:
    """The first value that is neither null, empty, zero nor false, as text."""
    values = []
    for c in cols:
        text = c.cast("string")
        values.append(F.when(text.isin("", "0", "0.0", "-0.0", "false") & ~F.typeof(c).isin("string") | (text == ""), None).otherwise(text))
    return F.coalesce(*values, default.cast("string"))


def base_name(path: Column) -> Column:
    """The last part of a POSIX path; slashes at the end don't count."""
    return F.substring_index(F.rtrim(path, F.lit("/")), "/", -1)


def shard_path(split: Column, index: Column) -> Column:
    return F.format_string("%s/%s-%05d.parquet", split, split, index)


def receipt_path(path: Column) -> Column:
    return F.concat(F.lit("_receipts/"), F.replace(path, F.lit("/"), F.lit("--")), F.lit(".json"))


def clock(seconds: Column) -> Column:
    """HH:MM:SS, truncated, not below zero, hours not wrapped; n/a for null."""
    s = F.greatest(seconds, F.lit(0)).cast("long")
    text = F.format_string("%02d:%02d:%02d", F.floor(s / 3600), F.floor(s % 3600 / 60), s % 60)
    return F.when(seconds.isNull(), F.lit("n/a")).otherwise(text)


def gib(n_bytes: Column) -> Column:
    return F.when(n_bytes.isNull(), F.lit("n/a")).otherwise(F.format_string("%.1fGiB", n_bytes / F.lit(float(1 << 30))))
