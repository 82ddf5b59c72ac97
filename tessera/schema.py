"""Schemas of the cache and its side tables, and the row rules."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

# fixed values: the cache's columns in order
CACHE_DDL = (
    "sample_id string, source_id string, source_config string, source_split string, source_shard string, source_row_index bigint,"
    " speaker_id string, chapter_id string, source_audio_name string, source_sample_rate int, source_num_samples bigint,"
    " audio_seconds float, original_text string, normalized_text string, semantic_codes array<int>, semantic_length int"
)
_ARROW = {"string": pa.string(), "bigint": pa.int64(), "int": pa.int32(), "float": pa.float32(), "array<int>": pa.list_(pa.field("element", pa.uint16(), False))}
CACHE_ARROW = pa.schema([pa.field(n, _ARROW[t], False) for n, t in (c.split() for c in CACHE_DDL.split(","))])
SHARDS_DDL = (
    "split string, shard_index int, path string, status string, examples bigint, audio_seconds double, semantic_tokens bigint, sha256 string,"
    " source_shards array<string>, last_source_shard string, last_source_row_index bigint, completed_at_utc string"
)
SPLITS_DDL = "split string, status string, last_source_shard string, last_source_row_index bigint, completed_at_utc string"
FAILURES_DDL = (
    "timestamp_utc string, sample_id string, source_id string, source_config string, source_split string, source_shard string,"
    " source_row_index bigint, source_audio_name string, error_type string, error_message string"
)
METRICS_DDL = (
    "timestamp_utc string, split string, shard_index int, examples bigint, audio_seconds double, semantic_tokens bigint, errors bigint,"
    " elapsed_seconds double, audio_seconds_per_second double, realtime_factor double, progress_fraction double, eta_seconds double,"
    " prefetch_queue_depth int, cpu_percent double, ram_used_bytes bigint, ram_total_bytes bigint, disk_free_bytes bigint,"
    " gpu_utilization_percent double, gpu_memory_used_bytes bigint, gpu_memory_total_bytes bigint, gpu_temperature_c double, gpu_power_w double"
)
PUBLISHED_DDL = "schema_version string, repo_id string, path string, sha256 string, examples bigint, audio_seconds double, semantic_tokens bigint, published_at_utc string"


def violation(codebook: int = 2_048) -> Column:
    """The first rule that a cache row breaks, or null."""
    missing = [F.when(F.col(f.name).isNull(), F.lit(f"missing {f.name}")) for f in CACHE_ARROW]
    c = F.col
    return F.coalesce(
        *missing,
        F.when(c("sample_id") == "", F.lit("empty sample_id")),
        F.when((c("source_sample_rate") <= 0) | (c("source_num_samples") <= 0), F.lit("source audio dimensions not positive")),
        F.when(c("audio_seconds") <= 0, F.lit("audio_seconds not positive")),
        F.when((c("original_text") == "") | (c("normalized_text") == ""), F.lit("empty text")),
        F.when((F.size("semantic_codes") == 0) | (c("semantic_length") != F.size("semantic_codes")), F.lit("semantic_length differs")),
        F.when((F.array_min("semantic_codes") < 0) | (F.array_max("semantic_codes") >= codebook), F.lit("code out of range")),
    )
