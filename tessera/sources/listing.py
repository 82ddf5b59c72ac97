"""Listing, scanning and projecting source shards."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.values import base_name, first_truthy


def shard_listing(files: DataFrame, config: str, split: str, path_col: str = "path") -> DataFrame:
    """Paths of a split, in order: ``config/`` first, ``.parquet`` last, ``split-`` in the file name."""
    p = F.col(path_col)
    return files.where(p.startswith(f"{config}/") & p.endswith(".parquet") & F.substring_index(p, "/", -1).startswith(f"{split}-")).orderBy(p)


def list_files(spark: SparkSession, root: str) -> DataFrame:
    """Relative paths under ``root``, on any file system that Spark reads."""
    found = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root).select("path")
    base = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(root)
    full = base.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).makeQualified(base).toString().rstrip("/") + "/"
    # a file system prints its scheme with one or three slashes
    rel = F.substring(F.col("path"), F.instr("path", full.split(":", 1)[-1].replace("//", "/").rstrip("/") + "/"), F.length("path"))
    return found.select(F.substring(rel, len(full.split(":", 1)[-1].replace("//", "/")) + 1, F.length("path")).alias("path"))


def cursor_predicate(shard: Column, row: Column, cursor: tuple[str, int] | None) -> Column:
    """Rows after the cursor. The conjunctive form lets Spark prune files by their path."""
    if cursor is None:
        return F.lit(True)
    s, r = cursor
    return (shard >= s) & ((shard > s) | (row > r))


def scan_shards(spark: SparkSession, root: str, paths: list[str], cursor: tuple[str, int] | None = None) -> DataFrame:
    """Rows of the listed shards with source_shard (relative to root) and source_row_index."""
    if not paths:
        raise FileNotFoundError(f"no source shards under {root}")
    at = {f"{root.rstrip('/')}/{p}": p for p in paths if cursor is None or p >= cursor[0]}
    if not at:
        at = {f"{root.rstrip('/')}/{paths[-1]}": paths[-1]}
    df = spark.read.option("mergeSchema", "true").parquet(*sorted(at))
    depth = paths[0].count("/") + 1
    shard = F.substring_index(F.col("_metadata.file_path"), "/", -depth)
    rows = df.select("*", shard.alias("source_shard"), F.col("_metadata.row_index").alias("source_row_index"))
    return rows.where(cursor_predicate(F.col("source_shard"), F.col("source_row_index"), cursor))


def numbered(rows: DataFrame, shard: str, key: str, out: str = "source_row_index") -> DataFrame:
    """Row numbers from 0 within each shard, for tables without file positions."""
    return rows.withColumn(out, F.row_number().over(Window.partitionBy(shard).orderBy(key)).cast("bigint") - 1)


def project_source(rows: DataFrame) -> DataFrame:
    """The source fields by their alternative names; unknown optional ids are empty."""
    have = set(rows.columns)
    pick = lambda names, default: first_truthy(*[F.col(n) for n in names if n in have], default=default)
    empty = F.lit("")
    ident = pick(("ID", "id"), F.concat_ws(":", "source_shard", F.col("source_row_index").cast("string")))
    audio = next((F.col(n) for n in ("wav", "audio") if n in have), None)
    paths = ([audio.getField("path")] if audio is not None and "path" in rows.schema[str("wav" if "wav" in have else "audio")].dataType.names else []) + [F.col(n) for n in ("file",) if n in have]
    return rows.select(
        "*",
        ident.alias("source_id"),
        pick(("spk_id", "speaker_id"), empty).alias("speaker"),
        pick(("chapter_id",), empty).alias("chapter"),
        base_name(first_truthy(*paths, default=ident)).alias("source_audio_name"),
        pick(("text", "transcript"), empty).alias("original_text"),
    )
