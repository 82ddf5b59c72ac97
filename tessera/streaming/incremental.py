"""New source shards as a stream: each trigger takes a bounded number of files and appends batches exactly once.

Structured Streaming's checkpoint holds which files were read; the batch number makes a repeated trigger
after a crash recognisable, so its rows replace themselves instead of appearing twice.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from ..functions.text import normalized
from ..operators.folds import padded_batches


def new_rows(spark: SparkSession, root: str, schema: StructType, files_per_trigger: int = 4) -> DataFrame:
    """Rows of files as they appear under ``root``, with their source position."""
    return (
        spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).option("recursiveFileLookup", "true").parquet(root)
        .select("*", F.col("_metadata.file_name").alias("source_shard"), F.col("_metadata.row_index").alias("source_row_index"))
    )


def stream_batches(rows: DataFrame, out: str, checkpoint: str, budget: float, split: str = "train", version: str = "english_v1") -> StreamingQuery:
    """Normalise and batch each trigger's rows (source_shard, source_row_index, audio_seconds, text) into ``out``/trigger=n."""

    def write(batch: DataFrame, n: int) -> None:
        b = batch.withColumn("split", F.lit(split)).withColumn("normalized_text", normalized(F.col("text"), version)).where("normalized_text <> ''")
        b = padded_batches(b, "split", ["source_shard", "source_row_index"], "audio_seconds", budget)
        b.write.mode("overwrite").parquet(f"{out}/trigger={n}")

    return rows.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
