"""A stand-in for spoken examples over the documents table, in Spark and, mirrored, in SQL.

There is no audio among the tables, so lengths stand for samples: 16 characters are a second. All
durations are multiples of 1/16, hence exact in float and in any order of summation.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.values import duration, frame_count, sample_id
from ..operators.encode import proxy_codes
from ..sources.listing import numbered

BUDGET, TARGET = 600.0, 3600.0
EXPECTED_HOURS = {"train": 30.0, "validation": 5.0, "test": 4.0}


def proxy(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "source", "n_chars")
    kind = F.col("doc_id") % 10
    config = F.when(kind == 0, "dev").when(kind == 1, "test").otherwise("medium")
    split = F.when(kind == 0, "dev").when(kind == 1, "test").otherwise("train")
    target = F.when(kind == 0, "validation").when(kind == 1, "test").otherwise("train")
    p = docs.select(
        "doc_id", target.alias("split"), config.alias("source_config"), split.alias("source_split"),
        F.format_string("%s/%s-%05d.parquet", config, split, F.expr("doc_id div 100")).alias("source_shard"),
        F.col("doc_id").cast("string").alias("source_id"), F.col("source").alias("speaker_id"), F.lit("").alias("chapter_id"),
        F.concat(F.col("doc_id").cast("string"), F.lit(".flac")).alias("source_audio_name"), F.lit(16_000).alias("source_sample_rate"),
        (F.col("n_chars") * 1000).alias("source_num_samples"), (F.col("n_chars") * 1500).alias("model_num_samples"), F.col("text").alias("original_text"),
    )
    p = numbered(p, "source_shard", "doc_id")
    return p.withColumn("sample_id", sample_id(F.col("source_config"), F.col("source_split"), F.col("source_shard"), F.col("source_row_index"))).withColumn(
        "audio_seconds", duration(F.col("source_num_samples"), F.col("source_sample_rate"))
    ).withColumn("semantic_length", frame_count(F.col("model_num_samples")))


def with_codes(p: DataFrame) -> DataFrame:
    return p.withColumn("semantic_codes", proxy_codes(F.col("doc_id"), F.col("semantic_length")))


PROXY_SQL = """
d as (select doc_id, text, source, n_chars,
        case doc_id % 10 when 0 then 'validation' when 1 then 'test' else 'train' end as split,
        case doc_id % 10 when 0 then 'dev' when 1 then 'test' else 'medium' end as source_config,
        case doc_id % 10 when 0 then 'dev' when 1 then 'test' else 'train' end as source_split from documents),
e as (select *, printf('%s/%s-%05d.parquet', source_config, source_split, doc_id // 100) as source_shard from d),
n as (select *, row_number() over (partition by source_shard order by doc_id) - 1 as source_row_index from e),
p as (select doc_id, split, source_config, source_split, source_shard, source_row_index, doc_id::varchar as source_id, source as speaker_id,
        '' as chapter_id, doc_id::varchar || '.flac' as source_audio_name, 16000 as source_sample_rate, n_chars * 1000 as source_num_samples,
        n_chars * 1500 as model_num_samples, text as original_text, n_chars / 16.0::double as audio_seconds,
        ((n_chars * 1500 + 1919) // 1920)::int as semantic_length,
        substr(sha256(source_config || ':' || source_split || ':' || source_shard || ':' || source_row_index::varchar), 1, 32) as sample_id from n)
"""

BATCHES_SQL = f"""
o as (select *, row_number() over (partition by split order by source_shard, source_row_index) as k from p),
walk as (
  select split, k, 0::bigint as batch_id, 1::bigint as n, audio_seconds as longest from o where k = 1
  union all
  select o.split, o.k, w.batch_id + (case when f.cut then 1 else 0 end),
         case when f.cut then 1 else w.n + 1 end, case when f.cut then o.audio_seconds else greatest(w.longest, o.audio_seconds) end
  from walk w join o on o.split = w.split and o.k = w.k + 1,
       lateral (select w.longest * w.n >= {BUDGET} or greatest(w.longest, o.audio_seconds) * (w.n + 1) > {BUDGET} as cut) f),
b as (select o.*, walk.batch_id from o join walk using (split, k))
"""

SHARDS_SQL = f"""
t as (select split, batch_id, sum(audio_seconds) as s from b group by all),
walk2 as (
  select split, batch_id, 0::bigint as shard_index, s as total from t where batch_id = 0
  union all
  select t.split, t.batch_id, case when w.total >= {TARGET} then w.shard_index + 1 else w.shard_index end,
         case when w.total >= {TARGET} then t.s else w.total + t.s end
  from walk2 w join t on t.split = w.split and t.batch_id = w.batch_id + 1),
sh as (select b.*, walk2.shard_index from b join walk2 using (split, batch_id))
"""

MANIFEST_SQL = """
m as (select split, shard_index::int as shard_index, printf('%s/%s-%05d.parquet', split, split, shard_index) as path, 'complete' as status,
        count(*)::bigint as examples, sum(audio_seconds)::double as audio_seconds, sum(semantic_length)::bigint as semantic_tokens,
        list_sort(list(distinct source_shard)) as source_shards, arg_max(source_shard, (source_shard, source_row_index)) as last_source_shard,
        arg_max(source_row_index, (source_shard, source_row_index))::bigint as last_source_row_index
      from q group by split, shard_index)
"""
# shards without the folds, for queries that are about manifests
PLAIN_SHARDS_SQL = "q as (select *, (doc_id // 200)::int as shard_index from p)"
