"""The registered queries: each operator over the driver's tables, with DuckDB SQL of the same result."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as text_fn
from ..functions import values as v
from ..operators import checks, encode, folds, manifest
from ..schema import violation
from ..sources import listing
from ..sources.jsonl import parse_lines
from .proxy import BATCHES_SQL, BUDGET, EXPECTED_HOURS, MANIFEST_SQL, PLAIN_SHARDS_SQL, PROXY_SQL, SHARDS_SQL, TARGET, proxy, with_codes

ORDER = ["source_shard", "source_row_index"]
QUERIES: dict = {}
ORACLE_SQL: dict[str, str] = {}


def _query(sql: str):
    """Registers a query under its function's name, with its SQL."""

    def add(f):
        QUERIES[f.__name__] = f
        ORACLE_SQL[f.__name__] = sql
        return f

    return add


def _with(*parts: str, recursive: bool = False) -> str:
    return ("with recursive " if recursive else "with ") + ",\n".join(x.strip() for x in parts) + "\n"


def _plain_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return proxy(spark, sf_dir).withColumn("shard_index", F.expr("cast(doc_id div 200 as int)"))


def _manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return manifest.shard_manifest(_plain_shards(spark, sf_dir))


_M = _with(PROXY_SQL, PLAIN_SHARDS_SQL, MANIFEST_SQL)
_P = _with(PROXY_SQL)


@_query(_P + """, f as (select distinct source_shard as path from p union all select unnest(['x/train-00000.parquet', 'medium/train-00000.json',
  'medium/dev-00000.parquet', 'medium/deep/train-00009.parquet', 'medium/trainer.parquet']))
select path from f where starts_with(path, 'medium/') and ends_with(path, '.parquet') and starts_with(list_last(string_split(path, '/')), 'train-')""")
def shard_listing(spark, sf_dir):
    """Names of the train shards, in order, among others."""
    decoys = ["x/train-00000.parquet", "medium/train-00000.json", "medium/dev-00000.parquet", "medium/deep/train-00009.parquet", "medium/trainer.parquet"]
    files = proxy(spark, sf_dir).select(F.col("source_shard").alias("path")).distinct().unionAll(spark.createDataFrame([(d,) for d in decoys], "path string"))
    return listing.shard_listing(files, "medium", "train")


@_query(_P + "select source_shard, source_row_index::bigint as source_row_index, source_id, original_text from p")
def scan_rows(spark, sf_dir):
    """Numbered rows of every shard."""
    return proxy(spark, sf_dir).select("source_shard", "source_row_index", "source_id", "original_text")


@_query("""
select page_id, case when page_id % 3 = 0 then printf('pages/all-%05d.parquet:%d', page_id // 50, page_id % 50) when page_id % 3 = 1 then 'p' || page_id else (page_id * 7)::varchar end as source_id,
       case when page_id % 5 = 0 then '' when page_id % 5 = 1 then 's' || page_id % 9 else 'host' end as speaker, '' as chapter,
       regexp_extract(rtrim(url, '/'), '[^/]*$') as source_audio_name, html as original_text from pages""")
def source_projection(spark, sf_dir):
    """Alternative column names, empty values and base names."""
    p = spark.read.parquet(f"{sf_dir}/pages.parquet")
    k = F.col("page_id")
    rows = p.select(
        "page_id", F.when(k % 3 == 1, F.concat(F.lit("p"), k.cast("string"))).otherwise("").alias("ID"), F.when(k % 3 == 2, k * 7).otherwise(F.lit(0)).alias("id_"),
        F.when(k % 5 == 1, F.concat(F.lit("s"), (k % 9).cast("string"))).alias("spk_id"), F.when(k % 5 > 1, "host").otherwise("").alias("speaker_id"),
        F.col("url").alias("file"), F.col("html").alias("transcript"), F.format_string("pages/all-%05d.parquet", F.expr("page_id div 50")).alias("source_shard"),
        (k % 50).alias("source_row_index"),
    )
    ident = v.first_truthy(F.col("ID"), F.col("id_"), default=F.concat_ws(":", "source_shard", F.col("source_row_index").cast("string")))
    rows = listing.project_source(rows.withColumn("ID", ident).drop("id_"))
    return rows.select("page_id", "source_id", "speaker", "chapter", "source_audio_name", "original_text")


@_query(_P + """select doc_id, source_shard, source_row_index::bigint as source_row_index from p where source_config = 'medium'
  and (source_shard > 'medium/train-00003.parquet' or (source_shard = 'medium/train-00003.parquet' and source_row_index > 40))""")
def resume_scan(spark, sf_dir):
    """Train rows after a cursor."""
    after = listing.cursor_predicate(F.col("source_shard"), F.col("source_row_index"), ("medium/train-00003.parquet", 40))
    return proxy(spark, sf_dir).where("source_config = 'medium'").where(after).select("doc_id", "source_shard", "source_row_index")


_LINES_SQL = _M + """, l as (
  select 3 * shard_index + 1 as line_no, split, shard_index, status, examples, audio_seconds from m
  union all select 3 * shard_index, split, shard_index, status, examples - 1, audio_seconds from m where shard_index % 2 = 0
  union all select 3 * shard_index + 2, split, shard_index, 'partial', examples + 5, audio_seconds from m where shard_index % 3 = 0)
"""


def _lines(spark, sf_dir):
    m = _manifest(spark, sf_dir).select("split", "shard_index", "status", "examples", "audio_seconds")
    k = F.col("shard_index").cast("bigint") * 3
    out = m.withColumn("line_no", k + 1)
    out = out.unionByName(m.where("shard_index % 2 = 0").withColumn("line_no", k).withColumn("examples", F.col("examples") - 1))
    return out.unionByName(m.where("shard_index % 3 = 0").withColumn("line_no", k + 2).withColumn("examples", F.col("examples") + 5).withColumn("status", F.lit("partial")))


@_query(_LINES_SQL + "select line_no::bigint as line_no, split, shard_index, status, examples, audio_seconds from l")
def manifest_scan(spark, sf_dir):
    """Manifest lines as JSON, parsed again; blank lines are skipped."""
    text = _lines(spark, sf_dir).select("line_no", F.to_json(F.struct("split", "shard_index", "status", "examples", "audio_seconds")).alias("line"))
    text = text.unionAll(spark.createDataFrame([(-1, ""), (-2, "   ")], "line_no bigint, line string"))
    return parse_lines(text, "split string, shard_index int, status string, examples bigint, audio_seconds double")


@_query(_LINES_SQL + """select split, shard_index, examples, audio_seconds from (select *, row_number() over (partition by split, shard_index order by line_no desc) as k
  from l where status = 'complete') where k = 1""")
def manifest_latest(spark, sf_dir):
    """The last completed record of each shard."""
    return manifest.latest(_lines(spark, sf_dir)).select("split", "shard_index", "examples", "audio_seconds")


@_query(_P + "select doc_id, source_shard, source_row_index::bigint as source_row_index from p where split = 'train' order by source_shard, source_row_index limit 6")
def head_n(spark, sf_dir):
    """The first six train rows in source order."""
    return proxy(spark, sf_dir).where("split = 'train'").orderBy(*ORDER).limit(6).select("doc_id", *ORDER)


@_query(_with(PROXY_SQL, """h as (select *, row_number() over (order by source_shard, source_row_index) - 1 as pos from p where split = 'train' order by pos limit 6),
c as (select rep * 6 + pos as k, doc_id, audio_seconds as s from h, range(100) r(rep)),
w as (select k, doc_id, 1::bigint as n, s as longest, s >= 4000 as done from c where k = 0
  union all select c.k, c.doc_id, w.n + 1, greatest(w.longest, c.s), greatest(w.longest, c.s) * (w.n + 1) >= 4000
  from w join c on c.k = w.k + 1 where not w.done and greatest(w.longest, c.s) * (w.n + 1) <= 4000)""", recursive=True) + "select k::int as position, doc_id from w")
def fill_budget(spark, sf_dir):
    """The first padded batch of the six first rows, repeated in a cycle, within 4,000 seconds."""
    head = proxy(spark, sf_dir).where("split = 'train'").orderBy(*ORDER).limit(6).select("doc_id", "audio_seconds", *ORDER).orderBy(*ORDER).collect()
    picked = folds.fill_budget([r["audio_seconds"] for r in head], 4000.0)
    return spark.createDataFrame([(k, head[i]["doc_id"]) for k, i in enumerate(picked)], "position int, doc_id bigint")


@_query(r"""select 'document' as kind, doc_id as id, 0::bigint as turn, trim(regexp_replace(lower(text), '\s+', ' ', 'g')) as normalized_text from documents
union all select 'conversation', conv_id, turn, trim(regexp_replace(lower(text), '\s+', ' ', 'g')) from conversations""")
def normalize_text(spark, sf_dir):
    """Normalised texts of documents and conversations."""
    d = spark.read.parquet(f"{sf_dir}/documents.parquet").select(F.lit("document").alias("kind"), F.col("doc_id").alias("id"), F.lit(0).cast("bigint").alias("turn"), "text")
    c = spark.read.parquet(f"{sf_dir}/conversations.parquet").select(F.lit("conversation").alias("kind"), F.col("conv_id").alias("id"), "turn", "text")
    return d.unionAll(c).select("kind", "id", "turn", text_fn.normalized(F.col("text")).alias("normalized_text"))


@_query(_P + "select doc_id, sample_id from p")
def sample_id(spark, sf_dir):
    return proxy(spark, sf_dir).select("doc_id", "sample_id")


@_query(_P + "select doc_id, audio_seconds::float as audio_seconds, (source_num_samples / 44100.0::double)::float as seconds_44k from p")
def audio_durations(spark, sf_dir):
    """Durations in double, narrowed to float."""
    n = F.col("source_num_samples")
    return proxy(spark, sf_dir).select("doc_id", v.duration(n, F.col("source_sample_rate")).cast("float").alias("audio_seconds"), v.duration(n, F.lit(44_100)).cast("float").alias("seconds_44k"))


@_query(_P + "select doc_id, semantic_length as frames, ((model_num_samples + 1763) // 1764)::int as frames_1764 from p")
def frame_counts(spark, sf_dir):
    return proxy(spark, sf_dir).select("doc_id", F.col("semantic_length").alias("frames"), v.frame_count(F.col("model_num_samples"), 1764).alias("frames_1764"))


_CODES_SQL = "list_transform(embedding, lambda x: floor((x::double + 1) * 1024)::int)"


@_query(f"select vec_id, {_CODES_SQL}[1:(vec_id % 64 + 1)::int] as codes from embeddings")
def trim_codes(spark, sf_dir):
    """Codes of the first codebook, cut to the valid frames."""
    e = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    codes = F.transform("embedding", lambda x: F.floor((x.cast("double") + 1) * 1024).cast("int"))
    books = F.array(codes, F.reverse(codes))
    return e.select("vec_id", v.trimmed(v.codebook(books, 0), (F.col("vec_id") % 64 + 1).cast("int")).alias("codes"))


@_query(f"""select vec_id, list_transform(range(1, 33), lambda i: (({_CODES_SQL})[i] + ({_CODES_SQL})[i + 32]) / 2.0::double) as mono from embeddings""")
def mixdown(spark, sf_dir):
    """The mean of two channels."""
    codes = F.transform("embedding", lambda x: F.floor((x.cast("double") + 1) * 1024).cast("double"))
    e = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", codes.alias("c"))
    return e.select("vec_id", v.mono(F.slice("c", 1, 32), F.slice("c", 33, 32)).alias("mono"))


@_query(_P + """select doc_id, case
  when doc_id % 19 = 0 then 'missing speaker_id' when doc_id % 7 = 0 then 'empty sample_id' when doc_id % 11 = 0 then 'source audio dimensions not positive'
  when doc_id % 13 = 0 then 'audio_seconds not positive' when doc_id % 17 = 0 then 'empty text' when doc_id % 23 = 0 then 'semantic_length differs'
  when doc_id % 5 = 0 then 'code out of range' end as violation from p""")
def validate_rows(spark, sf_dir):
    """The first broken rule of each row."""
    k, c = F.col("doc_id"), F.col
    rows = with_codes(proxy(spark, sf_dir)).withColumn("normalized_text", F.when(k % 17 == 0, "").otherwise(F.lower("original_text")))
    rows = rows.withColumns({
        "sample_id": F.when(k % 7 == 0, "").otherwise(c("sample_id")), "source_sample_rate": F.when(k % 11 == 0, 0).otherwise(c("source_sample_rate")),
        "audio_seconds": F.when(k % 13 == 0, 0.0).otherwise(c("audio_seconds")), "semantic_length": F.when(k % 23 == 0, 0).otherwise(c("semantic_length")),
        "semantic_codes": F.when(k % 5 == 0, F.concat(F.slice("semantic_codes", 2, 1 << 30), F.array(F.lit(2048)))).otherwise(c("semantic_codes")),
        "speaker_id": F.when(k % 19 == 0, None).otherwise(c("speaker_id")),
    })
    return rows.select("doc_id", violation().alias("violation"))


@_query(_P + """select sample_id, source_shard, source_row_index::bigint as source_row_index, case when doc_id % 50 = 0 then 'no audio payload' else 'normalized text is empty' end as error_message
from p left join (select doc_id, max(toxic) as toxic from labels group by doc_id) using (doc_id) where doc_id % 50 = 0 or toxic = 1 or doc_id % 97 = 0""")
def failure_rows(spark, sf_dir):
    """Rejected rows; a failure of the audio comes before one of the text."""
    toxic = spark.read.parquet(f"{sf_dir}/labels.parquet").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    p = proxy(spark, sf_dir).join(toxic, "doc_id", "left")
    text = F.when((F.coalesce("toxic", F.lit(0)) == 1) | (F.col("doc_id") % 97 == 0), "").otherwise(F.col("original_text"))
    message = F.when(F.col("doc_id") % 50 == 0, "no audio payload").when(text_fn.normalized(text) == "", "normalized text is empty")
    return p.select("sample_id", *ORDER, message.alias("error_message")).where("error_message is not null")


def _batched(spark, sf_dir):
    return folds.padded_batches(proxy(spark, sf_dir), "split", ORDER, "audio_seconds", BUDGET)


@_query(_with(PROXY_SQL, BATCHES_SQL, recursive=True) + "select split, batch_id, count(*)::bigint as examples, max(audio_seconds) as longest, min(doc_id) as first_doc, max(doc_id) as last_doc from b group by all")
def padded_batches(spark, sf_dir):
    """Batches whose padded duration stays within the budget."""
    return _batched(spark, sf_dir).groupBy("split", "batch_id").agg(
        F.count(F.lit(1)).alias("examples"), F.max("audio_seconds").alias("longest"), F.min("doc_id").alias("first_doc"), F.max("doc_id").alias("last_doc")
    )


@_query(_with(PROXY_SQL, BATCHES_SQL, SHARDS_SQL, recursive=True) + "select doc_id, split, batch_id, shard_index from sh")
def duration_shards(spark, sf_dir):
    """Batches packed into shards of a target duration."""
    return folds.duration_shards(_batched(spark, sf_dir), "split", ORDER, "audio_seconds", TARGET).select("doc_id", "split", "batch_id", "shard_index")


@_query(_with(PROXY_SQL, BATCHES_SQL, SHARDS_SQL, "q as (select * from sh)", MANIFEST_SQL, recursive=True) + "select * from m")
def shard_manifest(spark, sf_dir):
    """Normalised, batched, sharded and summed up: the records of all shards."""
    rows = folds.duration_shards(_batched(spark, sf_dir), "split", ORDER, "audio_seconds", TARGET)
    return manifest.shard_manifest(rows.withColumn("shard_index", F.col("shard_index").cast("int")))


@_query(_M + """, s as (select unnest(['train', 'validation', 'test', 'extra']) as split),
g as (select split, max(shard_index) as top, arg_max(last_source_shard, shard_index) as a, arg_max(last_source_row_index, shard_index) as r, sum(examples)::bigint as e, sum(audio_seconds) as x, sum(semantic_tokens)::bigint as t from m group by split)
select split, (coalesce(top, -1) + 1)::bigint as next_shard_index, a as last_source_shard, r as last_source_row_index, coalesce(e, 0)::bigint as examples, coalesce(x, 0.0)::double as audio_seconds, coalesce(t, 0)::bigint as semantic_tokens
from s left join g using (split)""")
def resume_cursor(spark, sf_dir):
    splits = spark.createDataFrame([(s,) for s in ("train", "validation", "test", "extra")], "split string")
    return manifest.resume_state(_manifest(spark, sf_dir), splits)


@_query(_P + "select split, arg_max(source_shard, (source_shard, source_row_index)) as source_shard, arg_max(source_row_index, (source_shard, source_row_index))::bigint as source_row_index, count(*)::bigint as rows_seen from p where split <> 'validation' group by split")
def split_completion(spark, sf_dir):
    """Where each split that isn't complete stands."""
    return manifest.split_completion(proxy(spark, sf_dir), spark.createDataFrame([("validation",)], "split string"))


@_query(_P + ", x as (select distinct split from p union select 'extra') select split from x where split not in ('test')")
def missing_splits(spark, sf_dir):
    expected = proxy(spark, sf_dir).select("split").unionAll(spark.createDataFrame([("extra",)], "split string"))
    done = spark.createDataFrame([("test", "complete"), ("train", "partial")], "split string, status string")
    return manifest.missing_splits(expected, done)


_HOURS = ", ".join(f"('{k}', {h})" for k, h in EXPECTED_HOURS.items() if k != "test")


@_query(_M + f""", g as (select split, count(*)::bigint as shards, sum(examples)::bigint as examples, sum(audio_seconds) as s, sum(semantic_tokens)::bigint as semantic_tokens from m group by split)
select split, shards, examples, s / 3600 as hours, least(s / 3600 / h, 1.0)::double * 100 as percent, semantic_tokens,
  printf('%02d:%02d:%02d', floor(s)::bigint // 3600, floor(s)::bigint % 3600 // 60, floor(s)::bigint % 60) as clock
from g left join (select * from (values {_HOURS}) t(split, h)) using (split)""")
def status_summary(spark, sf_dir):
    """Progress by split; a split without expected hours has no percentage."""
    expected = spark.createDataFrame([(k, h) for k, h in EXPECTED_HOURS.items() if k != "test"], "split string, expected_hours double")
    return manifest.status_summary(_manifest(spark, sf_dir), F.broadcast(expected))


_FAULTS_SQL = _M + """, mm as (select split, shard_index, case when shard_index % 5 = 4 then split || '/dup.parquet' else path end as path, examples + (case when shard_index % 4 = 3 then 1 else 0 end) as examples from m),
st as (select case when shard_index % 5 = 4 then split || '/dup.parquet' else printf('%s/%s-%05d.parquet', split, split, shard_index) end as path,
  semantic_length + (case when doc_id % 389 = 0 then 1 else 0 end) as semantic_length, semantic_length as n, audio_seconds::float as audio_seconds from q where shard_index % 7 <> 2),
r as (select path, count(*) as times from mm group by path),
s as (select path, count(*)::bigint as stored, bool_and(semantic_length = n) as ok, sum(audio_seconds::double) as stored_seconds, sum(semantic_length)::bigint as stored_tokens from st group by path),
c as (select split, shard_index, path, case when times > 1 then 'duplicate path' when stored is null then 'missing file' when stored <> examples then 'row count differs' when not ok then 'code length differs' end as problem,
  stored, stored_seconds, stored_tokens from mm join r using (path) left join s using (path))
"""


def _checked(spark, sf_dir):
    odd = F.col("shard_index") % 5 == 4
    dup = lambda path: F.when(odd, F.concat(F.col("split"), F.lit("/dup.parquet"))).otherwise(path)
    m = _manifest(spark, sf_dir).withColumn("path", dup(F.col("path"))).withColumn("examples", F.col("examples") + F.when(F.col("shard_index") % 4 == 3, 1).otherwise(0))
    rows = _plain_shards(spark, sf_dir).where("shard_index % 7 <> 2")
    stored = rows.select(
        dup(v.shard_path(F.col("split"), F.col("shard_index"))).alias("path"), F.col("semantic_length").alias("n_codes"),
        (F.col("semantic_length") + F.when(F.col("doc_id") % 389 == 0, 1).otherwise(0)).alias("semantic_length"), F.col("audio_seconds").cast("float").alias("audio_seconds"),
    )
    return checks.validate_shards(m, stored)


@_query(_FAULTS_SQL + "select * from c")
def validate_shards(spark, sf_dir):
    """The first problem of each shard."""
    return _checked(spark, sf_dir)


@_query(_FAULTS_SQL + "select count(*)::bigint as shards, coalesce(sum(stored), 0)::bigint as examples, coalesce(sum(stored_seconds), 0.0)::double as audio_seconds, coalesce(sum(stored_tokens), 0)::bigint as semantic_tokens from c where problem is null")
def validate_totals(spark, sf_dir):
    return checks.validation_totals(_checked(spark, sf_dir))


@_query(_M + """select count(*)::bigint as shards, sum(examples)::bigint as examples, sum(audio_seconds)::double as audio_seconds, sum(semantic_tokens)::bigint as semantic_tokens,
  (select count(*)::bigint from p where doc_id % 97 = 0) as failures from m""")
def processing_stats(spark, sf_dir):
    """Totals and failures, each failed row counted once."""
    failed = proxy(spark, sf_dir).where("doc_id % 97 = 0").select(*ORDER)
    return manifest.processing_stats(_manifest(spark, sf_dir), failed.unionAll(failed.where("doc_id % 2 = 0")))


@_query(_M + """, r as (select '_receipts/' || replace(path, '/', '--') || '.json' as receipt, case when shard_index % 5 = 1 then 'x' else 'sha-' || path end as s from m where shard_index % 2 = 1)
select split, shard_index, path, k.receipt, case when s is null then 'upload' when s = 'sha-' || path then 'skip' else 'conflict' end as action
from (select *, '_receipts/' || replace(path, '/', '--') || '.json' as receipt from m) k left join r using (receipt)""")
def receipt_diff(spark, sf_dir):
    """What publication would do with each shard."""
    m = _manifest(spark, sf_dir).withColumn("sha256", F.concat(F.lit("sha-"), F.col("path")))
    receipts = m.where("shard_index % 2 = 1").select(v.receipt_path(F.col("path")).alias("receipt"), F.when(F.col("shard_index") % 5 == 1, "x").otherwise(F.col("sha256")).alias("sha256"))
    return manifest.receipt_diff(m, receipts)


@_query(f"select vec_id, {_CODES_SQL} as single_codes, case when vec_id % 31 = 0 then list_prepend(0, ({_CODES_SQL})[2:]) end as batch_codes from embeddings where vec_id % 31 = 0 or vec_id % 37 = 0")
def batch_equivalence(spark, sf_dir):
    """Vectors whose single and batch codes differ."""
    e = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", F.transform("embedding", lambda x: F.floor((x.cast("double") + 1) * 1024).cast("int")).alias("codes"))
    other = F.when(F.col("vec_id") % 31 == 0, F.concat(F.array(F.lit(0)), F.slice("codes", 2, 1 << 30))).otherwise(F.col("codes"))
    batch = e.where("vec_id % 37 <> 0 or vec_id % 31 = 0").withColumn("codes", other)
    return encode.unequal(e, batch, "vec_id", "codes")


@_query(_P + "select doc_id, semantic_length, list_transform(range(semantic_length), lambda i: ((doc_id * 31 + i * 17) % 2048)::int) as semantic_codes from p")
def encode_proxy(spark, sf_dir):
    """Stand-in codes of every row."""
    return with_codes(proxy(spark, sf_dir)).select("doc_id", "semantic_length", "semantic_codes")


_PROGRESS_SQL = _with(PROXY_SQL, BATCHES_SQL, """bt as (select split, batch_id, count(*)::bigint as examples, sum(audio_seconds) as audio_seconds, sum(semantic_length)::bigint as semantic_tokens from b group by all),
pr as (select split, batch_id, sum(examples) over w::bigint as examples, sum(audio_seconds) over w as audio_seconds, sum(semantic_tokens) over w::bigint as semantic_tokens, (batch_id * 2)::double as elapsed_seconds,
  case split when 'train' then 108000.0::double when 'validation' then 18000.0::double end as total from bt window w as (partition by split order by batch_id)),
pg as (select split, batch_id, examples::bigint as examples, audio_seconds, semantic_tokens::bigint as semantic_tokens, elapsed_seconds, audio_seconds / nullif(elapsed_seconds, 0) as audio_seconds_per_second,
  1 / (audio_seconds / nullif(elapsed_seconds, 0)) as realtime_factor, case when total is not null then least(audio_seconds / total, 1.0::double) end as progress_fraction,
  case when total is not null then greatest(total - audio_seconds, 0.0::double) / (audio_seconds / nullif(elapsed_seconds, 0)) end as eta_seconds from pr)""".replace("over w::bigint", "over w"), recursive=True)  # fmt: skip


def _progress(spark, sf_dir):
    b = _batched(spark, sf_dir).groupBy("split", "batch_id").agg(
        F.count(F.lit(1)).alias("examples"), F.sum("audio_seconds").alias("audio_seconds"), F.sum(F.col("semantic_length").cast("bigint")).alias("semantic_tokens")
    )
    return manifest.progress(b, {"train": 108_000.0, "validation": 18_000.0}, (F.col("batch_id") * 2).cast("double"))


@_query(_PROGRESS_SQL + "select * from pg")
def run_progress(spark, sf_dir):
    """Running totals, speed, fraction and remaining time after each batch."""
    return _progress(spark, sf_dir)


@_query(_PROGRESS_SQL + "select * from pg where split = 'train' order by batch_id desc limit 1")
def latest_metrics(spark, sf_dir):
    return manifest.last_line(_progress(spark, sf_dir).where("split = 'train'"), "batch_id")


@_query(_P + """select split, count(*)::bigint as examples, min(audio_seconds) as min_audio_seconds, max(audio_seconds) as max_audio_seconds, avg(audio_seconds) as avg_audio_seconds,
  min(semantic_length)::double as min_semantic_length, max(semantic_length)::double as max_semantic_length, avg(semantic_length) as avg_semantic_length from p group by split""")
def spec_stats(spark, sf_dir):
    return checks.distribution(proxy(spark, sf_dir))


@_query(_P + """, x as (select source_split, case when doc_id % 50 = 0 then 'TypeError' else 'ValueError' end as error_type, count(*)::bigint as failures
  from p where doc_id % 50 = 0 or doc_id % 97 = 0 group by all)
select source_split, error_type, failures, failures::double / sum(failures) over (partition by source_split)::double as share from x""")
def failure_types(spark, sf_dir):
    """Failures by type; every hundredth document is listed twice, as after a crash."""
    k = F.col("doc_id")
    rows = proxy(spark, sf_dir).where((k % 50 == 0) | (k % 97 == 0)).withColumn("error_type", F.when(k % 50 == 0, "TypeError").otherwise("ValueError"))
    return checks.failures_by_type(rows.unionAll(rows.where(k % 100 == 0)))


@_query(_P + """, x as (select *, case when doc_id % 41 = 0 then 'same' else sample_id end as sid, case when doc_id % 43 = 0 then audio_seconds + 1 else audio_seconds end as secs from p)
select count(*)::bigint as rows, sum((abs(source_num_samples / 16000.0::double - secs) > 0.1)::int)::bigint as duration_off,
  sum((doc_id % 47 = 0)::int)::bigint as codes_out_of_range, sum((abs(semantic_length - secs * 12.5::double) > 1)::int)::bigint as frames_off,
  (select count(*)::bigint from (select sid from x group by sid having count(*) > 1)) as repeated_sample_ids from x""")
def spec_invariants(spark, sf_dir):
    """Promises of the format that row rules don't cover."""
    k = F.col("doc_id")
    rows = with_codes(proxy(spark, sf_dir)).withColumns({
        "sample_id": F.when(k % 41 == 0, "same").otherwise(F.col("sample_id")), "audio_seconds": F.when(k % 43 == 0, F.col("audio_seconds") + 1).otherwise(F.col("audio_seconds")),
        "semantic_codes": F.when(k % 47 == 0, F.array(F.lit(5000))).otherwise(F.col("semantic_codes")),
    })
    return checks.invariants(rows)
