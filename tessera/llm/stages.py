"""Steps of the corpus pipeline: each takes (spark, docs, sf_dir) and returns the documents it keeps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize
from .decontaminate import find_leaks
from .minhash import near_duplicates
from .mixing import mixed_documents
from .quality import fit_quality, score_quality
from .sharding import stratified_shards

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def quality(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier rejects (score under 0.3) go.

    Every row is judged by its own text, also with a null or repeated id; null and empty texts have the score of a
    passage without words, and go or stay by it. An empty table stays empty.
    """
    docs = docs.select(*COLUMNS)
    model = fit_quality(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return score_quality(docs, model, "quality_score").where("quality_score >= 0.3").select(*COLUMNS)


def near_dedup(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group stays: a row with the group's smallest id.

    Of rows that share this id in a group, the one of the smallest text hash stays, and of equal rows one. Rows
    without words link with nothing and stay, save repeats of the same row; rows with a null id all stay. An empty
    table stays empty.
    """
    docs = docs.select(*COLUMNS)
    found = near_duplicates(docs, shingle_words=5, num=80, den=100).where("doc_id is not null")
    found = materialize(found.groupBy("doc_id", "same", "component_id").agg(F.max("kept").alias("kept"), F.count(F.lit(1)).alias("n")), "near-found")
    # several texts of a group under its smallest id, and equal rows: both are few, so docs are read twice and not shuffled by them
    several = found.where("kept").groupBy("component_id").agg(F.min("same").alias("best"), F.count(F.lit(1)).alias("texts")).where("texts > 1")
    second = found.where("kept").join(several, "component_id").where("same != best")
    repeats = found.where("kept and n > 1").join(second.select("doc_id", "same"), ["doc_id", "same"], "left_anti")
    gone = found.where("not kept").select("doc_id", "same").unionAll(second.select("doc_id", "same"))
    known = docs.select("*", F.xxhash64("text").alias("same"))
    once = known.join(repeats.select("doc_id", "same"), ["doc_id", "same"], "left_semi").dropDuplicates(["doc_id", "same"])
    return known.join(gone.unionAll(repeats.select("doc_id", "same")), ["doc_id", "same"], "left_anti").unionByName(once).select(*COLUMNS)


def decontaminate(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents into which a benchmark item leaked go, with all rows of their id.

    Rows with a null id, or a null or empty text of an id without a leak, stay. An empty table stays empty.
    """
    leaks = find_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return docs.select(*COLUMNS).join(leaks.select("doc_id").distinct(), "doc_id", "left_anti").select(*COLUMNS)


def mix(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated or left out so that sources come near their target weights.

    Every row counts by itself, also with a null or repeated id; a row without words goes, as the mixture takes no
    words of it. An empty table stays empty.
    """
    return mixed_documents(docs.select(*COLUMNS))


def shard(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every row in one of 24 shards, each with the mixture of the whole.

    Rows with a null or repeated id and null or empty texts have places of their own; an empty table stays empty.
    """
    return stratified_shards(docs.select(*COLUMNS), 24)
