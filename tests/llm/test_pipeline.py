"""The pipeline's stages against plain versions, on planted cases."""

import random

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tessera.llm import stages

from . import brute
from .test_operators import DOC, edited, prose


@pytest.fixture(scope="module")
def planted(spark, tmp_path_factory):
    r = random.Random(11)
    rows, labels, kind = [], [], {}

    def add(text, what, source=None):
        d = len(rows)
        rows.append((d, text, "en", source or f"s{d % 4}", len(text or "")))
        kind[d] = what
        return d

    items = [prose(r, 30) for _ in range(5)]
    for i in range(300):
        junk = i % 5 == 0
        t = prose(r, 120)
        d = add(" ".join(x + "!!" for x in t.upper().split()) if junk else t, "junk" if junk else "clean")
        if i < 250:
            labels.append((d, 0 if junk else 1, 0))
    base = [t for d, t, *_ in rows if kind[d] == "clean"][:10]
    for t in base:
        add(t, "copy")
        add(edited(r, t, 2), "near")
    for t in items:
        add(f"{prose(r, 60)} {t} {prose(r, 60)}", "leak")
    at = tmp_path_factory.mktemp("planted")
    spark.createDataFrame(rows, DOC).repartition(3).write.parquet(f"{at}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{at}/labels.parquet")
    spark.createDataFrame(list(enumerate(items)), "item_id long, text string").write.parquet(f"{at}/benchmark.parquet")
    return str(at), rows, kind


def test_stages_one_by_one(spark, planted):
    at, rows, kind = planted
    docs = spark.read.parquet(f"{at}/documents.parquet")
    ids = lambda df: sorted(r["doc_id"] for r in df.select("doc_id").collect())
    kept = stages.quality(spark, docs, at)
    assert ids(kept) == [d for d in kind if kind[d] != "junk"] and kept.columns == docs.columns
    got = ids(stages.near_dedup(spark, kept, at))
    want = brute.components([(d, t) for d, t, *_ in rows if kind[d] != "junk"], 5, 80, 100)
    assert got == [d for d in sorted(want) if want[d][1] == d]
    assert ids(stages.decontaminate(spark, kept, at)) == [d for d in kind if kind[d] not in ("junk", "leak")]
    mixed = stages.mix(spark, kept, at)
    counts = {r["source"]: r["n"] for r in mixed.groupBy("source").agg(F.count("*").alias("n")).collect()}
    sizes = {s: sum(1 for d, *x in rows if kind[d] != "junk" and x[2] == s) for s in counts}
    total, weights = sum(sizes.values()), dict(zip(sorted(sizes), (1, 2, 3, 1), strict=True))
    for s, n in counts.items():
        assert n == pytest.approx(total * weights[s] / 7, rel=0.25)
    shards = stages.shard(spark, mixed, at).collect()
    assert len(shards) == mixed.count() and {r["shard"] for r in shards} == set(range(24))


def test_whole_pipeline(spark, planted):
    at, _, kind = planted
    out = corpus_pipeline.run(spark, at)
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "near_dedup", "decontaminate", "mix", "shard"]
    assert {kind[r["doc_id"]] for r in out.select("doc_id").distinct().collect()} == {"clean"} and {"shard", "slot"} <= set(out.columns)


def test_stages_of_empty_and_null_tables(spark, planted):
    at, _, _ = planted
    nothing = spark.createDataFrame([], DOC)
    r = random.Random(12)
    t, u = prose(r, 60), prose(r, 60)
    rows = [(None, None), (None, t), (None, t), (1, ""), (2, "a b c"), (2, "a b c"), (3, t), (3, t), (3, t + " end"), (4, t), (5, u), (5, t), (6, None), (6, None)]
    odd = spark.createDataFrame([(d, x, None, None, None) for d, x in rows], DOC)
    got = {}
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, nothing, at).count() == 0
        got[name] = sorted(str((x["doc_id"], x["text"])) for x in stage(spark, odd, at).collect())
    words = [x for x in rows if x[1]]
    assert got["decontaminate"] == got["shard"] == sorted(map(str, rows)) and got["mix"] == sorted(map(str, words)) and set(got["quality"]) <= set(map(str, rows))
    kept = got["near_dedup"]
    one_of = [x for x in kept if x.startswith("(3,")]
    assert len(one_of) == 1 and one_of[0] in (str((3, t)), str((3, t + " end")))
    assert [x for x in kept if x not in one_of] == sorted(map(str, [*rows[:3], (1, ""), (2, "a b c"), (5, u), (6, None)]))
