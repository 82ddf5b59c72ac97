import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.operators import folds


def python_batches(seconds, budget):
    out, n, longest, b = [], 0, 0.0, -1
    for s in seconds:
        if n and max(longest, s) * (n + 1) > budget:
            n = 0
        if n == 0:
            b, longest = b + 1, 0.0
        n, longest = n + 1, max(longest, s)
        out.append(b)
        if longest * n >= budget:
            n = 0
    return out


def frame(spark, by_split):
    return spark.createDataFrame([(k, i, float(s)) for k, v in by_split.items() for i, s in enumerate(v)], "split string, pos long, s double")


def test_golden_batches(spark):
    # fixed values: parity of the greedy rules
    got = folds.padded_batches(frame(spark, {"train": [1, 1, 1]}), "split", ["pos"], "s", 2.0).orderBy("pos").collect()
    assert [r["batch_id"] for r in got] == [0, 0, 1]
    assert folds.fill_budget([1.0, 10.0, 1.0], 25.0) == [0, 1]
    assert folds.fill_budget([], 25.0) == []


@pytest.mark.parametrize("budget", [1.0, 7.5, 30.0, 1e9])
def test_batches_and_shards_follow_the_rule(spark, budget):
    r = np.random.default_rng(3)
    data = {"a": (r.integers(1, 160, 300) / 16).tolist(), "b": [50.0] + [0.5] * 40, "c": [2.0]}
    got = folds.padded_batches(frame(spark, data), "split", ["pos"], "s", budget)
    rows = {}
    for x in folds.duration_shards(got, "split", ["pos"], "s", 20.0).orderBy("split", "pos").collect():
        rows.setdefault(x["split"], []).append((x["batch_id"], x["shard_index"]))
    for k, v in data.items():
        ids = python_batches(v, budget)
        assert [b for b, _ in rows[k]] == ids
        shard, total, want = 0, 0.0, {}
        for b in sorted(set(ids)):
            if total >= 20.0:
                shard, total = shard + 1, 0.0
            want[b] = shard
            total += sum(s for s, i in zip(v, ids, strict=True) if i == b)
        assert [s for _, s in rows[k]] == [want[b] for b in ids]


def test_nulls_and_empty(spark):
    df = spark.createDataFrame([(None, 0, None), (None, 1, 3.0)], "split string, pos long, s double")
    assert [r["batch_id"] for r in folds.padded_batches(df, "split", ["pos"], "s", 5.0).orderBy("pos").collect()] == [0, 1]
    assert folds.padded_batches(df.where(F.lit(False)), "split", ["pos"], "s", 5.0).count() == 0


@pytest.mark.parametrize("chunk_rows", [1, 7, 40])
def test_chunks_agree_with_one_run(spark, chunk_rows):
    r = np.random.default_rng(6)
    df = frame(spark, {"a": (r.integers(1, 400, 300) / 16).tolist(), "b": [0.25] * 100, "c": [9.0]})
    df = df.withColumn("file", F.expr(f"format_string('f-%05d', pos div {chunk_rows})"))

    def shards(**options):
        batches = folds.padded_batches(df, "split", ["file", "pos"], "s", 60.0, **options)
        return sorted(tuple(x) for x in folds.duration_shards(batches, "split", ["file", "pos"], "s", 90.0, **options).select("split", "pos", "batch_id", "shard_index").collect())

    assert shards(single_chunk_rows=0) == shards()
