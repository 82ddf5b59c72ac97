import sys
import unicodedata

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.functions import audio, text, values


def test_normalizer_golden():
    # fixed value: parity of the normaliser
    assert text.normalize("  It’s\tA  TEST. ") == "it's a test."
    with pytest.raises(ValueError):
        text.normalize("x", "other")


def test_unknown_normalizer_fails_before_a_job(spark):
    with pytest.raises(ValueError):
        text.normalized(F.lit("x"), "other")


def test_normalizer_column_follows_python_over_unicode(spark):
    points = [c for c in range(1, sys.maxunicode + 1, 7) if not 0xD800 <= c < 0xE000 and unicodedata.category(chr(c)) != "Cn"]
    points += [0x85, 0x2028, 0x1C, 0x1D, 0x1E, 0x1F, 0x3000, 0xFB01, 0xFF21, 0x130, 0x3A3, 0x2018, 0x2BC]
    rows = [(c, f"a{chr(c)}B {chr(c)}") for c in points]
    got = spark.createDataFrame(rows, "c int, t string").select("c", "t", text.normalized(F.col("t")).alias("n")).collect()
    assert [r["c"] for r in got if r["n"] != text.english_v1(r["t"])] == []


def test_normalizer_null_and_blank(spark):
    got = spark.createDataFrame([(None,), ("",), (" \n\t",)], "t string").select(text.normalized(F.col("t")).alias("n")).collect()
    assert [r["n"] for r in got] == [None, "", ""]


def test_first_truthy_and_base_name(spark):
    df = spark.createDataFrame([("", 0, False, "a/b/c.flac"), ("x", 5, True, "a/b/"), (None, None, None, "plain")], "s string, n int, b boolean, p string")
    got = df.select(values.first_truthy(F.col("s"), F.col("n"), F.col("b"), default=F.lit("d")).alias("v"), values.base_name(F.col("p")).alias("p")).collect()
    assert [(r["v"], r["p"]) for r in got] == [("d", "c.flac"), ("x", "b"), ("d", "plain")]
    assert [r[0] for r in df.select(values.first_truthy(F.col("n"), F.col("b"), default=F.lit("d"))).collect()] == ["d", "5", "d"]


def test_formats(spark):
    df = spark.createDataFrame([(0.0, 0), (-3.0, 1 << 30), (360_000.9, 3 << 29), (None, None)], "s double, b long")
    got = df.select(values.clock(F.col("s")), values.gib(F.col("b"))).collect()
    assert [tuple(r) for r in got] == [("00:00:00", "0.0GiB"), ("00:00:00", "1.0GiB"), ("100:00:00", "1.5GiB"), ("n/a", "n/a")]
    assert spark.range(1).select(values.shard_path(F.lit("train"), F.lit(123456)), values.receipt_path(F.lit("a/b.parquet"))).first()[:] == ("train/train-123456.parquet", "_receipts/a--b.parquet.json")


def test_mixdown_shapes():
    x = np.arange(6, dtype=np.float32)
    assert audio.mixdown(x) is not None and len(audio.mixdown(x)) == 6
    assert audio.mixdown(x.reshape(2, 3)).tolist() == [1.5, 2.5, 3.5]
    assert audio.mixdown(x.reshape(3, 2)).tolist() == [0.5, 2.5, 4.5]
    with pytest.raises(ValueError):
        audio.mixdown(x.reshape(1, 2, 3))


def test_payload_and_resample():
    with pytest.raises(ValueError, match="shard:7"):
        audio.payload({"bytes": None}, "shard:7")
    with pytest.raises(ValueError, match="shard:7"):
        audio.payload({"bytes": b"junk"}, "shard:7")
    assert len(audio.resample(np.zeros(16_001, np.float32), 16_000, 24_000)) == 24_002
    assert audio.prepare({"array": [0.0] * 1600, "sampling_rate": 16_000}, "x")["model_num_samples"] == 2400


def test_frame_size_is_half_even():
    assert values.frame_size() == 1920
    assert values.frame_size(5, 2.0) == 2
