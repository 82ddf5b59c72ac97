"""Building, resuming, validating and publishing a small cache, and the sink's behaviour around crashes."""

import io
import json
import os
import wave

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
import yaml

from tessera import build, cli, publish
from tessera.config import ConfigError, faults, placeholders, read_config, require_valid
from tessera.operators import encode
from tessera.schema import CACHE_ARROW
from tessera.sources.jsonl import append_lines, lines_frame, read_lines
from tessera.sources.listing import list_files, scan_shards
from tessera.sources.sink import MANIFEST, ShardSink, file_sha256


def wav(seconds: float, rate: int = 16_000, level: float = 0.1) -> bytes:
    out = io.BytesIO()
    with wave.open(out, "wb") as f:
        f.setnchannels(1)
        f.setsampwidth(2)
        f.setframerate(rate)
        f.writeframes((np.full(int(seconds * rate), level) * 32767).astype(np.int16).tobytes())
    return out.getvalue()


@pytest.fixture
def source(tmp_path):
    kind = pa.struct([("bytes", pa.binary()), ("path", pa.string())])
    for config, split, n_files in (("medium", "train", 3), ("dev", "dev", 1)):
        (tmp_path / "src" / config).mkdir(parents=True)
        for f in range(n_files):
            audio = [{"bytes": wav(0.5 + i % 3, level=0.05 * (i + 1)), "path": f"{f}/{i}.flac"} for i in range(5)]
            text = [f"Sentence {f} {i}’s" for i in range(5)]
            if split == "train" and f == 1:
                audio[2], text[3] = {"bytes": b"junk", "path": "x"}, "  "
            pq.write_table(pa.table({"ID": [f"{f}-{i}" for i in range(5)], "wav": pa.array(audio, kind), "text": text}), tmp_path / "src" / config / f"{split}-{f:05d}.parquet")
    return tmp_path / "src"


def config(source, out, **runtime) -> dict:
    return {
        "dataset": {"id": "x", "revision": "1", "root": str(source), "splits": {"train": {"config": "medium", "split": "train", "expected_audio_hours": 1}, "validation": {"config": "dev", "split": "dev", "expected_audio_hours": 1}}},
        "mimi": {"revision": "1", "sample_rate": 24_000, "codebook_size": 2048}, "text": {"normalizer": "english_v1"},
        "output": {"path": str(out), "target_audio_hours_per_shard": 6 / 3600}, "runtime": {"target_vram_fraction": 0.8, "max_batch_audio_seconds": 4} | runtime,
    }


def built(spark, values, **options):
    """A run as a user makes it: the preflight, then the build."""
    build.preflight(spark, values)
    return build.run(spark, values, **options)


def cached_rows(out):
    return [r for x in build.completed(out) for r in pq.read_table(out / x["path"]).to_pylist()]


def test_build_resume_validate_publish(spark, source, tmp_path, monkeypatch):
    out = tmp_path / "out"
    stats = built(spark, config(source, out))
    assert stats["examples"] == 18 and stats["failures"] == 2 and stats["shards"] >= 3
    rows = cached_rows(out)
    assert len({r["sample_id"] for r in rows}) == 18 and all(r["normalized_text"].endswith("'s") for r in rows)
    assert pq.read_schema(out / build.completed(out)[0]["path"]).remove_metadata() == CACHE_ARROW
    assert all(len(r["semantic_codes"]) == r["semantic_length"] > 0 for r in rows)
    assert sorted(r["error_type"] for r in read_lines(out / build.FAILURES)) == ["ValueError", "ValueError"]
    with pytest.raises(FileExistsError):
        build.run(spark, config(source, out))
    before = (out / MANIFEST).read_text()
    assert build.run(spark, config(source, out), resume=True)["examples"] == 18
    assert (out / MANIFEST).read_text() == before
    assert build.validate(spark, out)["examples"] == 18
    text = cli.status_text(spark, out)
    assert text.startswith("train:") and "tokens" in text

    monkeypatch.delenv("HF_TOKEN", raising=False)
    target = publish.FolderTarget(tmp_path / "hub")
    with pytest.raises(RuntimeError, match="HF_TOKEN"):
        publish.publish(spark, out, target)
    monkeypatch.setenv("HF_TOKEN", "t")
    assert publish.publish(spark, out, target)["uploaded_shards"] == stats["shards"]
    assert publish.publish(spark, out, target)["skipped_shards"] == stats["shards"]
    receipt = tmp_path / "hub" / publish.receipt_name(build.completed(out)[0]["path"])
    receipt.write_text(json.dumps(json.loads(receipt.read_text()) | {"sha256": "0"}))
    with pytest.raises(RuntimeError, match="another checksum"):
        publish.publish(spark, out, target)

    shard = out / build.completed(out)[0]["path"]
    data = shard.read_bytes()
    shard.write_bytes(data[:-1] + bytes([data[-1] ^ 1]))
    with pytest.raises(Exception):  # noqa: B017  the footer's last byte is broken
        build.validate(spark, out)
    shard.unlink()
    with pytest.raises(ValueError, match="missing file"):
        build.validate(spark, out)


def test_resume_after_a_crash_gives_the_same_rows(spark, source, tmp_path):
    whole, cut = tmp_path / "whole", tmp_path / "cut"
    built(spark, config(source, whole))
    built(spark, config(source, cut))
    # the crash: the second train shard was renamed, but never reached the manifest, whose last line is cut short
    lines = (cut / MANIFEST).read_text().splitlines(keepends=True)
    (cut / MANIFEST).write_text(lines[0] + lines[1][:20])
    (cut / build.SPLITS).unlink()
    (cut / build.FAILURES).unlink()
    stats = build.run(spark, config(source, cut), resume=True)
    strip = lambda rows: sorted((r["sample_id"], tuple(r["semantic_codes"])) for r in rows)
    assert stats["examples"] == 18 and strip(cached_rows(cut)) == strip(cached_rows(whole))


def test_other_settings_are_refused(spark, source, tmp_path):
    out = tmp_path / "out"
    built(spark, config(source, out))
    other = config(source, out)
    other["dataset"]["revision"] = "2"
    with pytest.raises(RuntimeError, match="dataset_revision"):
        build.run(spark, other, resume=True)
    with pytest.raises(build.Stopped):
        built(spark, config(source, tmp_path / "stop"), should_stop=lambda: True)
    with pytest.raises(ValueError, match="normalizer"):
        bad = config(source, tmp_path / "bad")
        bad["text"]["normalizer"] = "other"
        build.run(spark, bad)


def shards(out):
    return [(x["split"], x["shard_index"], x["examples"], x["last_source_shard"], x["last_source_row_index"], x["sha256"]) for x in build.completed(out)]


def test_slices_do_not_show(spark, source, tmp_path):
    whole, sliced = tmp_path / "whole", tmp_path / "sliced"
    built(spark, config(source, whole))
    built(spark, config(source, sliced, files_per_commit=1))
    assert shards(whole) == shards(sliced) and not any((sliced / "staging").iterdir())
    strip = lambda out: [{k: v for k, v in x.items() if k != "timestamp_utc"} for x in read_lines(out / build.FAILURES)]
    assert strip(whole) == strip(sliced) and len(strip(whole)) == 2
    last = read_lines(sliced / build.METRICS)[-1]
    assert last["split"] == "validation" and last["audio_seconds"] > 0 and last["progress_fraction"] > 0 and last["eta_seconds"] > 0


def test_stop_within_a_split_keeps_what_is_committed(spark, source, tmp_path):
    whole, cut = tmp_path / "whole", tmp_path / "cut"
    built(spark, config(source, whole))
    values = config(source, cut, files_per_commit=1)
    with pytest.raises(build.Stopped):
        built(spark, values, should_stop=lambda: (cut / MANIFEST).exists())
    kept = shards(cut)
    assert kept and kept == shards(whole)[: len(kept)] and len(kept) < len(shards(whole)) and not read_lines(cut / build.SPLITS)
    assert build.run(spark, values, resume=True)["failures"] == 2
    assert shards(cut) == shards(whole)


def test_crash_within_a_split(spark, source, tmp_path, monkeypatch):
    whole, cut = tmp_path / "whole", tmp_path / "cut"
    built(spark, config(source, whole))
    values, commit, calls = config(source, cut, files_per_commit=1), build._commit_slice, []

    def dies(*a, **k):
        calls.append(1)
        if len(calls) == 2:
            raise OSError("lost")
        commit(*a, **k)

    monkeypatch.setattr(build, "_commit_slice", dies)
    with pytest.raises(OSError, match="lost"):
        built(spark, values)
    kept = shards(cut)
    assert 0 < len(kept) < len(shards(whole))
    monkeypatch.setattr(build, "_commit_slice", commit)
    assert build.run(spark, values, resume=True)["failures"] == 2
    assert shards(cut) == shards(whole)


def test_files_without_good_rows(spark, tmp_path):
    kind = pa.struct([("bytes", pa.binary()), ("path", pa.string())])
    (tmp_path / "src/medium").mkdir(parents=True)
    for f, good in enumerate((False, None, False, True, False)):
        audio = [{"bytes": wav(1.5) if good else b"junk", "path": f"{f}/{i}"} for i in range(0 if good is None else 6)]
        table = pa.table({"wav": pa.array(audio, kind), "text": pa.array([f"Text {i}" for i in range(len(audio))], pa.string())})
        pq.write_table(table, tmp_path / "src/medium" / f"train-{f:05d}.parquet")
    values = config(tmp_path / "src", tmp_path / "out", files_per_commit=1)
    del values["dataset"]["splits"]["validation"]
    with pytest.raises(RuntimeError, match="two good examples"):
        build.preflight(spark, values)
    found = build._preflight_of(values, encode.HashEncoder()) | {"recommended_batch_audio_seconds": 4}
    build.write_document(tmp_path / "out" / build.PREFLIGHT, found)
    stats = build.run(spark, values)
    assert stats["examples"] == 6 and stats["failures"] == 18
    (end,) = read_lines(tmp_path / "out" / build.SPLITS)
    assert (end["last_source_shard"], end["last_source_row_index"]) == ("medium/train-00004.parquet", 5)


def test_preflight(spark, source, tmp_path):
    values = config(source, tmp_path / "p", min_batch_audio_seconds=1, max_batch_audio_seconds=40)
    with pytest.raises(RuntimeError, match="benchmark"):
        build.run(spark, values)
    found = build.preflight(spark, values)
    assert found["examples"] >= 2 and found["recommended_batch_audio_seconds"] == 32
    assert [x["budget_audio_seconds"] for x in found["trials"]] == [1, 2, 4, 8, 16, 32]
    for x in found["trials"]:
        assert x["examples"] >= 1 and x["throughput_x_realtime"] == pytest.approx(x["actual_audio_seconds"] / x["elapsed_seconds"])
    assert build.required_budget(values, encode.HashEncoder()) == 32
    with pytest.raises(RuntimeError, match="encoder_identity"):
        build.run(spark, values, encoder=lambda: encode.HashEncoder(3))
    values["dataset"]["revision"] = "2"
    with pytest.raises(RuntimeError, match="dataset_revision"):
        build.run(spark, values)
    with pytest.raises(RuntimeError, match="differ: "):
        build.preflight(spark, values, encoder=Uneven)


class Uneven(encode.HashEncoder):
    """Its codes depend on what else is in the batch."""

    def encode(self, audio):
        return super().encode(audio) + len(audio)


def test_preflight_within_memory(spark, source, tmp_path):
    class Full(encode.HashEncoder):
        def encode(self, audio):
            self.held = len(audio) * max(len(a) for a in audio) / (20 * self.sample_rate)  # of padded audio
            return super().encode(audio)

        def memory_fraction(self):
            return self.held

    found = build.preflight(spark, config(source, tmp_path / "p", min_batch_audio_seconds=4, max_batch_audio_seconds=100), encoder=Full)
    assert found["recommended_batch_audio_seconds"] == 16 and found["trials"][-1]["gpu_memory_fraction"] > 0.8


def test_gpu_figures(tmp_path, monkeypatch):
    monkeypatch.setenv("PATH", str(tmp_path))
    assert set(build.gpu_snapshot().values()) == {None}
    tool = tmp_path / "nvidia-smi"
    tool.write_text("#!/bin/sh\necho '37, 1024, 8192, 55, [N/A]'\n")
    tool.chmod(0o755)
    assert list(build.gpu_snapshot().values()) == [37.0, 1 << 30, 8 << 30, 55.0, None]


def test_scan_positions_and_cursor(spark, source):
    paths = sorted(r["path"] for r in list_files(spark, str(source)).collect())
    assert paths == ["dev/dev-00000.parquet", *[f"medium/train-0000{i}.parquet" for i in range(3)]]
    rows = scan_shards(spark, str(source), paths[1:], ("medium/train-00001.parquet", 2)).select("source_shard", "source_row_index").collect()
    assert sorted((r[0][-9], r[1]) for r in rows) == [("1", 3), ("1", 4), *[("2", i) for i in range(5)]]
    assert scan_shards(spark, str(source), paths[1:], ("medium/train-00009.parquet", 0)).count() == 0
    with pytest.raises(FileNotFoundError):
        scan_shards(spark, str(source), [])


def sink_rows(spark, split="train", index=0):
    row = {
        "sample_id": "0a1b", "source_id": "talk-7", "source_config": "dev", "source_split": "dev", "source_shard": "dev/dev-00004.parquet", "source_row_index": 41,
        "speaker_id": "sp3", "chapter_id": "c2", "source_audio_name": "t7.wav", "source_sample_rate": 24_000, "source_num_samples": 6_000, "audio_seconds": 0.25,
        "original_text": "Guten Tag", "normalized_text": "guten tag", "semantic_codes": [5, 17, 1999, 3], "semantic_length": 4, "split": split, "shard_index": index, "exact_seconds": 0.25,
    }
    from tessera.schema import CACHE_DDL

    return row, spark.createDataFrame([tuple(row.values())], CACHE_DDL + ", split string, shard_index int, exact_seconds double")


def test_sink_round_trip_and_refusal(spark, tmp_path):
    spark.dataSource.register(ShardSink)
    row, df = sink_rows(spark)
    save = lambda: df.write.format("token-shards").option("path", str(tmp_path)).mode("append").save()
    (tmp_path / "train").mkdir()
    (tmp_path / "train/train-00000.parquet").write_bytes(b"left by a crash")
    save()
    t = pq.read_table(tmp_path / "train/train-00000.parquet")
    assert t.schema.remove_metadata() == CACHE_ARROW and t.to_pylist() == [{k: row[k] for k in CACHE_ARROW.names}]
    (record,) = read_lines(tmp_path / MANIFEST)
    assert record["sha256"] == file_sha256(tmp_path / record["path"]) and record["examples"] == 1
    with pytest.raises(Exception, match="already in the manifest"):
        save()
    assert not list(tmp_path.rglob("*.tmp")) and len(read_lines(tmp_path / MANIFEST)) == 1


def test_jsonl(spark, tmp_path):
    p = tmp_path / "a.jsonl"
    assert read_lines(p) == []
    append_lines(p, [{"b": 1, "a": "é"}])
    assert p.read_text() == '{"a": "é", "b": 1}\n'
    with p.open("a") as f:
        f.write('\n{"cut')
    assert len(read_lines(p)) == 1
    append_lines(p, [{"a": "x"}])
    assert [r["a"] for r in read_lines(p)] == ["é", "x"]
    assert [r["a"] for r in lines_frame(spark, p, "a string, b bigint").orderBy("line_no").collect()] == ["é", "x"]
    p.write_text("{bad}\n{}\n")
    with pytest.raises(ValueError, match=":1:"):
        read_lines(p)


class Fragile(encode.HashEncoder):
    def __init__(self, most):
        super().__init__()
        self.most, self.sizes = most, []

    def encode(self, audio):
        self.sizes.append(len(audio))
        if len(audio) > self.most:
            raise RuntimeError("CUDA error: out of memory")
        return super().encode(audio)


def test_encoder_backoff_and_search():
    audio = [np.full(1920 * (i + 1), 0.1, np.float32) for i in range(5)]
    e = Fragile(2)
    codes, budget = encode.encode_with_backoff(e, audio, 60.0)
    assert codes == [encode.encode_batch(encode.HashEncoder(), [a])[0] for a in audio] and budget == 15.0
    assert [len(c) for c in codes] == [1, 2, 3, 4, 5] and encode.encode_batch(e, []) == []
    with pytest.raises(RuntimeError):
        encode.encode_with_backoff(Fragile(0), audio[:1], 1.0)
    with pytest.raises(ValueError):
        encode.encode_batch(encode.HashEncoder(), audio, 5)

    def attempt(budget):
        if budget > 40:
            raise RuntimeError("CUDA out of memory")
        return encode.Trial(budget, "ok", gpu_memory_fraction=budget / 50)

    best, trials = encode.search_budget(attempt, 5, 600, 0.8)
    assert best == 40 and trials[-1].status == "ok"
    assert encode.search_budget(lambda b: attempt(b * 3), 5, 600, 0.9)[1][-1].status == "oom"
    with pytest.raises(RuntimeError):
        encode.search_budget(lambda b: attempt(100), 5, 600, 0.8)


def test_config_and_cli(tmp_path, monkeypatch, capsys):
    raw = read_config(os.path.join(os.path.dirname(__file__), "../configs/example.yaml"))
    assert placeholders(raw) == ["dataset.root", "output.path"] and placeholders({"a": [1, "REQUIRED_X"]}) == ["a[1]"]
    p = tmp_path / "c.yaml"
    p.write_text(yaml.safe_dump(raw))
    assert cli.main(["benchmark", "--config", str(p)]) == 2 and "output.path" in capsys.readouterr().err
    monkeypatch.delenv("HF_TOKEN", raising=False)
    assert cli.main(["publish", "--output", str(tmp_path)]) == 2 and "HF_TOKEN" in capsys.readouterr().err
    raw["output"]["path"], raw["dataset"]["root"] = "/o", "/s"
    assert faults(raw) == [] and require_valid(raw) is raw
    # every fault is told, not the first alone
    raw["dataset"]["revision"], raw["runtime"]["target_vram_fraction"] = "main", 0.99
    raw["dataset"]["splits"]["dev"], raw["text"] = {"config": 3}, {}
    assert faults(raw) == [
        "dataset.revision must be pinned", "dataset.splits.dev.config has the wrong type", "dataset.splits.dev.split is missing",
        "text.normalizer is missing", "runtime.target_vram_fraction must be from 0.1 to 0.98",
    ]
    with pytest.raises(ConfigError, match="pinned"):
        require_valid(raw)
    p.write_text("[]")
    assert faults(read_config(p)) == ["the configuration must be a mapping"] and faults({"dataset": 1})[0] == "dataset has the wrong type"


def test_stream(spark, tmp_path):
    from pyspark.sql import functions as F

    from tessera.streaming.incremental import new_rows, stream_batches

    src = tmp_path / "in"
    rows = spark.createDataFrame([(f"Text {i}", 1.0 + i % 2) for i in range(8)] + [(" ", 1.0)], "text string, audio_seconds double")
    rows.coalesce(1).write.parquet(str(src))
    for _ in range(2):  # a second run finds nothing new
        q = stream_batches(new_rows(spark, str(src), rows.schema), str(tmp_path / "out"), str(tmp_path / "ckpt"), 4.0)
        q.awaitTermination(60)
        assert q.exception() is None
    out = spark.read.parquet(str(tmp_path / "out"))
    assert out.count() == 8 and out.agg(F.countDistinct("batch_id")).first()[0] == 4
