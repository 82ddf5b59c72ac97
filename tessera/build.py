"""Building a cache: scan, project, normalise, prepare, batch, encode, shard, commit; resumable at any point.

A split is built in slices of source files, and the shards of a slice are committed before the next is begun.
Prepared rows (with their waveforms) of a slice are written once, since both folds and the encoder read them;
the folds see durations only, batches are dealt out to the encoder one by one, and what goes to the shards is codes.
"""

from __future__ import annotations

import json
import shutil
import signal
import subprocess
import sys
import threading
import time
from bisect import bisect_left
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from dataclasses import asdict
from pathlib import Path

import numpy as np
import pandas as pd
import psutil
import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .config import output_root, require_valid
from .functions import audio as audio_fn
from .functions.text import normalized
from .functions.values import sample_id
from .operators import folds
from .operators.checks import validate_shards, validation_totals
from .operators.encode import Encoder, HashEncoder, Trial, encode_batch, encode_with_backoff, search_budget
from .operators.manifest import latest
from .schema import CACHE_ARROW, CACHE_DDL, FAILURES_DDL, SHARDS_DDL, violation
from .sources.jsonl import append_lines, lines_frame, read_lines, write_document
from .sources.listing import list_files, project_source, scan_shards, shard_listing
from .sources.sink import MANIFEST, ShardSink, file_sha256, utc_now

SPLITS, FAILURES, METRICS, INFO = "manifests/splits.jsonl", "manifests/failures.jsonl", "manifests/run_metrics.jsonl", "dataset_info.json"
PREFLIGHT = "benchmark.json"
#: dead letters in one append, which bounds what the driver holds
FAILURE_LINES = 10_000
#: source files taken at a time, unless runtime.files_per_commit says otherwise
FILES_PER_COMMIT = 256
_PREPARED = "source_num_samples bigint, source_sample_rate int, exact_seconds double, model_num_samples bigint, samples binary, audio_error string"


class Stopped(Exception):
    """The run was asked to stop; everything committed so far stays."""


@contextmanager
def stop_flag() -> Iterator[Callable[[], bool]]:
    """True after SIGINT or SIGTERM; the handlers before are put back."""
    asked: list[int] = []
    before = {s: signal.signal(s, lambda n, _: asked.append(n)) for s in (signal.SIGINT, signal.SIGTERM)}
    try:
        yield lambda: bool(asked)
    finally:
        for s, h in before.items():
            signal.signal(s, h)


def prepare_rows(rows: DataFrame, version: str, model_rate: int) -> DataFrame:
    """Adds prepared audio, normalised text and error (a failure of the audio before an empty text)."""
    name = "wav" if "wav" in rows.columns else "audio"
    have = rows.schema[name].dataType.names if name in rows.columns else []
    field = lambda f, kind: F.col(f"{name}.{f}").cast(kind) if f in have else F.lit(None).cast(kind)
    raw = F.struct(field("bytes", "binary").alias("bytes"), field("array", "array<float>").alias("array"), field("sampling_rate", "int").alias("sampling_rate"))
    keep = ["source_id", "source_shard", "source_row_index", "speaker", "chapter", "source_audio_name", "original_text"]
    kinds = {f.name: f.dataType.simpleString() for f in rows.schema}

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = []
            for a, shard, row in zip(b.pop("raw"), b["source_shard"], b["source_row_index"], strict=True):
                try:
                    p = audio_fn.prepare(a, f"{shard}:{row}", model_rate)
                    out.append((p["source_num_samples"], p["source_sample_rate"], p["audio_seconds"], p["model_num_samples"], p["samples"].astype(np.float32).tobytes(), None))
                except (ValueError, TypeError) as e:
                    out.append((0, 0, 0.0, 0, b"", f"{type(e).__name__}: {e}"))
            yield pd.concat([b.reset_index(drop=True), pd.DataFrame(out, columns=[c.split()[0] for c in _PREPARED.split(", ")])], axis=1)

    ddl = ", ".join(f"{c} {kinds[c]}" for c in keep) + ", " + _PREPARED
    prepared = rows.select(*keep, raw.alias("raw")).mapInPandas(run, ddl).withColumn("normalized_text", normalized(F.col("original_text"), version))
    return prepared.withColumn("error", F.coalesce("audio_error", F.when(F.col("normalized_text") == "", "ValueError: normalized text is empty"))).drop("audio_error")


def encode_rows(rows: DataFrame, encoder: Callable[[], Encoder], codebook: int, budget: float) -> DataFrame:
    """Replaces samples by semantic_codes; rows come grouped by batch, and each batch is one call of the encoder."""
    kinds = {f.name: f.dataType.simpleString() for f in rows.schema}
    keep = [c for c in rows.columns if c != "samples"]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model, held, at = encoder(), [], None

        def flush() -> Iterator[pd.DataFrame]:
            if held:
                whole = pd.concat(held, ignore_index=True)
                codes, _ = encode_with_backoff(model, [np.frombuffer(x, np.float32) for x in whole.pop("samples")], budget, codebook)
                if len(codes) != len(whole):
                    raise ValueError("the encoder gave another number of results than it got waveforms")
                yield whole.assign(semantic_codes=codes)

        for b in batches:
            for key, part in b.groupby(["split", "batch_id"], sort=False):
                if key != at:
                    yield from flush()
                    held, at = [], key
                held.append(part)
        yield from flush()

    ddl = ", ".join(f"{c} {kinds[c]}" for c in keep) + ", semantic_codes array<int>"
    return rows.repartition("split", "batch_id").sortWithinPartitions("split", "batch_id", "source_shard", "source_row_index").mapInPandas(run, ddl)


def completed(root: Path) -> list[dict]:
    """The last completed record of each shard, in manifest order."""
    last = {(r["split"], r["shard_index"]): r for r in read_lines(root / MANIFEST) if r.get("status") == "complete"}
    return list(last.values())


def gpu_snapshot() -> dict:
    """Figures of the driver's first GPU, null without one."""
    # fixed values: the names of the metrics, and what the vendor's tool calls them
    names = {
        "gpu_utilization_percent": "utilization.gpu", "gpu_memory_used_bytes": "memory.used", "gpu_memory_total_bytes": "memory.total",
        "gpu_temperature_c": "temperature.gpu", "gpu_power_w": "power.draw",
    }
    out = dict.fromkeys(names)
    if tool := shutil.which("nvidia-smi"):
        try:
            ask = [tool, f"--query-gpu={','.join(names.values())}", "--format=csv,noheader,nounits"]
            told = subprocess.run(ask, capture_output=True, text=True, timeout=2, check=True).stdout.splitlines()[0]
        except (OSError, subprocess.SubprocessError, IndexError):
            return out
        for name, text in zip(names, told.split(","), strict=False):
            try:
                out[name] = int(float(text) * 2**20) if name.endswith("bytes") else float(text)
            except ValueError:  # the tool says that this GPU doesn't tell
                continue
    return out


def resource_snapshot(path: Path) -> dict:
    memory = psutil.virtual_memory()
    return {"cpu_percent": psutil.cpu_percent(), "ram_used_bytes": memory.used, "ram_total_bytes": memory.total, "disk_free_bytes": psutil.disk_usage(str(path)).free} | gpu_snapshot()


def provenance(config: dict, encoder: Encoder) -> dict:
    d, m, t = (config[k] for k in ("dataset", "mimi", "text"))
    return {
        "dataset_id": d.get("id"), "dataset_revision": d.get("revision"), "dataset_configs": sorted({s["config"] for s in d["splits"].values()}),
        "expected_audio_hours_by_split": {k: s.get("expected_audio_hours") for k, s in d["splits"].items()}, "encoder_identity": encoder.identity,
        "sample_rate": encoder.sample_rate, "codebook": m.get("semantic_codebook_index", 0), "codebook_size": m.get("codebook_size", 2048), "frame_rate": m.get("frame_rate"),
        "normalizer_version": t["normalizer"], "channel_policy": "mean",
    }


def require_same(kept: dict, now: dict) -> None:
    if differ := sorted(k for k in now if k != "created_at_utc" and kept.get(k) != now[k]):
        raise RuntimeError("the output was built otherwise: " + ", ".join(differ))


def run(spark: SparkSession, config: dict, resume: bool = False, encoder: Callable[[], Encoder] = HashEncoder, should_stop: Callable[[], bool] = lambda: False) -> dict:
    """Build or continue the cache; returns the processing statistics.

    Needs the preflight's record of the same source and encoder, which also gives the budget of a batch. Raises
    Stopped between commits when asked to stop; shards committed by then stay, and a resumed run goes on after them.
    """
    require_valid(config)
    root, model = output_root(config), encoder()
    t, m, r = (config[k] for k in ("text", "mimi", "runtime"))
    normalized(F.lit(""), t["normalizer"])  # an unknown version ends the run here
    if m.get("sample_rate", model.sample_rate) != model.sample_rate:
        raise RuntimeError("the encoder has another sample rate")
    if (root / INFO).exists():
        if not resume:
            raise FileExistsError(f"{root} holds a cache; resume it")
        require_same(json.loads((root / INFO).read_text(encoding="utf-8")), provenance(config, model))
        budget = required_budget(config, model)
    else:
        budget = required_budget(config, model)
        write_document(root / INFO, provenance(config, model) | {"created_at_utc": utc_now()})
    spark.dataSource.register(ShardSink)
    source = config["dataset"]["root"]
    done = {x["split"] for x in read_lines(root / SPLITS) if x.get("status") == "complete"}
    files = list_files(spark, source).cache()
    try:
        for name, s in config["dataset"]["splits"].items():
            if name in done:
                continue
            if should_stop():
                raise Stopped(name)
            paths = [x["path"] for x in shard_listing(files, s["config"], s["split"]).collect()]
            if not paths:
                raise FileNotFoundError(f"no shards of {s['config']}/{s['split']} under {source}")
            state = _committed(spark, root, name, s)
            with reporting(lambda: _report(root, state), float(r.get("metrics_interval_seconds", 5))):
                last = _build_split(spark, config, name, s, paths, root, encoder, budget, state, should_stop)
            append_lines(root / SPLITS, [{"split": name, "status": "complete", "last_source_shard": last[0], "last_source_row_index": last[1], "completed_at_utc": utc_now()}])
    finally:
        files.unpersist()
    validate(spark, root)
    records = completed(root)
    stats = {"shards": len(records), **{k: sum(x[k] for x in records) for k in ("examples", "audio_seconds", "semantic_tokens")}, "failures": len({(x["source_shard"], x["source_row_index"]) for x in read_lines(root / FAILURES)})}
    write_document(root / "processing_stats.json", stats | {"completed_at_utc": utc_now()})
    return stats


def _failures(spark: SparkSession, root: Path) -> DataFrame:
    """The dead letters so far, read by the tasks; a line cut short by a crash has no position."""
    path = root / FAILURES
    rows = spark.read.schema(FAILURES_DDL).json(str(path)) if path.exists() else spark.createDataFrame([], FAILURES_DDL)
    return rows.where("source_shard is not null and source_row_index is not null")


def _committed(spark: SparkSession, root: Path, name: str, s: dict) -> dict:
    """Where a split stands: its totals, its failures and when this run took it up."""
    mine = [x for x in completed(root) if x["split"] == name]
    top = max(mine, key=lambda x: x["shard_index"], default=None)
    sums = {k: sum(x[k] for x in mine) for k in ("examples", "audio_seconds", "semantic_tokens")}
    errors = _failures(spark, root).where((F.col("source_config") == s["config"]) & (F.col("source_split") == s["split"])).count()
    cursor = (top["last_source_shard"], top["last_source_row_index"]) if top else None
    began = {"began": time.monotonic(), "seconds_before": sums["audio_seconds"]}
    return {"split": name, "expected_hours": s.get("expected_audio_hours"), "shard_index": top["shard_index"] if top else -1, "cursor": cursor, "errors": errors, **sums, **began}


def _report(root: Path, state: dict) -> None:
    """One line of metrics and one on the console, from what is committed."""
    elapsed = time.monotonic() - state["began"]
    speed = (state["audio_seconds"] - state["seconds_before"]) / elapsed if elapsed > 0 else 0.0
    expected = (state["expected_hours"] or 0) * 3600
    fraction = min(state["audio_seconds"] / expected, 1.0) if expected else None
    eta = max(expected - state["audio_seconds"], 0.0) / speed if expected and speed else None
    line = {k: state[k] for k in ("split", "shard_index", "examples", "audio_seconds", "semantic_tokens", "errors")} | {
        "timestamp_utc": utc_now(), "elapsed_seconds": elapsed, "audio_seconds_per_second": speed, "realtime_factor": 1 / speed if speed else None,
        "progress_fraction": fraction, "eta_seconds": eta, "prefetch_queue_depth": None,
    }
    append_lines(root / METRICS, [line | resource_snapshot(root)])
    share = "n/a" if fraction is None else f"{fraction:.2%}"
    print(f"{state['split']}: {state['shard_index'] + 1} shards, {state['audio_seconds'] / 3600:,.2f} h ({share}), {speed:,.1f} x real time, {state['errors']} failed", file=sys.stderr, flush=True)


@contextmanager
def reporting(report: Callable[[], None], interval: float) -> Iterator[None]:
    """Reports every ``interval`` seconds while the block runs, and once at its end, however it ends."""
    ended = threading.Event()

    def beat() -> None:
        while not ended.wait(interval):
            report()

    thread = threading.Thread(target=beat, name="metrics", daemon=True)
    thread.start()
    try:
        yield
    finally:
        ended.set()
        thread.join()
        report()


def _build_split(spark, config: dict, name: str, s, paths: list[str], root: Path, encoder, budget: float, state: dict, should_stop) -> tuple:
    """Builds a split in slices of source files; returns the last source position looked at.

    A slice begins after the last committed shard, and commits every shard that surely ends within it; rows
    of the shard it breaks off in are read again by the next slice, before any is encoded. Batches and
    shards begin afresh after a shard, so slices don't show in the result. A slice in which no shard ends is
    taken again with twice the files.
    """
    staged, cursor = root / "staging" / name, state["cursor"]
    at_a_time = files = int(config["runtime"].get("files_per_commit", FILES_PER_COMMIT))
    at = min(bisect_left(paths, cursor[0]), len(paths) - 1) if cursor else 0
    place = ["source_shard", "source_row_index"]
    position = F.struct(*place)
    while True:
        if should_stop():
            raise Stopped(name)
        mine = paths[at : at + files + (cursor is not None)]
        final = at + len(mine) == len(paths)
        prepared = _prepare_slice(spark, config, s, name, mine, cursor, encoder, staged)
        narrow = folds.padded_batches(prepared.where("error is null").select("split", *place, "exact_seconds"), "split", place, "exact_seconds", budget)
        narrow = folds.duration_shards(narrow, "split", place, "exact_seconds", float(config["output"]["target_audio_hours_per_shard"]) * 3600)
        narrow.write.mode("overwrite").parquet(f"{staged}-placed")
        narrow = spark.read.parquet(f"{staged}-placed")
        top = narrow.agg(F.max("shard_index")).first()[0]
        if top == 0 and not final:
            files *= 2
            continue
        if top is not None and not final:
            narrow = narrow.where(F.col("shard_index") < top)
            end = narrow.agg(F.max(position).alias("end")).first()["end"]
        else:
            end = prepared.agg(F.max(position).alias("end")).first()["end"]
        if end is not None:
            # the file names alone reach the staged scan as a filter
            upto = (F.col("source_shard") <= end[0]) & ((F.col("source_shard") < end[0]) | (F.col("source_row_index") <= end[1]))
            _commit_slice(spark, config, s, prepared.where(upto), narrow, root, encoder, budget, state, f"{staged}-coded")
            cursor = (end[0], end[1])
        if final:
            for part in ("", "-placed", "-coded"):
                shutil.rmtree(f"{staged}{part}", ignore_errors=True)
            return cursor or (None, None)
        at = at + len(mine) if top is None else bisect_left(paths, cursor[0])
        files = at_a_time


def _prepare_slice(spark, config: dict, s, name: str, paths: list[str], cursor, encoder, staged: Path) -> DataFrame:
    rows = project_source(scan_shards(spark, config["dataset"]["root"], paths, cursor))
    ident = sample_id(F.lit(s["config"]), F.lit(s["split"]), F.col("source_shard"), F.col("source_row_index"))
    prepared = prepare_rows(rows, config["text"]["normalizer"], encoder().sample_rate).withColumn("sample_id", ident)
    prepared.withColumn("split", F.lit(name)).write.mode("overwrite").parquet(str(staged))
    return spark.read.parquet(str(staged))


def _commit_slice(spark, config: dict, s, prepared: DataFrame, narrow: DataFrame, root: Path, encoder, budget: float, state: dict, coded_at: str) -> None:
    """Encodes the placed rows, keeps the failed ones as dead letters, then commits the shards."""
    first, m = state["shard_index"] + 1, config["mimi"]
    narrow = narrow.select("source_shard", "source_row_index", "batch_id", (F.col("shard_index") + first).cast("int").alias("shard_index"))
    placed = prepared.where("error is null").join(narrow, ["source_shard", "source_row_index"])
    coded = encode_rows(placed, encoder, m.get("semantic_codebook_index", 0), budget).select(
        "split", "shard_index", "exact_seconds", "sample_id", "source_id", F.lit(s["config"]).alias("source_config"), F.lit(s["split"]).alias("source_split"), "source_shard", "source_row_index",
        F.col("speaker").alias("speaker_id"), F.col("chapter").alias("chapter_id"), "source_audio_name", "source_sample_rate", "source_num_samples",
        F.col("exact_seconds").cast("float").alias("audio_seconds"), "original_text", "normalized_text", "semantic_codes", F.size("semantic_codes").alias("semantic_length"),
    ).withColumn("violation", violation(m.get("codebook_size", 2048)))
    # rows that break a rule are failures, not the end of the run
    coded.write.mode("overwrite").parquet(coded_at)
    coded = spark.read.parquet(coded_at)
    # a resumed run begins after the shards, so the dead letters among them are written before
    where = ["sample_id", "source_id", "source_shard", "source_row_index", "source_audio_name"]
    bad = prepared.where("error is not null").select(*where, "error")
    bad = bad.unionByName(coded.where("violation is not null").select(*where, F.concat(F.lit("ValueError: "), "violation").alias("error")))
    bad = bad.join(_failures(spark, root).select("source_shard", "source_row_index"), ["source_shard", "source_row_index"], "left_anti")
    failed, now, of = [], utc_now(), {"source_config": s["config"], "source_split": s["split"]}
    for x in bad.orderBy("source_shard", "source_row_index").toLocalIterator():
        kind, _, text = x["error"].partition(": ")
        failed.append({"timestamp_utc": now, **{k: x[k] for k in where}, **of, "error_type": kind, "error_message": text})
        if len(failed) == FAILURE_LINES:
            append_lines(root / FAILURES, failed)
            state["errors"], failed = state["errors"] + len(failed), []
    if failed:
        append_lines(root / FAILURES, failed)
        state["errors"] += len(failed)
    shards = coded.where("violation is null").drop("violation").repartition("split", "shard_index").sortWithinPartitions("split", "shard_index", "source_shard", "source_row_index")
    if not shards.isEmpty():
        shards.write.format("token-shards").option("path", str(root)).mode("append").save()
    mine = [x for x in completed(root) if x["split"] == state["split"]]
    state.update({k: sum(x[k] for x in mine) for k in ("examples", "audio_seconds", "semantic_tokens")})
    state["shard_index"] = max((x["shard_index"] for x in mine), default=-1)


def _has_cache_schema(path: str) -> bool:
    try:
        return pq.read_schema(path).remove_metadata() == CACHE_ARROW
    except pa.ArrowInvalid:
        return False


def validate(spark: SparkSession, root: Path, checksums: bool = True) -> dict:
    """Check every completed shard; ValueError names the first problem in manifest order."""
    records = completed(root)
    if not records:
        raise ValueError("no completed shards")
    manifest = latest(lines_frame(spark, root / MANIFEST, SHARDS_DDL))
    files = [r["path"] for r in records if (root / r["path"]).exists()]
    if not files:
        raise ValueError(f"missing file: {records[0]['path']}")
    base = str(root)

    def inspect(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            at = [f"{base}/{p}" for p in b["path"]]
            yield b.assign(as_agreed=[_has_cache_schema(p) for p in at], actual_sha256=[file_sha256(p) if checksums else None for p in at])

    spread = spark.createDataFrame([(f,) for f in files], "path string").repartition(max(1, min(len(files), 64)))
    inspected = spread.mapInPandas(inspect, "path string, as_agreed boolean, actual_sha256 string").persist()
    if odd := inspected.where("not as_agreed").orderBy("path").first():
        raise ValueError(f"schema differs: {odd['path']}")
    rows = spark.read.parquet(*[str(root / f) for f in files])
    rows = rows.select(F.substring_index(F.col("_metadata.file_path"), "/", -2).alias("path"), F.size("semantic_codes").alias("n_codes"), "semantic_length", "audio_seconds")
    if checksums:
        manifest = manifest.join(inspected.drop("as_agreed"), "path", "left")
    checked = validate_shards(manifest, rows, checksums)
    try:
        if bad := checked.where("problem is not null").orderBy("split", "shard_index").first():
            raise ValueError(f"{bad['problem']}: {bad['path']}")
        return validation_totals(checked).first().asDict()
    finally:
        inspected.unpersist()


def _preflight_of(config: dict, model: Encoder) -> dict:
    """What a preflight was of; a run with anything else needs another."""
    d, m = config["dataset"], config["mimi"]
    return {
        "dataset_id": d.get("id"), "dataset_revision": d.get("revision"), "encoder_identity": model.identity, "sample_rate": model.sample_rate,
        "codebook": m.get("semantic_codebook_index", 0), "batching": "padded audio seconds", "equivalent": True,
    }


def required_budget(config: dict, model: Encoder) -> float:
    """The batch budget that the preflight of this very source and encoder recommends; RuntimeError without one."""
    path = output_root(config) / PREFLIGHT
    if not path.exists():
        raise RuntimeError(f"{path} is missing: run the benchmark command first")
    kept = json.loads(path.read_text(encoding="utf-8"))
    if differ := sorted(k for k, v in _preflight_of(config, model).items() if kept.get(k) != v):
        raise RuntimeError("the preflight was of something else: " + ", ".join(differ))
    return float(kept["recommended_batch_audio_seconds"])


def preflight(spark: SparkSession, config: dict, encoder: Callable[[], Encoder] = HashEncoder, samples: int = 6) -> dict:
    """Encode a few examples alone and together, which must agree before a run may trust batches, and find the batch budget.

    Batches of those examples, repeated, are timed at doubled budgets from min_ to max_batch_audio_seconds.
    """
    require_valid(config)
    name, s = next(iter(config["dataset"]["splits"].items()))
    paths = [x["path"] for x in shard_listing(list_files(spark, config["dataset"]["root"]), s["config"], s["split"]).collect()]
    model, k, r = encoder(), config["mimi"].get("semantic_codebook_index", 0), config["runtime"]
    rows = project_source(scan_shards(spark, config["dataset"]["root"], paths[:1])).orderBy("source_shard", "source_row_index").limit(samples)
    got = [x for x in prepare_rows(rows, config["text"]["normalizer"], model.sample_rate).collect() if x["error"] is None]
    if len(got) < 2:
        raise RuntimeError("two good examples are needed")
    audio = [np.frombuffer(x["samples"], np.float32) for x in got]
    alone = [encode_batch(model, [a], k)[0] for a in audio]
    if differ := [x["source_id"] for x, a, b in zip(got, alone, encode_batch(model, audio, k), strict=True) if a != b]:
        raise RuntimeError("single and batch encodings differ: " + ", ".join(differ))
    seconds = [float(x["exact_seconds"]) for x in got]

    def attempt(budget: float) -> Trial:
        picked = folds.fill_budget(seconds, budget)
        began = time.perf_counter()
        encode_batch(model, [audio[i] for i in picked], k)
        took, length = time.perf_counter() - began, sum(seconds[i] for i in picked)
        share = model.memory_fraction() if hasattr(model, "memory_fraction") else None
        return Trial(budget, "ok", len(picked), length, took, length / took, share)

    high = float(r.get("max_batch_audio_seconds", 600))
    best, trials = search_budget(attempt, min(float(r.get("min_batch_audio_seconds", 5)), high), high, float(r.get("target_vram_fraction", 0.8)))
    found = {"split": name, "examples": len(audio), "recommended_batch_audio_seconds": best, "trials": [asdict(x) for x in trials], "created_at_utc": utc_now()}
    result = _preflight_of(config, model) | found
    write_document(output_root(config) / PREFLIGHT, result)
    return result


__all__ = ["CACHE_DDL", "FAILURES_DDL", "Stopped", "completed", "preflight", "provenance", "require_same", "required_budget", "run", "stop_flag", "validate"]
