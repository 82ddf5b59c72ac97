"""Publication: every shard once, with a receipt; a target is anything that stores bytes by name."""

from __future__ import annotations

import json
import os
import shutil
from pathlib import Path
from typing import Protocol

from pyspark.sql import SparkSession

from .build import INFO, SPLITS, completed, validate
from .sources.jsonl import append_lines, read_lines
from .sources.sink import utc_now


class Target(Protocol):
    private: bool

    def get(self, name: str) -> bytes | None: ...
    def put(self, files: dict[str, Path | bytes]) -> None: ...


class FolderTarget:
    """A local folder that stands for a remote repository."""

    private = True

    def __init__(self, root: Path):
        self.root = Path(root)

    def get(self, name: str) -> bytes | None:
        p = self.root / name
        return p.read_bytes() if p.exists() else None

    def put(self, files: dict[str, Path | bytes]) -> None:
        for name, what in files.items():
            p = self.root / name
            p.parent.mkdir(parents=True, exist_ok=True)
            part = p.with_name(p.name + ".part")
            part.write_bytes(what) if isinstance(what, bytes) else shutil.copyfile(what, part)
            os.replace(part, p)


def receipt_name(path: str) -> str:
    return "_receipts/" + path.replace("/", "--") + ".json"


def publish(spark: SparkSession, root: Path, target: Target, repo_id: str = "") -> dict:
    """Upload what has no receipt, refuse what has another one, and check that all is there."""
    if not os.environ.get("HF_TOKEN"):
        raise RuntimeError("HF_TOKEN is not set")
    if not target.private:
        raise RuntimeError("the target is not private")
    validate(spark, root)
    expected = set(json.loads((root / INFO).read_text(encoding="utf-8"))["expected_audio_hours_by_split"])
    done = {r["split"] for r in read_lines(root / SPLITS) if r.get("status") == "complete"}
    if expected - done:
        raise RuntimeError("incomplete splits: " + ", ".join(sorted(expected - done)))
    up = skipped = 0
    records = completed(root)
    for r in records:
        kept = target.get(receipt_name(r["path"]))
        if kept is not None:
            if json.loads(kept)["sha256"] != r["sha256"]:
                raise RuntimeError(f"published with another checksum: {r['path']}")
            skipped += 1
            continue
        receipt = {"schema_version": "1", "repo_id": repo_id, **{k: r[k] for k in ("path", "sha256", "examples", "audio_seconds", "semantic_tokens")}, "published_at_utc": utc_now()}
        target.put({r["path"]: root / r["path"], receipt_name(r["path"]): json.dumps(receipt, sort_keys=True).encode()})
        append_lines(root / "manifests/published.jsonl", [receipt])
        up += 1
    meta = [INFO, "processing_stats.json", "benchmark.json", "manifests/shards.jsonl", SPLITS, "manifests/failures.jsonl"]
    target.put({n: root / n for n in meta if (root / n).exists()})
    if absent := [r["path"] for r in records if target.get(receipt_name(r["path"])) is None]:
        raise RuntimeError(f"no receipt for {absent[0]}")
    return {"repo_id": repo_id, "uploaded_shards": up, "skipped_shards": skipped, **{k: sum(r[k] for r in records) for k in ("examples", "audio_seconds", "semantic_tokens")}}
