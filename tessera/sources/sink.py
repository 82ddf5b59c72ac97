"""Shard sink: a Python data source that writes exactly typed Parquet shards under an append-only manifest.

Tasks write one temporary file per shard, named by task attempt, reread it and hash it. Only the driver's
commit renames files and appends the manifest; a file that the manifest doesn't name isn't a shard, so
what a crash leaves between renaming and appending is replaced by the next run. The output folder is one
that driver and executors share.
"""

from __future__ import annotations

import hashlib
import os
import uuid
from collections.abc import Iterator
from dataclasses import dataclass
from datetime import UTC, datetime
from pathlib import Path

import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

from ..schema import CACHE_ARROW
from .jsonl import append_lines, read_lines

MANIFEST = "manifests/shards.jsonl"


def utc_now() -> str:
    return datetime.now(UTC).isoformat(timespec="microseconds")


def file_sha256(path: str | Path) -> str:
    h = hashlib.sha256()
    with open(path, "rb") as f:
        while part := f.read(8 << 20):
            h.update(part)
    return h.hexdigest()


def write_checked(table: pa.Table, path: Path) -> str:
    """Write zstd Parquet, reread it, and return its SHA-256."""
    pq.write_table(table, path, compression="zstd", use_dictionary=True)
    f = pq.ParquetFile(path)
    if f.schema_arrow.remove_metadata() != table.schema.remove_metadata() or f.metadata.num_rows != table.num_rows:
        raise OSError(f"{path} was not written as given")
    with path.open("rb") as raw:
        os.fsync(raw.fileno())
    return file_sha256(path)


@dataclass
class ShardsWritten(WriterCommitMessage):
    shards: list[tuple[str, str, dict]]


class ShardWriter(DataSourceArrowWriter):
    def __init__(self, root: str):
        self.root = root

    def write(self, iterator: Iterator[pa.RecordBatch]) -> ShardsWritten:
        """Rows come sorted by (split, shard_index) and source position; each shard's rows are in one task."""
        done: list[tuple[str, str, dict]] = []
        at, parts = None, []

        def flush() -> None:
            if at is None:
                return
            split, index = at
            table = pa.Table.from_batches(parts)
            cache = table.select(CACHE_ARROW.names).cast(CACHE_ARROW)
            final = f"{split}/{split}-{index:05d}.parquet"
            part = f"{final}.{uuid.uuid4().hex}.tmp"
            (Path(self.root) / split).mkdir(parents=True, exist_ok=True)
            sha = write_checked(cache, Path(self.root) / part)
            seconds = table.column("exact_seconds").to_pylist()
            done.append((part, final, {
                "split": split, "shard_index": index, "path": final, "status": "complete", "examples": cache.num_rows, "audio_seconds": sum(seconds),
                "semantic_tokens": sum(cache.column("semantic_length").to_pylist()), "sha256": sha, "source_shards": sorted(set(cache.column("source_shard").to_pylist())),
                "last_source_shard": cache.column("source_shard")[-1].as_py(), "last_source_row_index": cache.column("source_row_index")[-1].as_py(),
            }))

        for batch in iterator:
            split, index = batch.column(batch.schema.get_field_index("split")), batch.column(batch.schema.get_field_index("shard_index"))
            begin = 0
            keys = list(zip(split.to_pylist(), index.to_pylist(), strict=True))
            for i in range(1, len(keys) + 1):
                if i == len(keys) or keys[i] != keys[begin]:
                    if keys[begin] != at:
                        flush()
                        at, parts = keys[begin], []
                    parts.append(batch.slice(begin, i - begin))
                    begin = i
        flush()
        return ShardsWritten(done)

    def commit(self, messages: list[ShardsWritten | None]) -> None:
        root = Path(self.root)
        known = {r["path"] for r in read_lines(root / MANIFEST) if r.get("status") == "complete"}
        shards = sorted((s for m in messages if m for s in m.shards), key=lambda s: (s[2]["split"], s[2]["shard_index"]))
        if taken := [final for _, final, _ in shards if final in known]:
            raise FileExistsError(f"already in the manifest: {taken[0]}")
        for part, final, record in shards:
            os.replace(root / part, root / final)
            append_lines(root / MANIFEST, [record | {"completed_at_utc": utc_now()}])

    def abort(self, messages: list[ShardsWritten | None]) -> None:
        for m in messages:
            for part, _, _ in m.shards if m else []:
                (Path(self.root) / part).unlink(missing_ok=True)


class ShardSink(DataSource):
    """``df.write.format("token-shards").option("path", root).mode("append").save()``; columns of the cache, and split, shard_index, exact_seconds."""

    @classmethod
    def name(cls) -> str:
        return "token-shards"

    def writer(self, schema, overwrite: bool) -> ShardWriter:
        if overwrite:
            raise ValueError("shards are only appended")
        return ShardWriter(self.options["path"])
