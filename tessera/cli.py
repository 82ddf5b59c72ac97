"""Commands: run, benchmark, status, validate, publish. Exit 0; 130 when stopped; 2 for what the user can mend."""

from __future__ import annotations

import argparse
import json
import os
import sys
from pathlib import Path

from .config import read_config, require_valid


def _session():
    from pyspark.sql import SparkSession

    return SparkSession.builder.appName("tessera").config("spark.sql.session.timeZone", "UTC").config("spark.speculation", "false").getOrCreate()


def _parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="tessera", description="Build, check and publish a speech-token dataset.")
    c = p.add_subparsers(dest="command", required=True)
    for name in ("run", "benchmark"):
        c.add_parser(name).add_argument("--config", required=True)
    c.choices["run"].add_argument("--resume", action="store_true")
    for name in ("status", "validate", "publish"):
        c.add_parser(name).add_argument("--output", required=True, type=Path)
    c.choices["validate"].add_argument("--skip-checksums", action="store_true")
    c.choices["publish"].add_argument("--repo", default="")
    c.choices["publish"].add_argument("--target", type=Path, help="a folder that stands for the remote repository")
    return p


def status_text(spark, root: Path) -> str:
    """A table by split and the last metrics record."""
    from pyspark.sql import functions as F

    from .build import INFO, METRICS
    from .operators.manifest import latest, status_summary
    from .schema import SHARDS_DDL
    from .sources.jsonl import lines_frame, read_lines
    from .sources.sink import MANIFEST

    info = json.loads((root / INFO).read_text(encoding="utf-8")) if (root / INFO).exists() else {}
    hours = [(k, None if h is None else float(h)) for k, h in info.get("expected_audio_hours_by_split", {}).items()]
    expected = spark.createDataFrame(hours, "split string, expected_hours double")
    rows = status_summary(latest(lines_frame(spark, root / MANIFEST, SHARDS_DDL)), F.broadcast(expected)).collect()
    text = [f"{r['split']}: {r['shards']:,} shards, {r['examples']:,} examples, {r['hours']:,.2f} h, {'n/a' if r['percent'] is None else format(r['percent'], '.2f') + '%'}, {r['semantic_tokens']:,} tokens" for r in rows]
    metrics = read_lines(root / METRICS)
    return "\n".join([*text, json.dumps(metrics[-1], sort_keys=True)] if metrics else text)


def main(argv: list[str] | None = None) -> int:
    a = _parser().parse_args(argv)
    try:
        if a.command in ("run", "benchmark"):
            config = require_valid(read_config(a.config))
            from . import build

            if a.command == "benchmark":
                print(json.dumps(build.preflight(_session(), config), indent=2, sort_keys=True))
                return 0
            spark = _session()
            with build.stop_flag() as stop:
                try:
                    print(json.dumps(build.run(spark, config, a.resume, should_stop=stop), indent=2, sort_keys=True))
                except build.Stopped:
                    return 130
            return 0
        if a.command == "status":
            print(status_text(_session(), a.output))
        elif a.command == "validate":
            from .build import validate

            print(json.dumps(validate(_session(), a.output, not a.skip_checksums), indent=2, sort_keys=True))
        else:
            if not os.environ.get("HF_TOKEN"):
                raise RuntimeError("HF_TOKEN is not set")
            if a.target is None:
                raise RuntimeError("no remote store is configured; give --target")
            from .publish import FolderTarget, publish

            print(json.dumps(publish(_session(), a.output, FolderTarget(a.target), a.repo), indent=2, sort_keys=True))
        return 0
    except (OSError, RuntimeError, ValueError) as e:
        print(f"error: {e}", file=sys.stderr)
        return 2


if __name__ == "__main__":
    sys.exit(main())
