"""JSON lines and documents: small append-only side files, kept by the driver."""

from __future__ import annotations

import json
import os
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_lines(path: str | Path) -> list[dict]:
    """Objects of a file, none if it is missing. Blank lines are skipped; a last line cut short by a crash
    (no line end) is dropped; any other malformed line raises ValueError with its number."""
    p = Path(path)
    if not p.exists():
        return []
    text = p.read_text(encoding="utf-8")
    lines = text.split("\n")
    out = []
    for n, line in enumerate(lines, 1):
        if line.strip():
            try:
                out.append(json.loads(line))
            except json.JSONDecodeError as e:
                if n == len(lines) and not text.endswith("\n"):
                    break
                raise ValueError(f"{p}:{n}: {e}") from e
    return out


def append_lines(path: str | Path, rows: list[dict]) -> None:
    """Append and force to disk. What a crash left of a last line goes first."""
    p = Path(path)
    p.parent.mkdir(parents=True, exist_ok=True)
    if p.exists() and (data := p.read_bytes()) and not data.endswith(b"\n"):
        with p.open("r+b") as f:
            f.truncate(data.rfind(b"\n") + 1)
    with p.open("a", encoding="utf-8") as f:
        f.writelines(json.dumps(r, sort_keys=True, ensure_ascii=False) + "\n" for r in rows)
        f.flush()
        os.fsync(f.fileno())


def write_document(path: str | Path, value: dict) -> None:
    p = Path(path)
    p.parent.mkdir(parents=True, exist_ok=True)
    part = p.with_suffix(p.suffix + ".part")
    part.write_text(json.dumps(value, indent=2, sort_keys=True, ensure_ascii=False) + "\n", encoding="utf-8")
    os.replace(part, p)


def lines_frame(spark: SparkSession, path: str | Path, ddl: str) -> DataFrame:
    """The file as a table with line_no, for queries over manifests."""
    names = [c.split()[0] for c in ddl.split(", ")]
    rows = [(n, *(r.get(k) for k in names)) for n, r in enumerate(read_lines(path))]
    return spark.createDataFrame(rows, f"line_no bigint, {ddl}")


def parse_lines(lines: DataFrame, ddl: str, line_col: str = "line", number_col: str = "line_no") -> DataFrame:
    """JSON lines of a DataFrame as columns; blank lines are skipped, malformed ones raise."""
    parsed = F.from_json(F.col(line_col), ddl, {"mode": "FAILFAST"})
    return lines.where(F.trim(F.col(line_col)) != "").select(number_col, parsed.alias("r")).select(number_col, "r.*")
