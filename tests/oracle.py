"""Runs SQL in DuckDB over the tables of a folder and compares rows."""

import math
from pathlib import Path

import duckdb


def plain(v):
    if isinstance(v, (list, tuple)):
        return tuple(plain(x) for x in v)
    if isinstance(v, float) and math.isnan(v):
        return None
    return v


def rows_of(table) -> list[tuple]:
    names = sorted(table.column_names)
    cols = [table.column(n).to_pylist() for n in names]
    return sorted((tuple(plain(x) for x in r) for r in zip(*cols, strict=True)), key=repr)


def run_sql(sql: str, sf_dir: str):
    con = duckdb.connect()
    for f in Path(sf_dir).glob("*.parquet"):
        con.sql(f"create view {f.stem} as select * from '{f}'")
    return con.sql(sql).to_arrow_table()


def check(spark, queries, oracles, name: str, sf_dir: str) -> None:
    got, want = queries[name](spark, sf_dir).toArrow(), run_sql(oracles[name], sf_dir)
    assert sorted(got.column_names) == sorted(want.column_names)
    assert rows_of(got) == rows_of(want)
