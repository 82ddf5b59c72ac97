"""Transcript normalisation. Versions are looked up once, before a job starts."""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

# fixed values: code points that count as an apostrophe (left and right single quotes, modifier apostrophe)
APOSTROPHES = "‘’ʼ"
_FOLD = str.maketrans({c: "'" for c in APOSTROPHES})
# what str.isspace knows and Java's \s with (?U) doesn't: U+001C to U+001F
_SPACES = r"(?U)[\s\x1c-\x1f]+"


def english_v1(text: str) -> str:
    """NFKC, plain apostrophes, lower case, single spaces; punctuation stays."""
    return re.sub(r"\s+", " ", unicodedata.normalize("NFKC", text).translate(_FOLD).lower()).strip()


@F.pandas_udf(StringType())
def _nfkc_lower(s: pd.Series) -> pd.Series:
    # both steps follow Python's Unicode tables, so both are here; ASCII needs no normal form
    return s.map(lambda x: x if x is None else (x if x.isascii() else unicodedata.normalize("NFKC", x).translate(_FOLD)).lower())


def _english_v1_column(text: Column) -> Column:
    return F.trim(F.regexp_replace(_nfkc_lower(text), _SPACES, " "))


_VERSIONS: dict[str, tuple[Callable[[str], str], Callable[[Column], Column]]] = {"english_v1": (english_v1, _english_v1_column)}


def _version(version: str):
    if version not in _VERSIONS:
        raise ValueError(f"unknown normalizer version: {version!r}")
    return _VERSIONS[version]


def normalize(text: str, version: str = "english_v1") -> str:
    return _version(version)[0](text)


def normalized(text: Column, version: str = "english_v1") -> Column:
    """The column form; fails here, not in a task, when the version is unknown."""
    return _version(version)[1](text)
