"""Shared storage, native running totals and vectorised word hashing.

Words are always ``[^\\x20\\x09-\\x0D]+`` over the UTF-8 bytes of a whole text; those
separators never occur inside a multi-byte character, so splitting bytes is exact.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..storage import stored

WORD = r"[^\x20\x09-\x0D]+"
SLICE_BYTES = 1 << 21


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once into the shared folder and read it back, which cuts its lineage."""
    return stored(df, name)


def bounded_tiles(n_rows: int, rows_per_tile: int = 2048) -> int:
    """Bits of a hash that split ``n_rows`` into tiles of about ``rows_per_tile``."""
    return max(0, math.ceil(math.log2(max(1, n_rows / rows_per_tile))))


def seeded_hash(text: Column, seed: int) -> Column:
    """60 bits of md5, so that any SQL engine can follow the order: not negative."""
    return F.conv(F.substring(F.md5(F.concat(F.lit(f"{seed}:"), text).cast("binary")), 1, 15), 16, 10).cast("long")


def hash_tile(h: Column, bits: int) -> Column:
    """The top ``bits`` of 60 hash bits, so tiles are ordered as the hash is."""
    return F.shiftright(h, 60 - bits) if bits else F.lit(0).cast("long")


def hash60(h: Column) -> Column:
    """The upper 60 bits of a 64-bit hash, not negative."""
    return F.shiftrightunsigned(h, 4)


def running_base(tiles: DataFrame, group: list[str], tile: str, value: str, out: str, per_block: int = 4096) -> DataFrame:
    """Adds the sum of ``value`` over the smaller tiles of the same group, null being a group of its own.

    ``tiles`` has a row per group and tile (an integer from 0). Sums run within blocks of tiles, then over
    the blocks' totals, so one task sees no more than a block's tiles, or a total per block.
    """
    before = lambda *by: Window.partitionBy(*by).rowsBetween(Window.unboundedPreceding, -1)
    # read twice below, so written once
    tiles = materialize(tiles, "tile-totals")
    block = F.expr(f"{tile} div {per_block}L").alias("_block")
    totals = tiles.groupBy(*group, block).agg(F.sum(value).alias("_total"))
    at = F.coalesce(F.sum("_total").over(before(*group).orderBy("_block")), F.lit(0))
    totals = totals.select(*[F.col(g).alias(f"_of_{g}") for g in group], F.col("_block").alias("_of"), at.alias("_at"))
    inside = tiles.select("*", block).withColumn("_in", F.coalesce(F.sum(value).over(before(*group, "_block").orderBy(tile)), F.lit(0)))
    same = F.col("_block") == F.col("_of")
    for g in group:
        same = same & F.col(g).eqNullSafe(F.col(f"_of_{g}"))
    return inside.hint("merge").join(totals, same).select(*tiles.columns, (F.col("_in") + F.col("_at")).cast("long").alias(out))


# ---------------------------------------------------------------- words as arrays

_WS = np.zeros(256, bool)
_WS[[9, 10, 11, 12, 13, 32]] = True
_LOW = np.arange(256, dtype=np.uint8)
_LOW[65:91] += 32
_BASE = np.uint64(0x9E3779B97F4A7C15)
_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective finaliser on 64-bit words."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * _M1
        x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


def powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """base**i and base**-i modulo 2**64 for i up to n; base is odd."""
    have = _powers.get(base)
    if have is None or len(have[0]) <= n:
        inv = pow(base, -1, 1 << 64)
        both = []
        for b in (base, inv):
            a = np.full(max(n + 1, 1 << 16), b, np.uint64)
            a[0] = 1
            both.append(np.cumprod(a, dtype=np.uint64))
        _powers[base] = have = (both[0], both[1])
    return have


#: words up to this many bytes are hashed in arrays, eight bytes at a time; longer ones are few
SHORT_WORD = 64
_HEAD = np.array([0] + [(1 << 8 * i) - 1 for i in range(1, 9)], np.uint64)


def eight_bytes(data: np.ndarray) -> np.ndarray:
    """At each byte, it and the seven after it (0 past the end) as one number, without a copy for each."""
    padded = np.zeros(len(data) + 8, np.uint8)
    padded[: len(data)] = data
    return np.ndarray((len(data) + 1,), "<u8", padded, strides=(1,))


def word_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hashes of byte ranges: a chain of mixed eight-byte parts, or BLAKE2b of a long range.

    Ranges of up to eight bytes have distinct hashes if their lengths are equal; no algebraic structure of the
    bytes carries over to the hash.
    """
    eight, size = eight_bytes(data), end - start
    h = mix64(size.astype(np.uint64) + _BASE)
    at, part = np.arange(len(start)), start
    for k in range(0, SHORT_WORD, 8):
        if k:
            at = at[size[at] > k]
            part = start[at] + k
        if not len(at):
            break
        with np.errstate(over="ignore"):
            h[at] = mix64((h[at] ^ (eight[part] & _HEAD[np.minimum(size[at] - k, 8)])) * _M2)
    for i in np.flatnonzero(size > SHORT_WORD).tolist():
        h[i] = int.from_bytes(hashlib.blake2b(data[start[i] : end[i]].tobytes(), digest_size=8).digest(), "little")
    return h


def exact_ids(data: np.ndarray, start: np.ndarray, end: np.ndarray, h: np.ndarray) -> np.ndarray:
    """A number for each byte range, equal exactly where the bytes are; hashes only speed it up."""
    _, first, ids = np.unique(h, return_index=True, return_inverse=True)
    lead, size = first[ids], end - start
    same = size == size[lead]
    eight = eight_bytes(data)
    at = np.flatnonzero(same & (np.arange(len(start)) != lead))
    for k in range(0, SHORT_WORD, 8):
        at = at[size[at] > k]
        if not len(at):
            break
        head = _HEAD[np.minimum(size[at] - k, 8)]
        same[at] &= (eight[start[at] + k] & head) == (eight[start[lead[at]] + k] & head)
    for i in at[size[at] > SHORT_WORD].tolist():
        j = lead[i]
        same[i] &= bool(np.array_equal(data[start[i] : end[i]], data[start[j] : end[j]]))
    if same.all():
        return ids
    seen: dict[bytes, int] = {}
    return np.array([seen.setdefault(data[a:b].tobytes(), len(seen)) for a, b in zip(start.tolist(), end.tolist(), strict=True)], np.int64)


class Words:
    """Words of a run of texts: byte ranges, 64-bit hashes, and each text's range of words."""

    def __init__(self, data: np.ndarray, off: np.ndarray, lower: bool = False, core: np.ndarray | None = None, latin: bool = False):
        """lower: hash A-Z as a-z; latin: also the capitals of Latin-1, two bytes in UTF-8.

        core: a table of bytes; words then lose what is before their first and after their last such byte, or vanish."""
        self.data, self.off, n = data, off, len(data)
        solid = ~_WS[data]
        before = np.zeros(n, bool)
        before[1:] = solid[:-1]
        first = off[:-1][off[:-1] < off[1:]]
        before[first] = False
        self.start = np.flatnonzero(solid & ~before)
        after = np.zeros(n, bool)
        after[:-1] = solid[1:]
        last = off[1:][off[:-1] < off[1:]] - 1
        after[last] = False
        self.end = np.flatnonzero(solid & ~after) + 1
        if core is not None:
            at = np.flatnonzero(core[data])
            a, b = np.searchsorted(at, self.start), np.searchsorted(at, self.end)
            some = a < b
            self.whole_end = self.end[some]
            self.start, self.end = at[a[some]], at[b[some] - 1] + 1
        #: text i has the words from first[i] to first[i + 1]
        self.first = np.searchsorted(self.start, off)
        self.n = np.diff(self.first)
        folded = _LOW[data] if lower else data
        if latin and n:
            second = np.zeros(n, bool)
            second[1:] = data[:-1] == 0xC3
            folded = folded + np.uint8(32) * (second & (data >= 0x80) & (data <= 0x9E) & (data != 0x97))
        self.folded = folded
        self.hash = word_hashes(folded, self.start, self.end)

    def exact(self) -> np.ndarray:
        """A number for each word, equal exactly where the words are."""
        return exact_ids(self.folded, self.start, self.end, self.hash)

    @property
    def text_end(self) -> np.ndarray:
        """For each word, the index past the last word of its text."""
        return np.repeat(self.first[1:], self.n)

    def text_of(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.n)), self.n)


def text_slices(batch: pa.RecordBatch, text: str, most: int = SLICE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, last row, bytes, offsets) over runs of rows of about ``most`` bytes; null is empty."""
    col = batch.column(batch.schema.get_field_index(text)).cast(pa.large_string()).fill_null("")
    n = len(col)
    if not n:
        return
    _, offsets, data = col.buffers()
    off = np.frombuffer(offsets, np.int64)[col.offset : col.offset + n + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    a = 0
    while a < n:
        b = max(a + 1, int(np.searchsorted(off, off[a] + most, "right")) - 1)
        b = min(b, n)
        yield a, b, raw[off[a] : off[b]], off[a : b + 1] - off[a]
        a = b


def shingles(w: Words, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all k-word shingles and each text's range of them; a text of 1 to k-1 words has one, of all its words."""
    n = len(w.start)
    end, begin = w.text_end, np.repeat(w.first[:-1], w.n)
    at = np.arange(n)
    keep = np.flatnonzero((end - at >= k) | (at == begin))
    limit = end[keep]
    h = np.full(len(keep), np.uint64(k), np.uint64)
    for j in range(k):
        i = keep + j
        inside = i < limit
        v = np.where(inside, w.hash[np.minimum(i, max(n - 1, 0))], np.uint64(0x5851F42D4C957F2D))
        h = mix64(h * np.uint64(0x9FB21C651E98DF25) + v)
    return h, np.searchsorted(keep, w.first)


def exact_shingles(w: Words, k: int) -> tuple[np.ndarray, np.ndarray]:
    """As ``shingles``, but numbers that are equal exactly where the words are."""
    token, n = w.exact(), len(w.start)
    end, begin, at = w.text_end, np.repeat(w.first[:-1], w.n), np.arange(n)
    keep = np.flatnonzero((end - at >= k) | (at == begin))
    kinds = int(token.max()) + 2 if n else 1
    rank = token[keep]
    for j in range(1, k):
        i = keep + j
        after = np.where(i < end[keep], token[np.minimum(i, n - 1)], kinds - 1)
        rank = np.unique(rank * kinds + after, return_inverse=True)[1]
    return rank, np.searchsorted(keep, w.first)


def list_column(values: np.ndarray, offsets: np.ndarray, kind: pa.DataType) -> pa.Array:
    """An Arrow list column from flat values and int offsets."""
    return pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(values, kind))
