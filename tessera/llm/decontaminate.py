"""Benchmark decontamination by template canonicalisation.

Texts become templates: numbers, names and units turn into typed placeholders, other words are lower-cased
(ASCII and Latin-1 letters) without outer punctuation. Windows of template tokens are hashed and joined with those of the benchmark, so
a question with other numbers or names still meets its template. A capitalised word that opens a sentence
may be a name or not, so its windows have both forms. Per document and item, the values in the
slots must follow one consistent substitution; an item counts as leaked once enough of its windows do.

Document windows pass a bit map of the benchmark's window hashes first. Its size is fixed, whatever the
benchmark's; a larger benchmark lets more windows through to the join, which alone decides.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Words, list_column, mix64, text_slices

MAP_BITS = 22
# fixed values: units of measure that follow a number
UNITS = (
    "mm cm m km in inch inches ft foot feet yd yard yards mi mile miles mg g kg t lb lbs oz pound pounds ounce ounces ton tons "
    "ml cl dl l liter liters litre litres gal gallon gallons s sec secs second seconds min mins minute minutes h hr hrs hour hours "
    "day days week weeks month months year years eur usd gbp dollar dollars euro euros cent cents percent % ms kb mb gb tb w kw v a "
    "hz khz mhz ghz c f k j kj cal kcal mph kmh"
)
_CORE = np.zeros(256, bool)
_CORE[48:58] = _CORE[65:91] = _CORE[97:123] = _CORE[128:] = _CORE[ord("%")] = True
_DIGIT, _UPPER, _NUMERIC, _STOP = (np.zeros(256, bool) for _ in range(4))
_DIGIT[48:58] = _UPPER[65:91] = _NUMERIC[48:58] = True
_NUMERIC[[44, 46, 47, 58, 45]] = True
_STOP[[33, 46, 63, 58, 10]] = True
# fixed values: words that open a sentence and are no names
FUNCTION_WORDS = (
    "a an the this that these those it its he she they we you i his her their our your my there here if when while where who whom whose which what why how "
    "is are was were do does did has have had can could would should must and or but so then as at by for from in into of on to with without after before "
    "because since until during each every all some any no not both one two many much more most"
)
NUMBER, NAME, UNIT = (np.uint64(x) for x in (0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3))
EXACT = np.uint64(0x589965CC75374CC3)

_UNIT_SET = frozenset(UNITS.encode().split())
_UNIT_MOST = max(map(len, _UNIT_SET))


def _hashes(words: str) -> np.ndarray:
    raw = np.frombuffer(words.encode(), np.uint8)
    return np.unique(Words(raw, np.array([0, len(raw)]), lower=True, core=_CORE).hash)


def split_units(w: Words, data: np.ndarray, off: np.ndarray) -> tuple[Words, np.ndarray]:
    """Words and bytes with a space between a number and a unit or % that is glued to it."""
    starts = np.flatnonzero(_DIGIT[data[w.start]])
    other = np.append(np.flatnonzero(~_NUMERIC[data]), len(data))
    cut, end = other[np.searchsorted(other, w.start[starts])], w.end[starts]
    near = (cut < end) & (end - cut <= _UNIT_MOST)
    cut = np.array([a for a, b in zip(cut[near].tolist(), end[near].tolist(), strict=True) if data[a:b].tobytes().lower() in _UNIT_SET], np.int64)
    if not len(cut):
        return w, data
    data, off = np.insert(data, cut, np.uint8(32)), off + np.searchsorted(cut, off)
    return Words(data, off, lower=True, core=_CORE, latin=True), data


def templates(data: np.ndarray, off: np.ndarray) -> tuple[Words, np.ndarray, np.ndarray, np.ndarray]:
    """Words, their template tokens, which of them are slots, and which may be names as they open a sentence in upper case."""
    w, data = split_units(Words(data, off, lower=True, core=_CORE, latin=True), data, off)
    n = len(w.start)
    token, slot = w.hash.copy(), np.zeros(n, bool)
    if not n:
        return w, token, slot, slot.copy()
    count = lambda table: (c := np.concatenate([[0], np.cumsum(table[data], dtype=np.int32)]))[w.end] - c[w.start]
    length = w.end - w.start
    digits = count(_DIGIT)
    number = (digits > 0) & (count(_NUMERIC) == length)
    # a name starts in upper case only at its first letter, and doesn't start a sentence, a line or the text
    stops = np.concatenate([[0], np.cumsum(_STOP[data], dtype=np.int32)])
    opens = np.ones(n, bool)
    opens[1:] = stops[w.start[1:]] > stops[w.end[:-1]]
    opens[w.first[:-1][w.n > 0]] = True
    upper = _UPPER[data[w.start]] | ((data[w.start] == 0xC3) & (data[np.minimum(w.start + 1, len(data) - 1)] < 0x9F))
    named = upper & (count(_UPPER) <= 1) & ~number & (length > 1)
    name, maybe = named & ~opens, named & opens & ~np.isin(w.hash, _hashes(FUNCTION_WORDS))
    follows = np.zeros(n, bool)
    follows[1:] = number[:-1]
    follows[w.first[:-1][w.n > 0]] = False
    unit = follows & np.isin(w.hash, _hashes(UNITS)) & ~number
    token[name], token[number], token[unit] = NAME, NUMBER, UNIT
    return w, token, name | number | unit, maybe & ~unit


def template_windows(data: np.ndarray, off: np.ndarray, k: int, literals: int, shapes: list[tuple[int, bool]] | None = None) -> tuple[np.ndarray, ...]:
    """text, window, hash, slot values (windows x k, 0 where literal), length and exactness of windows with enough literals.

    A window with words that may be names has a second hash with them as names; both have the first as their window.

    Without ``shapes`` texts are items: one of fewer than k words has one window, of all of them, and one without
    a window of enough literals has windows of its exact words instead. Otherwise all windows of these lengths, exact or not.
    """
    w, token, slot, maybe = templates(data, off)
    n = len(token)
    end, at, text_of = w.text_end, np.arange(n), w.text_of()
    seen = np.concatenate([[0], np.cumsum(maybe)])
    parts = []

    def hashed(keep: np.ndarray, size: int, token: np.ndarray, slot: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        h, plain = np.full(len(keep), np.uint64(k)), np.zeros(len(keep), np.int64)
        values = np.zeros((len(keep), k), np.uint64)
        for j in range(k):
            i = np.minimum(keep + j, n - 1)
            h = mix64(h * np.uint64(0x9FB21C651E98DF25) + (token[i] if j < size else np.uint64(0x2545F4914F6CDD1D)))
            if j < size:
                values[:, j] = np.where(slot[i], w.hash[i], np.uint64(0))
                plain += ~slot[i]
        # short texts need literals in proportion
        return h, values, plain >= np.minimum(literals, np.maximum(1, (end[keep] - keep if size == k else size) // 2))

    def add(keep: np.ndarray, size: int, exact: bool) -> None:
        if exact:
            h = mix64(hashed(keep, size, w.hash, np.zeros(n, bool))[0] ^ EXACT)
            parts.append((text_of[keep], h, h, np.zeros((len(keep), k), np.uint64), size, True))
            return
        h, values, enough = hashed(keep, size, token, slot)
        parts.append((text_of[keep[enough]], h[enough], h[enough], values[enough], size, False))
        also = np.flatnonzero(seen[keep + size] > seen[keep])
        h2, values2, enough2 = hashed(keep[also], size, np.where(maybe, NAME, token), slot | maybe)
        parts.append((text_of[keep[also[enough2]]], h[also[enough2]], h2[enough2], values2[enough2], size, False))

    if shapes is not None:
        for size, exact in shapes:
            add(np.flatnonzero(end - at >= size), size, exact)
    else:
        for size in range(1, k + 1):
            keep = np.flatnonzero((end - at >= size) & (np.minimum(w.n, k)[text_of] == size))
            add(keep, size, False)
            found = np.zeros(len(w.n), bool)
            found[parts[-1][0]] = found[parts[-2][0]] = True
            add(keep[~found[text_of[keep]]], size, True)
    sizes, exact = (np.repeat([x[c] for x in parts], [len(x[0]) for x in parts]) for c in (4, 5))
    return *(np.concatenate([x[c] for x in parts]) for c in range(4)), sizes, exact


def consistent(pairs: list[tuple[list[int], list[int]]]) -> int:
    """How many matched windows (slot values in the item, in the text) follow one substitution in both directions."""
    votes: dict[tuple[int, int], int] = {}
    for a, b in pairs:
        for v in set(zip(a, b, strict=True)):
            votes[v] = votes.get(v, 0) + 1
    to: dict[int, int] = {}
    back: dict[int, int] = {}
    for (x, y), _ in sorted(votes.items(), key=lambda t: (-t[1], t[0][0] != t[0][1], t[0])):
        if x not in to and y not in back:
            to[x], back[y] = y, x
    return sum(all(to.get(x) == y for x, y in zip(a, b, strict=True)) for a, b in pairs)


def find_leaks(
    docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = 6, literals: int = 3, share: float = 0.4
) -> DataFrame:
    """Pairs (doc_id, item_id) where at least ``share`` of the item's distinct windows occur consistently in the text.

    Also n_windows (of the item), n_matched, n_consistent and verbatim (no slot value differs). Null or blank
    texts and items, and null ids, match nothing; items or documents that repeat an id count as one; empty
    tables give no rows. Only id and text columns are read.
    """

    def windows(keep_bits: np.ndarray | None, shapes: list[tuple[int, bool]] | None = None):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for a, b, data, off in text_slices(batch, "t"):
                    text, win, h, values, size, exact = template_windows(data, off, window, literals, shapes)
                    if keep_bits is not None:
                        bit = (h >> np.uint64(64 - MAP_BITS)).astype(np.int64)
                        hit = (keep_bits[bit >> 6] >> (bit & 63).astype(np.uint64)) & np.uint64(1) > 0
                        text, win, h, values, size, exact = text[hit], win[hit], h[hit], values[hit], size[hit], exact[hit]
                    used = values != 0
                    slots = np.concatenate([[0], np.cumsum(used.sum(1))])
                    ids = batch.column(0).slice(a, b - a).cast(pa.int64()).take(pa.array(text))
                    yield pa.RecordBatch.from_arrays([ids, pa.array(win.view(np.int64)), pa.array(h.view(np.int64)), list_column(values[used].view(np.int64), slots, pa.int64()), pa.array(size, pa.int32()), pa.array(exact, pa.bool_())], names=["id", "win", "h", "slots", "size", "exact"])

        return run

    kind = "id long, win long, h long, slots array<long>, size int, exact boolean"
    items = benchmark.select(F.col("item_id").cast("long").alias("id"), F.col("text").alias("t")).where("id is not null").mapInArrow(windows(None), kind)
    items = items.groupBy("id", "win", "h").agg(F.min("slots").alias("slots"), F.min("size").alias("size"), F.min("exact").alias("exact"))
    bit = F.shiftrightunsigned("h", 64 - MAP_BITS)
    one = F.expr("shiftleft(1L, cast(bit & 63 as int))")
    # at most 2**22 bits in 65,536 rows, for any benchmark
    words = items.select(bit.alias("bit")).select(F.expr("bit >> 6").alias("w"), one.alias("b")).groupBy("w").agg(F.bit_or("b").alias("b")).collect()
    bits = np.zeros(1 << (MAP_BITS - 6), np.uint64)
    for r in words:
        bits[r["w"]] = np.uint64(r["b"] & 0xFFFFFFFFFFFFFFFF)
    # texts need windows of the lengths that items have: at most 2 * window kinds
    shapes = sorted({(window, False)} | {(r["size"], r["exact"]) for r in items.select("size", "exact").distinct().collect()})
    found = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("t")).where("id is not null").mapInArrow(windows(bits, shapes), kind)
    # repeats of a window with the same slot values tell nothing new; a text is not collected beyond the item's windows and their values
    found = found.select(F.col("id").alias("doc_id"), "h", F.col("slots").alias("here")).distinct()
    size = items.groupBy("id").agg(F.countDistinct("win").alias("n_windows"))
    hits = found.join(items.select(F.col("id").alias("item_id"), "win", "h", "slots"), "h").groupBy("doc_id", "item_id").agg(
        F.collect_list(F.struct("win", "slots", "here")).alias("hits"), F.countDistinct("win").alias("n_matched")
    )
    hits = hits.join(size.withColumnRenamed("id", "item_id"), "item_id").where(F.col("n_matched") >= F.lit(share) * F.col("n_windows"))

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            good, same = [], []
            for hits in batch.column(4).to_pylist():
                pairs = [(x["slots"], x["here"]) for x in hits]
                # of several values at one window, the item's own decide first
                best: dict[int, tuple] = {}
                for x in sorted(hits, key=lambda x: (x["slots"] != x["here"], x["here"])):
                    best.setdefault(x["win"], (x["slots"], x["here"]))
                good.append(max(consistent(list(best.values())), min(len(best), consistent(pairs))))
                same.append(all(a == b for a, b in best.values()))
            yield pa.RecordBatch.from_arrays([*batch.columns[:4], pa.array(good, pa.int64()), pa.array(same, pa.bool_())], names=["doc_id", "item_id", "n_windows", "n_matched", "n_consistent", "verbatim"])

    out = hits.select("doc_id", "item_id", "n_windows", "n_matched", "hits").mapInArrow(judge, "doc_id long, item_id long, n_windows long, n_matched long, n_consistent long, verbatim boolean")
    return out.where(F.col("n_consistent") >= F.lit(share) * F.col("n_windows"))


def op2_decontamination(spark, sf_dir: str) -> DataFrame:
    """All pairs of a document and a benchmark item that leaked into it."""
    return find_leaks(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
