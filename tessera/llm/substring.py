"""Substring deduplication by relative Lempel-Ziv parsing of every document against the rest of the corpus.

Reference documents are dealt into blocks of bounded size. A document is parsed against a block greedily:
at a position, the longest copy of what follows there in a document of the block with a smaller id becomes
a factor if it has at least ``window`` words; else the parse moves on by a word. Where a factor ends, the
windows across its end are checked next, before the parse goes on behind it, so no repeated window is lost
between factors. Factors of all blocks together are a document's duplicate spans. Words are compared
themselves, by numbers that are equal exactly where the words are.

Most blocks can't give a document any factor. An index of window hashes over all documents names, for each
window that several documents have, the smallest id that has it; a document is parsed against the blocks of
those documents, which hold an earlier copy of each of its windows that has one. A block met by many
documents is parsed by several tasks, each with a bounded share of them. The index keeps only windows whose
anchor (the smallest hash among its 16-word parts) occurs in two different texts, which loses nothing.
Equal texts are one class, known by its smallest id.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Words, list_column, materialize, mix64, powers, text_slices

PART = 16
#: bytes of text of a reference block, and of the documents that one task parses against it (a longer text is alone)
BLOCK_BYTES = 3 << 20
_EMPTY = hashlib.sha256(b"").hexdigest()
FACTOR = "struct<start: int, n_words: int, ref_id: long, ref_start: int>"
_FACTOR = pa.list_(pa.struct([("start", pa.int32()), ("n_words", pa.int32()), ("ref_id", pa.int64()), ("ref_start", pa.int32())]))


def _rolling(h: np.ndarray, k: int, base: int) -> np.ndarray:
    """Hash of each k consecutive word hashes, at their first (by prefix sums, so any k costs the same)."""
    n = len(h)
    if n < k:
        return np.zeros(0, np.uint64)
    p, inv = powers(base, n)
    total = np.zeros(n + 1, np.uint64)
    np.cumsum(h * p[:n], out=total[1:])
    return mix64((total[k:] - total[:-k]) * inv[: n - k + 1])


def _slide_min(a: np.ndarray, k: int) -> np.ndarray:
    """Minimum of each k consecutive values, by doubling."""
    span = 1
    while span * 2 <= k:
        a = np.minimum(a[:-span], a[span:])
        span *= 2
    return np.minimum(a[: len(a) - (k - span)], a[k - span :]) if k > span else a


def _starts(w: Words, k: int) -> np.ndarray:
    """Starts of all k-word windows within a text."""
    n = max(0, len(w.start) - k + 1)
    return np.flatnonzero(w.text_end[:n] - np.arange(n) >= k)


def _windows(w: Words, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts of all k-word windows within a text, and their anchors."""
    at = _starts(w, k)
    if not len(at):
        return at, np.zeros(0, np.uint64)
    part = min(PART, k)
    return at, _slide_min(_rolling(w.hash, part, 0x9E3779B97F4A7C15), k - part + 1)[at]


def _kept_digest(text: bytes, gone: np.ndarray | None = None) -> str:
    words = text.split()  # of bytes: at exactly the six separators
    if gone is not None:
        words = [x for x, g in zip(words, gone, strict=True) if not g]
    return hashlib.sha256(b" ".join(words)).hexdigest()


def window_classes(token: np.ndarray, h: np.ndarray, at: np.ndarray, k: int) -> np.ndarray:
    """A number for each window that starts at ``at``, equal exactly where their k tokens are; h are hashes of them."""
    _, first, found = np.unique(h, return_index=True, return_inverse=True)
    lead, same = at[first][found], np.ones(len(at), bool)
    for j in range(k):
        same &= token[at + j] == token[lead + j]
    if not same.all():
        # windows of unlike tokens share a hash: those hashes' windows are told apart by their tokens
        mixed = np.flatnonzero(np.isin(found, found[~same]))
        rows = np.ascontiguousarray(token[at[mixed][:, None] + np.arange(k)]).view(np.dtype((np.void, 8 * k))).ravel()
        found[mixed] = len(first) + np.unique(rows, return_inverse=True)[1]
    return found


def longest_copy(token: np.ndarray, end: np.ndarray, s: int, places: np.ndarray, k: int) -> tuple[int, int]:
    """(length, place) of the longest run of tokens from s that also stands at one of ``places`` (ascending; the first of equals).

    The first k tokens are known to be equal; end has, for each token, where its text ends.
    """
    room = np.minimum(end[places] - places, end[s] - s)
    best, best_at, size, step = k, int(places[0]), k, 64
    while len(places):
        run = np.empty(len(places), np.int64)
        for a in range(0, len(places), 4096):
            p = places[a : a + 4096]
            span = size + np.arange(step)
            inside = span[None, :] < room[a : a + 4096, None]
            last = len(token) - 1
            same = inside & (token[np.minimum(p[:, None] + span, last)] == token[np.minimum(s + span, last)])
            run[a : a + 4096] = np.where(same.all(1), step, same.argmin(1))
        top = int(run.argmax())
        if size + run[top] > best:
            best, best_at = int(size + run[top]), int(places[top])
        more = run == step
        places, room, size, step = places[more], room[more], size + step, min(step * 2, 4096)
    return best, best_at


def parse(words: Words, ids: np.ndarray, is_ref: np.ndarray, k: int) -> dict[int, list[tuple[int, int, int, int]]]:
    """Factors of each text that isn't a reference: (start, words, reference id, start there), each a longest copy
    from the reference texts with smaller ids; starts count from the text's first word."""
    token, end, text = words.exact(), words.text_end, words.text_of()
    at = _starts(words, k)
    if not len(at):
        return {}
    h = _rolling(words.hash, k, 0xD1342543DE82EF95)[at]
    ref = is_ref[text[at]]
    # only hashes that a reference and another text have can be copies
    both = np.isin(h, np.intersect1d(h[ref], h[~ref]))
    at, h, ref = at[both], h[both], ref[both]
    if not len(at):
        return {}
    found = window_classes(token, h, at, k)
    r = np.flatnonzero(ref)
    r = r[np.lexsort((at[r], ids[text[at[r]]], found[r]))]
    held, held_id, held_at = found[r], ids[text[at[r]]], at[r]
    q = np.flatnonzero(~ref)
    first, last = np.searchsorted(held, found[q]), np.searchsorted(held, found[q], "right")
    own = ids[text[at[q]]]
    some = first < last
    some[some] = held_id[first[some]] < own[some]
    q, first, last, own = q[some], first[some], last[some], own[some]
    out: dict[int, list[tuple[int, int, int, int]]] = {}
    where = at[q]
    i = 0
    while i < len(q):
        s, a = int(where[i]), int(first[i])
        b = a + int(np.searchsorted(held_id[a : last[i]], own[i]))
        size, place = longest_copy(token, end, s, held_at[a:b], k)
        t, u = int(text[s]), int(text[place])
        out.setdefault(t, []).append((s - int(words.first[t]), size, int(ids[u]), place - int(words.first[u])))
        # on to the first window that the factor doesn't hold whole: the windows across its end come next
        i = int(np.searchsorted(where, s + size - k + 1))
    return out


def factor_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = 50) -> DataFrame:
    """For each row: id, n_words, n_removed, kept_sha256, factors (array of struct(start, n_words, ref_id, ref_start)).

    A word is removed if a factor covers it, which is where some window of ``window`` words over it also occurs
    in a row with a smaller id. Null, blank and short texts (under a window) lose nothing. A row with a null id
    neither loses words nor counts as a reference. Rows that repeat an id with other text are judged one by one,
    and never against each other; equal rows are judged alike. For a text equal to one with a smaller id the only
    factor is the whole text. Factors of different blocks may overlap. Only the id and text columns are read. An
    empty table gives no rows.
    """
    k = window

    def survey(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, data, off in text_slices(batch, "t"):
                w = Words(data, off)
                at, anchor = _windows(w, k)
                new = np.ones(len(at), bool)
                new[1:] = (anchor[1:] != anchor[:-1]) | (at[1:] != at[:-1] + 1)
                first = np.searchsorted(at[new], w.first)
                raw = data.tobytes()
                part = batch.slice(a, b - a)
                digests = pa.array([_kept_digest(raw[off[i] : off[i + 1]]) for i in range(b - a)], pa.string())
                anchors = list_column(anchor[new].view(np.int64), first, pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array(w.n.astype(np.int64)), digests, anchors], names=["id", "key", "n", "whole", "anchors"]
                )

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            shared = batch.column(3)
            for a, b, data, off in text_slices(batch, "t"):
                w = Words(data, off)
                at, anchor = _windows(w, k)
                h = _rolling(w.hash, k, 0xD1342543DE82EF95)
                span = np.searchsorted(at, w.first)
                keep = np.zeros(len(at), bool)
                for i in range(b - a):
                    wanted = np.asarray(shared[a + i].values.to_numpy(zero_copy_only=False)).astype(np.int64).view(np.uint64)
                    keep[span[i] : span[i + 1]] = np.isin(anchor[span[i] : span[i + 1]], wanted)
                at = at[keep]
                part = batch.slice(a, b - a)
                hashes = list_column(h[at].view(np.int64) if len(at) else np.zeros(0, np.int64), np.searchsorted(at, w.first), pa.int64())
                yield pa.RecordBatch.from_arrays([*part.columns[:3], hashes], names=["id", "key", "t", "hashes"])

    def parse_unit(unit: pa.Table) -> pa.Table:
        unit = unit.combine_chunks()
        ids, keys = unit.column("id").to_numpy(), unit.column("key").to_pylist()
        is_ref = unit.column("is_ref").to_numpy().astype(bool)
        batch = pa.RecordBatch.from_arrays([unit.column("t").combine_chunks()], names=["t"])
        ((_, _, data, off),) = text_slices(batch, "t", 1 << 62)
        found = parse(Words(data, off), ids, is_ref, k)
        rows = sorted(found)
        factors = [[dict(zip(("start", "n_words", "ref_id", "ref_start"), f, strict=True)) for f in found[i]] for i in rows]
        return pa.Table.from_arrays(
            [pa.array([int(ids[i]) for i in rows], pa.int64()), pa.array([keys[i] for i in rows], pa.binary()), pa.array(factors, _FACTOR)], names=["id", "key", "factors"]
        )

    def remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(3)
            removed, sha = [], []
            for i, text in enumerate(batch.column(2)):
                text, flat = text.as_py().encode(), lists[i].values
                start, size = (flat.field(c).to_numpy(zero_copy_only=False) for c in ("start", "n_words"))
                words = len(text.split())
                edge = np.zeros(words + 1, np.int64)
                np.add.at(edge, start, 1)
                np.add.at(edge, start + size, -1)
                gone = np.cumsum(edge[:-1]) > 0
                removed.append(int(gone.sum()))
                sha.append(_kept_digest(text, gone))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(removed, pa.int64()), pa.array(sha, pa.string()), lists], names=["id", "key", "removed", "sha", "factors"]
            )

    text = F.col(text_col)
    key = F.unhex(F.sha2(F.coalesce(text, F.lit("")).cast("binary"), 256))
    rows = docs.select(F.col(id_col).cast("long").alias("id"), key.alias("key"), text.alias("t"))
    seen = materialize(rows.mapInArrow(survey, "id long, key binary, n long, whole string, anchors array<long>"), "rlz-survey")
    long_enough = seen.where(F.col("id").isNotNull() & (F.col("n") >= k))
    # aggregates that are joined again are tables of their own: a join of two plain exchanges can split hot partitions
    classes = materialize(long_enough.groupBy("key").agg(F.min("id").alias("class")), "rlz-classes")
    # one row of each class; a repeated id with the same text gives equal rows
    reps = long_enough.join(classes, "key").where("id = class").select("id", "key", "anchors").dropDuplicates(["id", "key"])
    occurs = reps.select("id", "key", F.explode("anchors").alias("anchor"))
    several = lambda of, least: of.agg(F.min("id").alias(least), F.max("id").alias("hi")).where(f"{least} < hi").drop("hi")
    shared = materialize(several(occurs.groupBy("anchor"), "lo").select("anchor"), "rlz-anchors")
    wanted = occurs.join(shared, "anchor").groupBy("id", "key").agg(F.collect_set("anchor").alias("anchors"))
    held = rows.where("id is not null").join(wanted, ["id", "key"]).dropDuplicates(["id", "key"])
    indexed = materialize(held.select("id", "key", "t", "anchors").mapInArrow(index, "id long, key binary, t string, hashes array<long>"), "rlz-index")
    window_rows = indexed.select("id", "key", F.explode("hashes").alias("h"))
    first = materialize(several(window_rows.groupBy("h"), "ref"), "rlz-windows")
    met = materialize(window_rows.join(first, "h").where("ref < id").select("id", "key", "ref").distinct(), "rlz-met")

    texts = indexed.select("id", "key", "t")
    refs = materialize(texts.join(met.select(F.col("ref").alias("id")).distinct(), "id").select("id", "key", "t", F.octet_length("t").alias("size")), "rlz-references")
    blocks = max(1, -(-refs.agg(F.coalesce(F.sum("size"), F.lit(0))).first()[0] // BLOCK_BYTES))
    block = lambda c: F.pmod(F.xxhash64(c), F.lit(blocks))
    queries = met.select("id", "key", block("ref").alias("block")).distinct().join(texts.select("id", "key", F.octet_length("t").alias("size")), ["id", "key"])
    queries = materialize(queries, "rlz-queries")
    shares = queries.groupBy("block").agg(F.expr(f"(sum(size) + {BLOCK_BYTES - 1}L) div {BLOCK_BYTES}L").alias("shares"))
    shares = materialize(shares, "rlz-shares")
    left = refs.withColumn("block", block("id")).join(shares, "block").select(
        "block", F.explode(F.expr("sequence(0L, shares - 1)")).alias("share"), "id", "key", "t", F.lit(True).alias("is_ref")
    )
    right = queries.join(shares, "block").select("block", F.pmod(F.xxhash64("id", "key"), "shares").alias("share"), "id", "key").join(texts, ["id", "key"])
    units = left.unionByName(right.withColumn("is_ref", F.lit(False))).groupBy("block", "share")
    factors = units.applyInArrow(parse_unit, f"id long, key binary, factors array<{FACTOR}>")
    factors = factors.groupBy("id", "key").agg(F.array_sort(F.flatten(F.collect_list("factors"))).alias("factors"))
    parsed = texts.join(factors, ["id", "key"]).select("id", "key", "t", "factors").mapInArrow(
        remove, f"id long, key binary, removed long, sha string, factors array<{FACTOR}>"
    )
    copy = F.coalesce((F.col("n") >= k) & (F.col("id") > F.col("class")), F.lit(False))
    own = F.array(F.struct(F.lit(0).alias("start"), F.col("n").cast("int").alias("n_words"), F.col("class").alias("ref_id"), F.lit(0).alias("ref_start")))
    none = F.array().cast(f"array<{FACTOR}>")
    out = seen.select("id", "key", "n", "whole").join(classes, "key", "left").join(parsed, ["id", "key"], "left")
    return out.select(
        F.col("id").alias("doc_id"),
        F.col("n").alias("n_words"),
        F.when(copy, F.col("n")).otherwise(F.coalesce("removed", F.lit(0))).cast("long").alias("n_removed"),
        F.when(copy, F.lit(_EMPTY)).otherwise(F.coalesce("sha", "whole")).alias("kept_sha256"),
        F.when(copy, own).otherwise(F.coalesce("factors", none)).alias("factors"),
    )


def op6_substring(spark, sf_dir: str) -> DataFrame:
    """All documents: words, words removed by windows of 50 that a smaller id also has, and a digest of the rest."""
    return factor_documents(spark.read.parquet(f"{sf_dir}/documents.parquet")).select("doc_id", "n_words", "n_removed", "kept_sha256")
