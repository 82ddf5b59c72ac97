"""Cross-entropy difference: documents scored by a target and a background n-gram model over one vocabulary.

Both are interpolated bigram models over the same vocabulary: all words of all documents. The target model
counts the documents labelled as good, the background model all others. The models are matched: the larger
one's counts are scaled to the tokens of the smaller one, so both smooth alike and a document isn't told apart by
the size of a model. A document is left out of the model that counts it. Its score is its loss per token
under the target model minus that under the background model, in bits: the lower, the more it is like the target.

Counts cover the whole corpus, and no table of them is held in one place. Texts are cut into blocks of a
bounded size; each block counts its own bigrams and words and sends them, packed, to buckets by hash. A
bucket adds up the counts of all blocks and answers every block for what also occurs in another one; what
occurs in one block only is known there already. Blocks are then scored with the answers they got. Words
and bigrams are compared by 64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import SLICE_BYTES, Words, bounded_tiles, materialize, mix64, text_slices

BLOCK_BYTES = 1 << 23
BUCKET_ROWS = 1 << 19
START = np.uint64(0xD1B54A32D192ED03)
#: added to each word's count, and the weight of the word model against a context's counts
ALPHA, WEIGHT = 0.5, 4.0


def _pack(a: np.ndarray) -> bytes:
    """Bytes of equal weight together, compressed, after the length."""
    a = np.ascontiguousarray(a)
    planes = np.ascontiguousarray(a.view(np.uint8).reshape(-1, a.itemsize).T)
    return np.int64(planes.size).tobytes() + pa.Codec("zstd").compress(planes.tobytes(), asbytes=True)


def _unpack(b: bytes, kind: type) -> np.ndarray:
    size = int(np.frombuffer(b, np.int64, 1)[0])
    raw = np.frombuffer(pa.Codec("zstd").decompress(b[8:], size, asbytes=True), np.uint8)
    return np.ascontiguousarray(raw.reshape(np.dtype(kind).itemsize, -1).T).reshape(-1).view(kind)


def _pack_sorted(h: np.ndarray) -> bytes:
    return _pack(np.diff(h, prepend=np.uint64(0)))


def _unpack_sorted(b: bytes) -> np.ndarray:
    return np.cumsum(_unpack(b, np.uint64), dtype=np.uint64)


class _Block:
    """Tokens of a block of texts, and its own counts of words and bigrams."""

    def __init__(self, n: bytes, chosen: list[int] | None, vocab: bytes, tokens: bytes):
        self.n = _unpack(n, np.int64)
        self.chosen = np.zeros(len(self.n), bool)
        self.chosen[chosen or []] = True
        #: the block's words and, at the end, the start symbol, which is the context of a text's first word
        self.vocab, token = np.append(_unpack(vocab, np.uint64), START), _unpack(tokens, np.uint32).astype(np.int64)
        size = self.size = len(self.vocab)
        self.full = self.n > 0
        self.begin = (np.cumsum(self.n) - self.n)[self.full]
        before = np.empty_like(token)
        before[1:] = token[:-1]
        before[self.begin] = size - 1
        key, inverse, count = np.unique(before * size + token, return_inverse=True, return_counts=True)
        a, b = key // size, key % size
        h = mix64(mix64(self.vocab[a]) * np.uint64(0x9FB21C651E98DF25) + self.vocab[b])
        order = np.argsort(h, kind="stable")
        place = np.empty_like(order)
        place[order] = np.arange(len(order))
        self.a, self.b, self.h, self.at = a[order], b[order], h[order], place[inverse]
        good = np.bincount(self.at[np.repeat(self.chosen, self.n)], minlength=len(h))
        #: of each bigram: occurrences in chosen texts, and in others
        self.pairs = np.stack([good, count[order] - good]).astype(np.int64)
        add = lambda at, v: np.bincount(at, v, size).astype(np.int64)
        self.order = np.argsort(self.vocab, kind="stable")
        #: of each word: occurrences, and those as a context, each in chosen texts and in others
        self.words = np.stack([add(at, v) for at in (self.b, self.a) for v in self.pairs])

    def own(self) -> list[np.ndarray]:
        """For each token, how often its text has its bigram, its word, and its context as a context."""
        text = np.repeat(np.arange(len(self.n)), self.n)
        out = []
        for x, size in ((self.at, len(self.h)), (self.b[self.at], self.size), (self.a[self.at], self.size)):
            _, inverse, count = np.unique(text * max(size, 1) + x, return_inverse=True, return_counts=True)
            out.append(count[inverse])
        return out


def _cut(h: np.ndarray, bits: int) -> np.ndarray:
    """Where each bucket of sorted hashes begins; a last entry for the end."""
    first = np.arange(1 << bits, dtype=np.uint64) << np.uint64(64 - bits) if bits else np.zeros(1, np.uint64)
    return np.append(np.searchsorted(h, first), len(h))


def _apply(h: np.ndarray, values: np.ndarray, answers: list[tuple]) -> None:
    """Totals of all blocks instead of the block's own counts, where they differ."""
    for first, at, v in answers:
        at = int(np.searchsorted(h, np.uint64(first))) + np.cumsum(_unpack(at, np.uint32), dtype=np.int64)
        values[:, at] = _unpack(v, np.int64).reshape(len(values), -1)


MESSAGE = "kind int, bucket long, block long, h binary, v binary"
ANSWER = "block long, kind int, first long, at binary, v binary, n_distinct long"
#: rows of counts of a bigram (kind 0) and of a word (kind 1)
WIDTH = (2, 4)


def _messages(kind: int, block: int, h: np.ndarray, values: np.ndarray, bits: int) -> pa.RecordBatch:
    cut = _cut(h, bits)
    some = [(i, a, b) for i, (a, b) in enumerate(zip(cut[:-1], cut[1:], strict=True)) if a < b]
    columns = [[kind] * len(some), [i for i, _, _ in some], [block] * len(some), [_pack_sorted(h[a:b]) for _, a, b in some], [_pack(values[:, a:b]) for _, a, b in some]]
    kinds = (pa.int32(), pa.int64(), pa.int64(), pa.binary(), pa.binary())
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["kind", "bucket", "block", "h", "v"])


def _answers(bits: int):
    """Adds up a bucket's counts, and answers each block for the hashes that another one has too."""

    def run(table: pa.Table) -> pa.Table:
        kind, bucket = table.column("kind")[0].as_py(), table.column("bucket")[0].as_py()
        rows = list(zip(*(table.column(c).to_pylist() for c in ("block", "h", "v")), strict=True))
        h = [_unpack_sorted(r[1]) for r in rows]
        values = np.concatenate([_unpack(r[2], np.int64).reshape(WIDTH[kind], -1) for r in rows], axis=1)
        distinct, inverse, times = np.unique(np.concatenate(h), return_inverse=True, return_counts=True)
        total = np.stack([np.bincount(inverse, v, len(distinct)).astype(np.int64) for v in values])
        del values
        shared = times[inverse] > 1
        first = np.uint64(bucket << (64 - bits)).view(np.int64) if bits else 0
        # the count of distinct hashes is a row of its own
        out = [(-1, kind, int(first), None, None, len(distinct))]
        a = 0
        for (block, _, _), x in zip(rows, h, strict=True):
            at = np.flatnonzero(shared[a : a + len(x)])
            if len(at):
                out.append((block, kind, int(first), _pack(np.diff(at, prepend=0).astype(np.uint32)), _pack(total[:, inverse[a + at]]), 0))
            a += len(x)
        kinds = (pa.int64(), pa.int32(), pa.int64(), pa.binary(), pa.binary(), pa.int64())
        return pa.Table.from_arrays([pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)], names=["block", "kind", "first", "at", "v", "n_distinct"])

    return run


def _received(table: pa.Table, kind: int) -> list[tuple]:
    rows = zip(*(table.column(c).to_pylist() for c in ("kind", "first", "at", "v")), strict=True)
    return [(first & 0xFFFFFFFFFFFFFFFF, at, v) for k, first, at, v in rows if k == kind]


def _block_of(table: pa.Table | pa.RecordBatch, i: int = 0) -> _Block:
    return _Block(*(table.column(table.schema.get_field_index(c))[i].as_py() for c in ("n", "chosen", "vocab", "tokens")))


def _losses(pair: np.ndarray, word: np.ndarray, context: np.ndarray, total: np.ndarray, size: int, scale: float) -> np.ndarray:
    """-log2 of the interpolated probability of each token, from counts of its bigram, word and context and of all tokens."""
    one = (scale * word + ALPHA) / (scale * total + ALPHA * size)
    return -np.log2((scale * pair + WEIGHT * one) / (scale * context + WEIGHT))


def score_by_difference(docs: DataFrame, target_ids: DataFrame) -> DataFrame:
    """(doc_id, n_tokens, target_loss, background_loss, score) for each row of ``docs`` (doc_id, text).

    Losses are bits per token; they and the score are null where a text has no words (null texts too). Rows
    with null or repeated ids are scored one by one, and each left out of the counts by itself. ``target_ids`` has a
    doc_id column; repeats and nulls in it don't matter. If none of them is found, or all documents are targets, both
    models know only the vocabulary, and scores are 0. An empty table gives no rows. Other columns are not read.
    """
    base = docs.select(F.col("doc_id").cast("long").alias("id"), F.col("text").alias("t"))

    def cut_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, held, parts = TaskContext.get().partitionId() << 32, 0, []

        def whole() -> pa.RecordBatch:
            ids, n, hashes = zip(*parts, strict=True)
            n = np.concatenate(n)
            h, inverse, count = np.unique(np.concatenate(hashes), return_inverse=True, return_counts=True)
            # frequent words get small numbers, which take less room
            order = np.argsort(-count, kind="stable")
            place = np.empty(len(h), np.uint32)
            place[order] = np.arange(len(h), dtype=np.uint32)
            row = (block, [x for i in ids for x in i], n.tolist(), _pack(n), _pack(h[order]), _pack(place[inverse]), len(inverse))
            kinds = (pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()), *[pa.binary()] * 3, pa.int64())
            names = ["block", "ids", "sizes", "n", "vocab", "tokens", "total"]
            return pa.RecordBatch.from_arrays([pa.array([x], k) for x, k in zip(row, kinds, strict=True)], names=names)

        for batch in batches:
            for a, b, data, off in text_slices(batch, "t", min(SLICE_BYTES, BLOCK_BYTES)):
                if parts and held + len(data) > BLOCK_BYTES:
                    yield whole()
                    block, held, parts = block + 1, 0, []
                w = Words(data, off)
                parts.append((batch.column(0).slice(a, b - a).to_pylist(), w.n.astype(np.int64), w.hash))
                held += len(data)
        if parts:
            yield whole()

    kind = "block long, ids array<long>, sizes array<long>, n binary, vocab binary, tokens binary, total long"
    blocks = materialize(base.mapInArrow(cut_blocks, kind), "lm-blocks")
    # ids alone meet the targets, not texts; a block's places are bounded by its texts
    chosen = target_ids.select(F.col("doc_id").cast("long").alias("id")).distinct()
    rows = blocks.select("block", F.posexplode(F.arrays_zip("ids", "sizes")).alias("at", "x")).select("block", "at", F.col("x.ids").alias("id"), F.col("x.sizes").alias("size"))
    places = rows.join(chosen, "id").groupBy("block").agg(F.collect_list("at").alias("chosen"), F.sum("size").alias("size"))
    places = materialize(places, "lm-targets")
    total = lambda df, c: df.agg(F.coalesce(F.sum(c), F.lit(0))).first()[0]
    n, target = total(blocks, "total"), total(places, "size")
    totals, bits = (target, n - target), bounded_tiles(n, BUCKET_ROWS)
    blocks = blocks.join(places.select("block", "chosen"), "block", "left")

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                x, block = _block_of(batch, i), batch.column(0)[i].as_py()
                yield _messages(0, block, x.h, x.pairs, bits)
                yield _messages(1, block, x.vocab[x.order], x.words[:, x.order], bits)

    tokens = blocks.select("block", "n", "chosen", "vocab", "tokens")
    answers = materialize(tokens.mapInArrow(send, MESSAGE).groupBy("kind", "bucket").applyInArrow(_answers(bits), ANSWER), "lm-answers")
    # all words and the start symbol
    size = answers.where("kind = 1").agg(F.coalesce(F.sum("n_distinct"), F.lit(0)).alias("n")).first()["n"]

    def score(left: pa.Table, right: pa.Table) -> pa.Table:
        x = _block_of(left)
        words = x.words[:, x.order]
        _apply(x.h, x.pairs, _received(right, 0))
        _apply(x.vocab[x.order], words, _received(right, 1))
        x.words[:, x.order] = words
        pair, word, context = x.own()
        a, b, n = x.a[x.at], x.b[x.at], np.repeat(x.n, x.n)
        loss = []
        for m, member in enumerate((x.chosen, ~x.chosen)):
            v = np.zeros(len(x.n))
            if len(x.begin):
                out = np.repeat(member, x.n)
                counts = (x.pairs[m][x.at] - out * pair, x.words[m][b] - out * word, x.words[2 + m][a] - out * context, totals[m] - out * n)
                each = _losses(*counts, size, min(totals) / max(totals[m], 1))
                v[x.full] = np.add.reduceat(each, x.begin) / x.n[x.full]
            loss.append(v)
        ids = left.column("ids")[0].values
        columns = [ids, pa.array(x.n), *(pa.array(v, mask=~x.full) for v in (*loss, loss[0] - loss[1]))]
        return pa.Table.from_arrays(columns, names=["doc_id", "n_tokens", "target_loss", "background_loss", "score"])

    scored = blocks.select("block", "ids", "n", "chosen", "vocab", "tokens").groupBy("block").cogroup(answers.where("block >= 0").groupBy("block"))
    return scored.applyInArrow(score, "doc_id long, n_tokens long, target_loss double, background_loss double, score double")


def op7_lm_scoring(spark, sf_dir: str) -> DataFrame:
    """All documents scored by cross-entropy difference; the target is the documents labelled good and not toxic."""
    good = spark.read.parquet(f"{sf_dir}/labels.parquet").where("quality = 1 and coalesce(toxic, 0) = 0").select("doc_id")
    return score_by_difference(spark.read.parquet(f"{sf_dir}/documents.parquet"), good)
