"""Mixing sources to target weights, with DataFrame functions only.

Each source's texts, in a seeded order, form one stream of words that is packed into blocks of fixed
length. The slots of all output shards draw their sources at random under the condition that every
source gets its quota of slots in the end: a shard's counts are a multinomial draw conditioned on the
totals, which is what dealing out a shuffled pool of all slots gives. The pool is shuffled by a
pseudorandom permutation of slot numbers, and a source's slots go through pseudorandom permutations of
its block indexes, one for each pass over the source; the blocks are then joined by index. A pass uses
each block once, so a source of quota q blocks repeats none more than ceil(q / blocks) times.

Permutations are swap-or-not networks: each round pairs x with (k - x) mod n and swaps by a bit that
depends on the pair alone. That is a bijection of 0 to n - 1 for every n, computed row by row, so no
row is sorted or shuffled to be permuted.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import WORD, bounded_tiles, hash_tile, materialize, running_base, seeded_hash

ROUNDS = 20
PRIME = (1 << 31) - 1
MOST_CELLS = 1 << 20


@dataclass
class Mixture:
    """rows: rid (a row's number), row (the columns kept). sources: src, sid, size, weight, target, blocks, quota, lo.
    slots: shard, slot, sid, block. pieces: rid, id, sid, size, h, block, from_word, n_before, n_words; a row
    without words has one piece, of no words, in a block that doesn't exist."""

    rows: DataFrame
    sources: DataFrame
    slots: DataFrame
    pieces: DataFrame

    def taken(self) -> DataFrame:
        """rid, id, sid, size, h and taken of every row: the words the mix takes of it, repeats counted."""
        draws = self.slots.groupBy("sid", "block").agg(F.count(F.lit(1)).alias("copies"))
        # merged: Spark's size estimate of exploded rows is that of the rows before, which may look small enough to broadcast
        met = self.pieces.hint("merge").join(draws, ["sid", "block"], "left")
        return met.groupBy("rid", "id", "sid", "size", "h").agg(F.sum(F.coalesce("copies", F.lit(0)) * F.col("n_words")).cast("long").alias("taken"))

    def block_texts(self, text_col: str = "text") -> DataFrame:
        """The mixture itself: shard, slot, and the block's words joined by one space; the mixture must keep the text."""
        words = F.regexp_extract_all(F.col("row")[text_col], F.lit(f"({WORD})"), F.lit(1))
        cut = self.pieces.where("n_words > 0").hint("merge").join(self.rows.select("rid", words.alias("w")), "rid").select(
            "sid", "block", F.struct("n_before", F.slice("w", F.col("from_word") + 1, F.col("n_words").cast("int")).alias("w")).alias("p")
        )
        # at most one piece per word of the block, so this list is bounded by the block length
        whole = cut.groupBy("sid", "block").agg(F.array_sort(F.collect_list("p")).alias("p")).select(
            "sid", "block", F.array_join(F.flatten(F.col("p.w")), " ").alias("text")
        )
        return self.slots.hint("merge").join(whole, ["sid", "block"]).select("shard", "slot", "text")


def fixed_keys(name: str, n: int, rounds: int = ROUNDS) -> str:
    """SQL of the round keys of one permutation of 0 to n - 1, as literals."""
    out = []
    for r in range(1, rounds + 1):
        d = hashlib.md5(f"{name}:{r}".encode()).hexdigest()
        out.append(f"named_struct('k', {int(d[:15], 16) % n}L, 'a', {int(d[15:23], 16) % PRIME + 1}L, 'b', {int(d[23:31], 16) % PRIME + 1}L)")
    return f"array({', '.join(out)})"


def keys_of(name: Column, n: str, rounds: int = ROUNDS) -> Column:
    """The same round keys for a name in each row."""
    part = lambda d, at, size: F.conv(F.substring(d, at, size), 16, 10).cast("long")
    digests = F.transform(F.sequence(F.lit(1), F.lit(rounds)), lambda r: F.md5(F.concat(name, F.lit(":"), r.cast("string")).cast("binary")))
    return F.transform(
        digests, lambda d: F.struct((part(d, 1, 15) % F.col(n)).alias("k"), (part(d, 16, 8) % PRIME + 1).alias("a"), (part(d, 24, 8) % PRIME + 1).alias("b"))
    )


def permuted(x: str, n: str, keys: str, most: int = 1 << 62) -> str:
    """SQL of the place of x (0 to n - 1) under the permutation with these round keys; n is at most ``most``."""
    pair = f"greatest(v, pmod(r.k - v, {n}))"
    # the first form is the second one where the pair's quotient is 0
    value = f"{pair} * r.a + r.b" if most <= PRIME else f"({pair} % {PRIME}L) * r.a + ({pair} div {PRIME}L + 1L) * r.b"
    return f"aggregate({keys}, {x}, (v, r) -> if(bit_count(({value}) % {PRIME}L) & 1 = 1, pmod(r.k - v, {n}), v))"


def water_fill(sources: DataFrame, cap: float) -> DataFrame:
    """Adds target: total size shared by weight, none above cap times its size, the excess reshared.

    The level that free sources reach only rises as sources are capped, and a source is capped where
    cap * size / weight is under it; so rounds of one aggregation each end at the exact level. Only sums
    reach the driver.
    """
    total, weight = sources.agg(F.coalesce(F.sum("size"), F.lit(0)), F.coalesce(F.sum("weight"), F.lit(0))).first()
    level, capped = total / max(weight, 1), 0
    while True:
        under = F.col("size") * F.lit(float(cap)) / F.col("weight") < F.lit(float(level))
        size, held = sources.where(under).agg(F.coalesce(F.sum("size"), F.lit(0)), F.coalesce(F.sum("weight"), F.lit(0))).first()
        if held in (capped, weight):
            break
        level, capped = (total - cap * size) / (weight - held), held
    return sources.withColumn("target", F.least(F.col("size") * F.lit(float(cap)), F.col("weight") * F.lit(float(level))))


def _numbered(sources: DataFrame) -> DataFrame:
    """Adds sid: the place of a source in code-point order, null last, from a sort over all tasks."""
    s = sources.orderBy(F.col("src").asc_nulls_last()).select("*", F.spark_partition_id().alias("part"), F.monotonically_increasing_id().alias("at"))
    s = materialize(s, "mix-order")
    # a row for each task of the sort
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    first = s.groupBy("part").agg(F.count(F.lit(1)).alias("n")).select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))
    return s.join(first, "part").select(*sources.columns, F.expr("first + at - shiftleft(cast(part as long), 33)").alias("sid"))


def mix_sources(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    keep: list[str] | None = None,
    block_words: int = 64,
    slots_per_shard: int = 1024,
    cap: float = 3.0,
    seed: int = 29,
    rows_per_tile: int = 2048,
) -> Mixture:
    """Mix all documents: sources in code-point order (null last) weigh 1, 2, 3, repeating.

    Null or blank texts have size 0 and give no words; a source without words has target 0. Every row counts
    by itself, also with a null or repeated id; equal rows are interchangeable, so reruns agree. An empty table
    gives an empty mixture. ``keep`` columns are held in one struct, so no name clashes.
    """
    n_words = F.coalesce(F.regexp_count(F.col(text_col), F.lit(WORD)), F.lit(0)).cast("long")
    ident = F.col(id_col).cast("long")
    h = seeded_hash(F.concat(F.coalesce(ident.cast("string"), F.lit("null")), F.lit(":"), F.coalesce(F.col(text_col), F.lit(""))), seed)
    row = F.struct(*[F.col(c) for c in keep or []]) if keep else F.lit(None).cast("string")
    rows = materialize(
        docs.select(row.alias("row"), ident.alias("id"), F.col(source_col).alias("src"), n_words.alias("size"), h.alias("h"), F.monotonically_increasing_id().alias("rid")),
        "mix-rows",
    )
    n_rows = rows.count()
    sources = _numbered(rows.groupBy("src").agg(F.sum("size").alias("size")))
    sources = water_fill(materialize(sources.withColumn("weight", F.col("sid") % 3 + 1), "mix-weights"), cap)
    sources = sources.withColumn("blocks", F.expr(f"(size + {block_words - 1}L) div {block_words}L"))
    quota = F.least(F.round(F.try_divide(F.col("target") * F.col("blocks"), F.col("size"))), F.floor(F.lit(cap) * F.col("blocks")))
    sources = sources.withColumn("quota", F.coalesce(quota, F.lit(0)).cast("long"))
    sources = materialize(running_base(sources, [], "sid", "quota", "lo"), "mix-sources")

    bits = bounded_tiles(n_rows, rows_per_tile)
    key = sources.select(F.col("src").alias("s2"), "sid")
    placed = rows.drop("row").join(key, F.col("src").eqNullSafe(F.col("s2"))).drop("src", "s2").withColumn("tile", hash_tile(F.col("h"), bits))
    tiles = running_base(placed.groupBy("sid", "tile").agg(F.sum("size").alias("n")), ["sid"], "tile", "n", "before")
    in_tile = Window.partitionBy("sid", "tile").orderBy("h", "id", "rid").rowsBetween(Window.unboundedPreceding, -1)
    documents = placed.withColumn("w", F.coalesce(F.sum("size").over(in_tile), F.lit(0))).join(
        tiles.select("sid", "tile", "before"), ["sid", "tile"]
    ).withColumn("off", F.col("w") + F.col("before"))
    blocks = f"sequence(off div {block_words}L, (off + size - 1) div {block_words}L)"
    nowhere = "array(-1L - pmod(rid, 4096L))"
    pieces = documents.select("rid", "id", "sid", "size", "h", "off", F.explode(F.expr(f"if(size > 0, {blocks}, {nowhere})")).alias("block")).select(
        "rid", "id", "sid", "size", "h", "block",
        F.expr(f"cast(greatest(0L, block * {block_words}L - off) as int)").alias("from_word"),
        F.expr(f"greatest(0L, off - block * {block_words}L)").alias("n_before"),
        F.expr(f"if(size > 0, least(off + size, (block + 1) * {block_words}L) - greatest(off, block * {block_words}L), 0L)").alias("n_words"),
    )
    return Mixture(rows, sources, _slots(sources, slots_per_shard, seed), pieces)


def _slots(sources: DataFrame, per_shard: int, seed: int) -> DataFrame:
    spark = sources.sparkSession
    n, m = sources.agg(F.count(F.lit(1)), F.coalesce(F.sum("quota"), F.lit(0))).first()
    # a range of drawn numbers for each pass over a source, cut at the borders of cells so that the join has a key; there
    # are as many cells as ranges, so that a draw meets few of them
    width = max(1, -(-m // max(1, min(2 * n, MOST_CELLS))))
    passes = sources.where("quota > 0").withColumn("pass", F.explode(F.expr("sequence(0L, (quota - 1) div blocks)"))).select(
        "sid", "blocks", F.expr("lo + pass * blocks").alias("lo"), F.expr("least(lo + quota, lo + (pass + 1) * blocks)").alias("hi"),
        keys_of(F.concat(F.lit(f"{seed}:"), F.col("sid").cast("string"), F.lit(":"), F.col("pass").cast("string")), "blocks").alias("keys"),
    )
    cells = materialize(passes.withColumn("cell", F.explode(F.expr(f"sequence(lo div {width}L, (hi - 1) div {width}L)"))), "mix-cells")
    drawn = spark.range(0, m, 1, max(spark.sparkContext.defaultParallelism, -(-m // (1 << 20)))).select(
        F.expr(f"id div {per_shard}L").alias("shard"), F.expr(f"id % {per_shard}L").alias("slot"),
        F.expr(permuted("id", f"{max(m, 1)}L", fixed_keys(f"{seed}:slots", max(m, 1)), m)).alias("u"),
    ).withColumn("cell", F.expr(f"u div {width}L"))
    met = drawn.join(cells, "cell").where("u >= lo and u < hi")
    return met.select("shard", "slot", "sid", F.expr(permuted("u - lo", "blocks", "keys", m + n)).alias("block"))


def mixed_documents(docs: DataFrame, seed: int = 29, **options) -> DataFrame:
    """Whole rows repeated as the mixture takes them: floor or ceiling of taken / size, by a seeded hash of id and text.

    A row of size 0 (a null or blank text) is dropped, as the mixture takes no words of it; a row with a null or
    repeated id is treated by itself. The columns are those of ``docs``, whatever their names; an empty table stays empty.
    """
    mix = mix_sources(docs, seed=seed, keep=docs.columns, **options)
    u = F.pmod(F.xxhash64(F.lit(seed + 3), F.col("h")), F.lit(1 << 30)) / F.lit(float(1 << 30))
    plan = mix.taken().where("size > 0").select("rid", F.floor(F.col("taken") / F.col("size") + u).cast("int").alias("copies")).where("copies > 0")
    out = mix.rows.select("rid", "row").join(plan, "rid")
    return out.select("row", F.explode(F.sequence(F.lit(1), F.col("copies")))).select("row.*")


def op8_mixing(spark, sf_dir: str) -> DataFrame:
    """All documents mixed: each one's words, its source's words and target, and the words the mix takes of it."""
    mix = mix_sources(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    sources = mix.sources.select("sid", F.col("src").alias("source"), F.col("size").alias("source_size"), "target")
    return mix.taken().join(sources, "sid").select(F.col("id").alias("doc_id"), "size", "source_size", "target", "taken", "source")
