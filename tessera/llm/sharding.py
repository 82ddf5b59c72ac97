"""Proportional stratified interleaving into shards, with DataFrame functions only.

Rows get a seeded random rank within their source; sorting all rows by (rank + 1/2) / size of the
source deals every source out evenly, so any contiguous cut of that order has the mixture of the whole.
Ranks come from two levels: a row's rank within a small hash tile plus the rows in smaller tiles,
so neither a hot source nor the global order ever sits in one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import bounded_tiles, hash_tile, materialize, running_base, seeded_hash


def stratified_shards(
    docs: DataFrame,
    n_shards: int,
    id_col: str = "doc_id",
    source_col: str = "source",
    keep: list[str] | None = None,
    seed: int = 17,
    rows_per_tile: int = 2048,
) -> DataFrame:
    """Each row's ``shard`` (from 0) and ``slot`` (gapless from 0 in its shard), beside the ``keep`` columns.

    Shard sizes differ by one row at most, and each source's rows are spread over the order evenly.
    A null source is a source of its own; rows with a null or repeated id each get a place of their own
    (ties are broken by the order in which the rows are read).
    An empty table gives no rows. Work columns never clash with those of ``keep``, but ``keep`` must not hold ``shard`` or ``slot``.
    """
    if n_shards < 1:
        raise ValueError("n_shards must be positive")
    keep = docs.columns if keep is None else keep
    # wide rows are written once under a row number; only narrow rows take part in the ranking
    row = F.struct(*[F.col(c) for c in keep]).alias("row")
    base = docs.select(row, F.col(id_col).alias("id"), F.col(source_col).alias("src"), F.monotonically_increasing_id().alias("rid"))
    base = materialize(base, "shard-rows")
    n = base.count()
    bits = bounded_tiles(n, rows_per_tile)
    h = seeded_hash(F.coalesce(F.col("id").cast("string"), F.lit("null")), seed)
    narrow = base.select("rid", "id", "src", h.alias("h")).withColumn("tile", hash_tile(F.col("h"), bits))
    tiles = narrow.groupBy("src", "tile").agg(F.count(F.lit(1)).alias("n"))
    sizes = materialize(base.groupBy("src").agg(F.count(F.lit(1)).alias("size")), "shard-sizes")
    tiles = running_base(tiles, ["src"], "tile", "n", "before").join(sizes.withColumnRenamed("src", "s1"), F.col("src").eqNullSafe(F.col("s1")))
    # rank within the source: within the tile, plus the rows of the source's smaller tiles
    in_tile = Window.partitionBy("src", "tile").orderBy("h", "id", "rid")
    t = tiles.select(F.col("src").alias("s2"), F.col("tile").alias("t2"), "before", "size")
    ranked = narrow.withColumn("r", F.row_number().over(in_tile)).join(
        t, F.col("src").eqNullSafe(F.col("s2")) & (F.col("tile") == F.col("t2"))
    )
    # odd = 2 * rank + 1, so the fractional rank is odd / (2 * size) exactly; band b holds [b, b + 1) / n_bands
    n_bands = max(1, n // rows_per_tile)
    ranked = ranked.withColumn("odd", 2 * (F.col("r") + F.col("before")) - 1).withColumn(
        "band", F.expr(f"(odd * {n_bands}L) div (2L * size)")
    )
    # rows of each source in each band follow from its size alone, so no second pass over the rows
    small = sizes.where(F.col("size") <= n_bands).select(
        F.explode(F.sequence(F.lit(1).cast("long"), F.col("size"))).alias("i"), "size"
    ).select(F.expr(f"((2L * i - 1L) * {n_bands}L) div (2L * size)").alias("band"), F.lit(1).cast("long").alias("c"))
    below = lambda b: f"(((2L * size * ({b}) - 1L) div {n_bands}L + 1L) div 2L)"  # noqa: E731  ranks under the band's lower edge
    large = sizes.where(F.col("size") > n_bands).select(
        F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n_bands - 1).cast("long"))).alias("band"), "size"
    ).select("band", F.expr(f"{below('band + 1')} - if(band = 0, 0L, {below('band')})").alias("c"))
    bands = small.unionAll(large).groupBy("band").agg(F.sum("c").alias("c"))
    bands = running_base(bands, [], "band", "c", "start").select(F.col("band").alias("b2"), "start")
    in_band = Window.partitionBy("band").orderBy(F.col("odd") / F.col("size"), "src", "odd")
    placed = (
        ranked.withColumn("k", F.row_number().over(in_band))
        .join(bands, F.col("band") == F.col("b2"))
        .withColumn("pos", F.col("start") + F.col("k") - 1)
    )
    shard = F.expr(f"(pos * {n_shards}L) div {max(n, 1)}L")
    first = F.expr(f"(shard * {max(n, 1)}L + {n_shards - 1}L) div {n_shards}L")
    placed = placed.withColumn("shard", shard).withColumn("slot", F.col("pos") - first)
    where = placed.select("rid", F.col("shard").cast("int").alias("shard"), F.col("slot").cast("long").alias("slot"))
    return base.select("rid", "row").join(where, "rid").select("row.*", "shard", "slot")


def op1_sharding(spark, sf_dir: str) -> DataFrame:
    """All documents into shards 0 to 23, counts at most one apart, each with the mixture of sources."""
    text = F.coalesce(F.col("text"), F.lit(""))
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select(
        "doc_id", "source", (F.octet_length(text) + 8).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32")
    )
    out = stratified_shards(docs, 24, keep=["doc_id", "source", "size", "text_crc32"])
    return out.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"), "source"
    )
