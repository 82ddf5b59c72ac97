"""MinHash near-duplicates: banded candidates, sequential Bayesian pruning, exact confirmation.

Rows of equal words form one class, known by its smallest id; all that follows is on classes. A class goes under its band keys; classes that share a key belong to one family (found as connected
components of the stars of all keys), and only classes of a family can be linked. A family is cut into
tiles of bounded size; a tile, or a pair of tiles, is one unit of work. It takes the pairs that share a band,
compares their signatures in batches, drops a pair once the posterior chance that its similarity reaches the
threshold is below the chosen miss probability, and confirms what is left on full sets of shingles, told
apart by their words and not by hashes. Pairs exist only as array entries within a unit: a unit gives back
at most one link for each class, from its local component's smallest id. Linked pairs, not keys, decide the
components.

Tiles are first compared within themselves, at a cost that grows with the family, not its square. Many near
copies of one text are one component after that. Only where a family still has several components are
tiles compared with each other, and then only pairs across components: a further link within one can't change it.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import Words, exact_shingles, list_column, materialize, mix64, shingles, text_slices
from .graph import connected_components

HASHES, BATCH, TILE = 256, 32, 512


def miss_chance(threshold: float, bands: int, rows: int) -> float:
    """The chance that a pair at the threshold shares no band, all bands being drawn from the same hashes."""
    total = 0.0
    for m in range(HASHES + 1):
        ways = math.lgamma(HASHES + 1) - math.lgamma(m + 1) - math.lgamma(HASHES - m + 1)
        p = math.exp(ways + m * math.log(threshold) + (HASHES - m) * math.log1p(-threshold))
        total += p * (1 - math.comb(m, rows) / math.comb(HASHES, rows)) ** bands
    return total


def choose_bands(threshold: float, miss: float = 1e-6, most: int = 64) -> tuple[int, int]:
    """(bands, rows): the longest bands, and as few as will do, that miss a pair at the threshold with at most this probability."""
    for rows in range(16, 0, -1):
        if miss_chance(threshold, most, rows) <= miss:
            return next(b for b in range(1, most + 1) if miss_chance(threshold, b, rows) <= miss), rows
    return most, 1


def _picks(bands: int, rows: int, seed: int) -> np.ndarray:
    """The hashes of each band."""
    return np.stack([np.random.default_rng([seed, j]).choice(HASHES, rows, replace=False) for j in range(bands)])


def _band_values(low: np.ndarray, pick: np.ndarray) -> np.ndarray:
    """A key for each text (row of ``low``) and band."""
    keys = np.tile(np.arange(1, len(pick) + 1, dtype=np.uint64), (len(low), 1))
    for i in range(pick.shape[1]):
        keys = mix64(keys * np.uint64(0x9E3779B97F4A7C15) + low[:, pick[:, i]])
    return keys


def fewest_matches(threshold: float, miss: float) -> list[int]:
    """For each number of compared hashes (a multiple of the batch) the fewest matches that keep a pair.

    With a uniform prior, the similarity after m matches of n is Beta(m + 1, n - m + 1), and its chance to
    reach t is the chance of at most m successes in n + 1 trials of probability t.
    """
    out = []
    for n in range(BATCH, HASHES + 1, BATCH):
        total, m = 0.0, -1
        while True:
            k = m + 1
            total += math.exp(
                math.lgamma(n + 2) - math.lgamma(k + 1) - math.lgamma(n + 2 - k) + k * math.log(threshold) + (n + 1 - k) * math.log1p(-threshold)
            )
            if total >= miss:
                break
            m = k
        out.append(m + 1)
    return out


def _hash_family(seed: int) -> tuple[np.ndarray, np.ndarray]:
    r = np.random.default_rng(seed)
    return r.integers(0, 1 << 32, HASHES, np.uint32) | np.uint32(1), r.integers(0, 1 << 32, HASHES, np.uint32)


def _minima(values: np.ndarray, begin: np.ndarray, seed: int) -> np.ndarray:
    """MinHash values (texts x HASHES) of runs of shingle hashes, each run not empty."""
    a, x = _hash_family(seed)
    low = (values >> np.uint64(32)).astype(np.uint32)
    out = np.empty((len(begin), HASHES), np.uint32)
    tmp = np.empty_like(low)
    for k in range(HASHES):
        np.bitwise_xor(low, x[k], out=tmp)
        np.multiply(tmp, a[k], out=tmp)
        # the product's high bits depend on all bits of the value, so they come first
        out[:, k] = np.minimum.reduceat(tmp, begin)
    return out


def _shingled(batch: pa.RecordBatch, col: str, k: int, most: int = 1 << 19) -> Iterator[tuple[int, int, bytes, np.ndarray, np.ndarray, np.ndarray]]:
    """(first row, last row, bytes, offsets, shingle hashes, each row's range of them)."""
    for a, b, data, off in text_slices(batch, col, most):
        h, at = shingles(Words(data, off, lower=True), k)
        yield a, b, data.tobytes(), off, h, at


def band_keys(docs: DataFrame, id_col: str, text_col: str, k: int, threshold: float, seed: int) -> DataFrame:
    """(id, same, n, words, keys): a hash that tells rows of one id apart by text, the number of different shingles,
    a digest of the lower-cased words, and band keys (none without shingles)."""
    pick = _picks(*choose_bands(threshold), seed)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, raw, off, h, at in _shingled(batch, "t", k):
                sets = [np.unique(h[at[i] : at[i + 1]]) for i in range(b - a)]
                n = np.array([len(x) for x in sets])
                full = np.flatnonzero(n)
                # of the words themselves, so that equal digests mean equal sets
                digests = [hashlib.blake2b(b" ".join(raw[off[i] : off[i + 1]].lower().split()), digest_size=16).digest() for i in range(b - a)]
                count = np.zeros(b - a, np.int64)
                keys = np.zeros((0, len(pick)), np.uint64)
                if len(full):
                    flat = np.concatenate([sets[i] for i in full])
                    keys = _band_values(_minima(flat, np.concatenate([[0], np.cumsum(n[full])[:-1]]), seed), pick)
                    count[full] = len(pick)
                part = batch.slice(a, b - a)
                lists = list_column(keys.ravel().view(np.int64), np.concatenate([[0], np.cumsum(count)]), pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).cast(pa.int64()), part.column(1), pa.array(n, pa.int64()), pa.array(digests, pa.binary()), lists],
                    names=["id", "same", "n", "words", "keys"],
                )

    text = F.col(text_col)
    narrow = docs.select(F.col(id_col).cast("long").alias("id"), F.xxhash64(text).alias("same"), text.alias("t"))
    return narrow.mapInArrow(run, "id long, same long, n long, words binary, keys array<long>")


class _Forest:
    def __init__(self, n: int):
        self.up = list(range(n))

    def root(self, i: int) -> int:
        while self.up[i] != i:
            self.up[i] = i = self.up[self.up[i]]
        return i


def banded_pairs(keys: np.ndarray, side: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of rows that share a band key: across the two sides, or all where there is one side."""
    across = bool(side.any())
    left, right = (np.flatnonzero(side == 0), np.flatnonzero(side == 1)) if across else (np.arange(len(side)),) * 2
    share = np.zeros((len(left), len(right)), bool)
    for j in range(keys.shape[1]):
        share |= keys[left, j][:, None] == keys[right, j][None, :]
    i, j = np.nonzero(share if across else np.triu(share, 1))
    return left[i], right[j]


def link_unit(comp: np.ndarray, side: np.ndarray, sig: np.ndarray, sets_of, pick: np.ndarray, num: int, den: int, least: list[int]) -> list[tuple[int, int]]:
    """Links of one unit between components known so far: (smallest, other) for each other member of a local group of confirmed pairs.

    side 0 and 1 are the two tiles (only pairs across count), or all 0 within one tile. Pairs of one component are
    not compared. ``sets_of`` gives the exact shingles of rows, and is asked for those only that a pair survived with.
    """
    i, j = banded_pairs(_band_values(sig, pick), side)
    can = comp[i] != comp[j]
    i, j = i[can], j[can]
    got = np.zeros(len(i), np.int32)
    for step, need in enumerate(least):
        part = slice(step * BATCH, (step + 1) * BATCH)
        for c in range(0, len(i), 1 << 16):
            got[c : c + (1 << 16)] += (sig[i[c : c + (1 << 16)], part] == sig[j[c : c + (1 << 16)], part]).sum(1, dtype=np.int32)
        keep = got >= need
        i, j, got = i[keep], j[keep], got[keep]
    if not len(i):
        return []
    sets = sets_of(np.unique(np.concatenate([i, j])))
    names, where = np.unique(comp, return_inverse=True)
    forest = _Forest(len(names))
    for p in np.argsort(-got, kind="stable"):
        x, y = int(i[p]), int(j[p])
        a, b = forest.root(int(where[x])), forest.root(int(where[y]))
        if a != b:
            both = len(np.intersect1d(sets[x], sets[y], assume_unique=True))
            if den * both >= num * (len(sets[x]) + len(sets[y]) - both):
                forest.up[b] = a
    groups: dict[int, list[int]] = {}
    for x, name in enumerate(names.tolist()):
        groups.setdefault(forest.root(x), []).append(name)
    return [(min(g), x) for g in groups.values() if len(g) > 1 for x in g if x != min(g)]


def _links(placed: DataFrame, k: int, num: int, den: int, miss: float, seed: int) -> DataFrame:
    """Confirmed links (a, b) between components of (family, comp, tile, others, t); others are the tiles a row meets."""
    least, pick = fewest_matches(num / den, miss), _picks(*choose_bands(num / den), seed)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, _, _, h, at in _shingled(batch, "t", k):
                # low bits of the minima: all of a minimum's high bits are near zero
                sig = (_minima(h, at[:-1], seed) & np.uint32(0xFFFF)).astype(np.uint16)
                part = batch.slice(a, b - a)
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array([s.tobytes() for s in sig], pa.binary())], names=["family", "comp", "tile", "others", "t", "sig"])

    def unit(rows: list[tuple]) -> list[tuple[int, int]]:
        def sets_of(chosen: np.ndarray) -> dict[int, np.ndarray]:
            text = pa.RecordBatch.from_arrays([pa.array([rows[i][3] for i in chosen], pa.large_string())], names=["t"])
            ((_, _, data, off),) = text_slices(text, "t", 1 << 62)
            s, at = exact_shingles(Words(data, off, lower=True), k)
            return {int(i): np.unique(s[at[x] : at[x + 1]]) for x, i in enumerate(chosen)}

        comp, side = np.array([r[0] for r in rows]), np.array([r[1] for r in rows])
        sig = np.frombuffer(b"".join(r[2] for r in rows), np.uint16).reshape(len(rows), HASHES)
        return link_unit(comp, side, sig, sets_of, pick, num, den, least)

    def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # rows come sorted by unit; a unit has two tiles at most
        at, rows, out = None, [], []
        for batch in batches:
            cols = [batch.column(n).to_pylist() for n in ("family", "t1", "t2", "comp", "side", "sig", "t")]
            for f, t1, t2, *row in zip(*cols, strict=True):
                if (f, t1, t2) != at:
                    out += unit(rows) if len(rows) > 1 else []
                    at, rows = (f, t1, t2), []
                rows.append(tuple(row))
            if len(out) > 10_000:
                yield pa.RecordBatch.from_arrays([pa.array([x[s] for x in out], pa.int64()) for s in (0, 1)], names=["a", "b"])
                out = []
        out += unit(rows) if len(rows) > 1 else []
        yield pa.RecordBatch.from_arrays([pa.array([x[s] for x in out], pa.int64()) for s in (0, 1)], names=["a", "b"])

    coded = placed.select("family", "comp", "tile", "others", "t").mapInArrow(
        encode, "family long, comp long, tile int, others array<int>, t string, sig binary"
    )
    units = coded.withColumn("other", F.explode("others")).select(
        "family", F.least("tile", "other").alias("t1"), F.greatest("tile", "other").alias("t2"), "comp", (F.col("tile") > F.col("other")).cast("int").alias("side"), "sig", "t"
    )
    return units.repartition("family", "t1", "t2").sortWithinPartitions("family", "t1", "t2").mapInArrow(link, "a long, b long")


def _apart(members: DataFrame, root: DataFrame) -> DataFrame:
    """(family, comp, id, tile, others) of the families whose members are in several components, ready for ``_links``.

    A component of half a tile or more has tiles of its own, which don't meet each other; the members of all
    smaller ones share tiles, which meet every tile.
    """
    m = members.join(root.select("id", F.col("root").alias("comp")), "id", "left").select("id", "family", F.coalesce("comp", "id").alias("comp"))
    m = materialize(m, "near-members")
    sizes = m.groupBy("family", "comp").agg(F.count(F.lit(1)).alias("n"))
    own = F.when(F.col("n") * 2 >= TILE, F.ceil(F.col("n") / TILE)).otherwise(F.lit(0)).cast("int")
    sizes = materialize(sizes.withColumn("own", own), "near-sizes")
    whole = sizes.groupBy("family").agg(
        F.count(F.lit(1)).alias("comps"), F.sum("own").cast("int").alias("owned"), F.ceil(F.sum(F.when(F.col("own") == 0, F.col("n")).otherwise(F.lit(0))) / TILE).cast("int").alias("shared")
    ).where("comps > 1").select("family", "shared", (F.col("shared") + F.col("owned")).alias("tiles"))
    before = Window.partitionBy("family").orderBy("comp").rowsBetween(Window.unboundedPreceding, -1)
    ranges = sizes.where("own > 0").select("family", "comp", "own", F.coalesce(F.sum("own").over(before), F.lit(0)).cast("int").alias("at"))
    ranges = materialize(ranges, "near-ranges")
    placed = m.join(whole, "family").join(ranges, ["family", "comp"], "left").withColumn("at", F.col("at") + F.col("shared"))
    spread = lambda n: F.pmod(F.xxhash64(F.lit(1), "id"), n).cast("int")
    every = F.sequence(F.lit(0), F.col("tiles") - 1)
    return placed.select(
        "family", "comp", "id",
        F.when(F.col("at").isNull(), spread(F.col("shared"))).otherwise(F.col("at") + spread(F.col("own"))).cast("int").alias("tile"),
        F.when(F.col("at").isNull(), every).otherwise(F.filter(every, lambda i: (i < F.col("at")) | (i >= F.col("at") + F.col("own")))).alias("others"),
    )


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle_words: int = 5, num: int = 80, den: int = 100, miss: float = 1e-6, seed: int = 41
) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept, same) for each row; pairs with den * |A & B| >= num * |A | B| are linked.

    A text without words (or null) has no shingles and links with nothing; a text of fewer words than a
    shingle is one shingle. Rows with a null id keep themselves and link nothing (component null). Rows
    that repeat an id are compared by each one's own text, which ``same`` (a hash of it) tells apart. Only the id
    and text columns are read. An empty table gives no rows.
    """
    keyed = materialize(band_keys(docs, id_col, text_col, shingle_words, num / den, seed), "near-keys")
    # aggregates that are joined again are tables of their own: a join of two plain exchanges can split hot partitions
    classes = materialize(keyed.where("n > 0 and id is not null").groupBy("words").agg(F.min("id").alias("class")), "near-classes")
    reps = keyed.where("n > 0").select("id", "keys", "words").join(classes, "words").where("id = class")
    under = reps.select("id", F.explode("keys").alias("key"))
    shared = materialize(under.groupBy("key").agg(F.min("id").alias("lead"), F.max("id").alias("last")).where("lead < last").select("key", "lead"), "near-shared")
    star = under.join(shared, "key").where("id != lead").select(F.col("lead").alias("a"), F.col("id").alias("b")).distinct()
    family = connected_components(star)
    sizes = family.groupBy("root").agg(F.count(F.lit(1)).alias("m"))
    family = family.join(sizes, "root").select("id", F.col("root").alias("family"), F.ceil(F.col("m") / TILE).cast("int").alias("tiles"))
    text = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("t")).where(F.col("t").isNotNull())
    # merged at every size: texts are many, and so, in the end, are the members of families
    # written once, so that a second comparison reads and shuffles texts of families alone
    near = materialize(family.join(text.hint("merge"), "id"), "near-texts")
    tile = F.pmod(F.xxhash64("id"), F.col("tiles")).cast("int")
    link = lambda placed: materialize(_links(placed, shingle_words, num, den, miss, seed), "near-links")
    root = connected_components(link(near.select("family", F.col("id").alias("comp"), tile.alias("tile"), F.array(tile).alias("others"), "t")))
    wide = family.where("tiles > 1").select("id", "family")
    if wide.limit(1).count():
        apart = materialize(_apart(wide, root), "near-apart")
        if apart.limit(1).count():
            top = connected_components(link(apart.join(near.select("id", "t").hint("merge"), "id"))).select(F.col("id").alias("comp"), F.col("root").alias("top"))
            known = family.select("id").join(root, "id", "left").select("id", F.coalesce("root", "id").alias("comp"))
            root = known.join(top, "comp", "left").select("id", F.coalesce("top", "comp").alias("root"))
    root = root.withColumnRenamed("id", "class")
    out = keyed.select("id", "same", "n", "words").join(classes, "words", "left").join(root, "class", "left")
    component = F.when(F.col("n") > 0, F.coalesce("root", "class", "id")).otherwise(F.col("id"))
    out = out.select(F.col("id").alias("doc_id"), F.col("n").alias("n_shingles"), F.when(F.col("id").isNotNull(), component).alias("component_id"), "same")
    return out.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def op10_minhash(spark, sf_dir: str) -> DataFrame:
    """Near-duplicate components of all documents on sets of three-word shingles, at similarity 0.85 or more."""
    found = near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet"), shingle_words=3, num=85, den=100)
    return found.select("doc_id", "n_shingles", "component_id", "kept")
