"""Order-dependent greedy folds with reset: padded batches and duration-bounded shards.

Where a group ends depends on where it began, so a running sum over a window gives other boundaries: every
group starts afresh after the overshoot of the one before. The fold is a small state machine, and it runs
over chunks of the total order (source files, say) in parallel: each chunk first assumes that nothing is
open where it begins; then it runs again from the state that the chunk before it ended with, until no
chunk's end changes any more. Chunk 0 is right at once and every round settles at least the next one, so
the result is that of one long run; groups are short beside chunks, so that runs from different states
soon cut at the same row, and two rounds are the rule. Only the split, the order keys and the duration
take part.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..storage import stored

State = tuple[float, float]
NOTHING_OPEN: State = (0.0, 0.0)


class Padded:
    """Cost is rows times the longest: close before a row that would exceed the budget, or once it is reached.

    The state is the rows of the open group and its longest.
    """

    def __init__(self, budget: float):
        self.budget = budget

    def step(self, state: State, s: float) -> tuple[bool, State]:
        n, longest = state
        if n and max(longest, s) * (n + 1) > self.budget:
            n, longest = NOTHING_OPEN
        first = n == 0
        n, longest = n + 1, max(longest, s)
        return first, NOTHING_OPEN if longest * n >= self.budget else (n, longest)


class Duration:
    """Whole items are added; once the sum reaches the target, the next item begins another group.

    The state is whether a group is open, and its sum.
    """

    def __init__(self, target: float):
        self.target = target

    def step(self, state: State, s: float) -> tuple[bool, State]:
        is_open, total = state
        total = total + s if is_open else s
        return not is_open, NOTHING_OPEN if total >= self.target else (1.0, total)


Rule = Padded | Duration


def _walk(rule: Rule, batches: Iterator[pd.DataFrame]) -> Iterator[tuple[pd.DataFrame, list[int], list[tuple]]]:
    """Runs the rule over rows sorted by (split, chunk, ...), from each chunk's a, b and group.

    Gives each batch of rows with their groups, and the chunks that ended: (split, chunk, starts, a, b).
    """
    at, state, group, base = None, NOTHING_OPEN, -1, -1

    def end() -> list[tuple]:
        return [] if at is None else [(*at, group - base, *state)]

    rows = None
    for rows in batches:
        groups, ended = [], []
        for split, chunk, s, a, b, g in zip(rows["split"], rows["chunk"], rows["s"], rows["a"], rows["b"], rows["g"], strict=True):
            if (split, chunk) != at:
                ended += end()
                at, state, group, base = (split, chunk), (a, b), g, g
            first, state = rule.step(state, s)
            group += first
            groups.append(group)
        yield rows, groups, ended
    if at is not None:
        yield rows.iloc[:0], [], end()


def fold_groups(
    rows: DataFrame, split: str, order: list[str], seconds: str, rule: Rule, out: str, chunk: Column | None = None, single_chunk_rows: int = 1_000_000
) -> DataFrame:
    """Adds ``out``, the number of the row's group within its split, from 0.

    Rows of a split are totally ordered by ``order``. ``chunk`` must not fall along that order; it is the
    first order column if not given. Splits of up to ``single_chunk_rows`` rows are one chunk. A null
    duration counts as zero, null splits and chunks are values of their own; a column named like the result
    is replaced. An empty table gives no rows.
    """
    keep = [c for c in rows.columns if c != out]
    keys = [f"o{i}" for i in range(len(order))]
    narrow = rows.select(
        F.col(split).alias("split"), (F.col(order[0]) if chunk is None else chunk).cast("string").alias("name"), (F.col(order[0]) if chunk is None else chunk).alias("rank"),
        *[F.col(c).alias(k) for c, k in zip(order, keys, strict=True)], F.coalesce(F.col(seconds), F.lit(0.0)).cast("double").alias("s"),
    )
    sizes = narrow.groupBy("split").agg(F.count(F.lit(1)).alias("n"))
    one = (sizes.agg(F.max("n")).first()[0] or 0) <= single_chunk_rows
    narrow = narrow.withColumn("chunk", F.lit("") if one else F.coalesce("name", F.lit(""))).drop("name")
    kinds = {f.name: f.dataType.simpleString() for f in narrow.schema}
    start = [F.lit(0.0).alias("a"), F.lit(0.0).alias("b"), F.lit(-1).cast("bigint").alias("g")]

    def runs(df: DataFrame) -> DataFrame:
        return df.repartition("split", "chunk").sortWithinPartitions("split", "chunk", *keys).select("split", "chunk", *keys, "s", "a", "b", "g")

    def mark(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b, groups, _ in _walk(rule, batches):
            yield b[["split", *keys]].assign(**{out: pd.Series(groups, index=b.index, dtype="int64")})

    def ends(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for _, _, ended in _walk(rule, batches):
            if ended:
                yield pd.DataFrame(ended, columns=["split", "chunk", "starts", "a", "b"])

    if one:
        ready = narrow.select("*", *start)
    else:
        narrow = stored(narrow, "fold-rows")
        by = Window.partitionBy("split").orderBy("rank")
        chunks = narrow.groupBy("split", "chunk").agg(F.min("rank").alias("rank")).select("*", *start)
        ends_ddl = f"split {kinds['split']}, chunk string, starts bigint, a double, b double"
        done, todo = None, chunks
        while True:
            here = narrow.join(todo.select(F.col("split").alias("s2"), F.col("chunk").alias("c2"), "a", "b", "g"), F.col("split").eqNullSafe(F.col("s2")) & (F.col("chunk") == F.col("c2")))
            new = runs(here).mapInPandas(ends, ends_ddl)
            new = todo.select("split", "chunk", "rank", F.col("a").alias("in_a"), F.col("b").alias("in_b")).alias("x").join(
                new.select(F.col("split").alias("s3"), F.col("chunk").alias("c3"), "starts", "a", "b"), F.col("split").eqNullSafe(F.col("s3")) & (F.col("chunk") == F.col("c3"))
            ).drop("s3", "c3")
            if done is not None:
                kept = done.join(new.select(F.col("split").alias("s4"), F.col("chunk").alias("c4")), F.col("split").eqNullSafe(F.col("s4")) & (F.col("chunk") == F.col("c4")), "left_anti")
                new = kept.unionByName(new)
            done = stored(new, "fold-ends")
            before = done.withColumn("na", F.coalesce(F.lag("a").over(by), F.lit(0.0))).withColumn("nb", F.coalesce(F.lag("b").over(by), F.lit(0.0)))
            todo = stored(before.where("na <> in_a or nb <> in_b").select("split", "chunk", "rank", F.col("na").alias("a"), F.col("nb").alias("b"), start[2]), "fold-todo")
            if todo.isEmpty():
                break
        earlier = by.rowsBetween(Window.unboundedPreceding, -1)
        begin = done.select(F.col("split").alias("s2"), F.col("chunk").alias("c2"), F.col("in_a").alias("a"), F.col("in_b").alias("b"), (F.coalesce(F.sum("starts").over(earlier), F.lit(0)) - 1).alias("g"))
        ready = narrow.join(begin, F.col("split").eqNullSafe(F.col("s2")) & (F.col("chunk") == F.col("c2")))
    marked = runs(ready).mapInPandas(mark, ", ".join(f"{k} {kinds[k]}" for k in ["split", *keys]) + f", {out} bigint")
    marked = marked.select(F.col("split").alias("split__"), *[F.col(k).alias(f"{k}__") for k in keys], out)
    cond = F.col(split).eqNullSafe(F.col("split__"))
    for c, k in zip(order, keys, strict=True):
        cond = cond & F.col(c).eqNullSafe(F.col(f"{k}__"))
    return rows.select(*keep).join(marked, cond).select(*keep, out)


def padded_batches(rows: DataFrame, split: str, order: list[str], seconds: str, budget: float, **options) -> DataFrame:
    """Adds batch_id."""
    return fold_groups(rows, split, order, seconds, Padded(budget), "batch_id", **options)


def duration_shards(rows: DataFrame, split: str, order: list[str], seconds: str, target: float, **options) -> DataFrame:
    """Adds shard_index to rows that have a batch_id: whole batches go to a shard until it reaches the target."""
    totals = rows.groupBy(F.col(split).alias("bs"), F.col("batch_id").alias("bb")).agg(F.sum(seconds).alias("batch_seconds"))
    pages = F.expr("bb div 65536")
    shards = fold_groups(totals, "bs", ["bb"], "batch_seconds", Duration(target), "shard_index", pages, **options).select("bs", "bb", "shard_index")
    return rows.join(shards, F.col(split).eqNullSafe(F.col("bs")) & (F.col("batch_id") == F.col("bb"))).drop("bs", "bb")


def fill_budget(items: list[float], budget: float) -> list[int]:
    """Positions, cyclically, of the first padded batch."""
    rule, state, picked = Padded(budget), NOTHING_OPEN, []
    while items:
        first, state = rule.step(state, items[len(picked) % len(items)])
        if first and picked:
            break
        picked.append(len(picked) % len(items))
        if state == NOTHING_OPEN:
            break
    return picked
