"""Connected components by minimum labels, in rounds of joins and aggregations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(id, root) of every vertex of ``edges``: root is the smallest id of its component.

    Each round gives every vertex, and the vertex it points to, the smallest label among its neighbours,
    then halves the path to the root; the number of rounds is logarithmic in practice. Every round is
    written to the shared folder, so a lost executor costs the tasks of one round at most.
    """
    e = edges.select(F.col(a).alias("u"), F.col(b).alias("v")).where("u != v")
    e = materialize(e.union(e.select("v", "u")).distinct(), "cc-edges")
    label = materialize(e.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("id"), F.least("u", "m").alias("root")), "cc-labels")
    while True:
        near = e.join(label.select(F.col("id").alias("v"), F.col("root").alias("rv")), "v").groupBy("u").agg(F.min("rv").alias("m"))
        near = near.join(label.select(F.col("id").alias("u"), F.col("root").alias("ru")), "u").where("m < ru")
        hooks = near.select(F.col("u").alias("id"), "m").union(near.select(F.col("ru").alias("id"), "m")).groupBy("id").agg(F.min("m").alias("m"))
        new = label.join(hooks, "id", "left").select("id", F.least("root", "m").alias("root"), F.col("root").alias("old"))
        new = materialize(new, "cc-hooked")
        jump = new.select(F.col("id").alias("root"), F.col("root").alias("up"))
        new = materialize(new.join(jump, "root").select("id", F.least("root", "up").alias("root"), (F.col("up") < F.col("old")).alias("moved")), "cc-labels")
        label = new.select("id", "root")
        if not new.where("moved").limit(1).count():
            return label
