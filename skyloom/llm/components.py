"""Connected components of an edge table, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyloom.session import shared_dir

#: Rounds after which something must be wrong: their number grows with the logarithm of a component.
MAX_ROUNDS = 60


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of edges(a, b) that is not its component's least node.

    Each round points every node at the least node it knows of; a round's edges
    are checkpointed, so that lost executors cost one round. Self edges and
    repeats are ignored; no edges give no rows.
    """
    shared_dir(edges.sparkSession)
    now = edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct().checkpoint()
    seen = _mark(now)
    for _ in range(MAX_ROUNDS):
        if not seen[0]:
            break
        both = now.union(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        # written, so that both sides of the join are plain shuffles: then AQE splits the rows of a hub, as it cannot above an aggregation
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")).checkpoint()
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.when(F.col("v") == F.col("m"), F.col("u")).otherwise(F.col("v")).alias("u"), F.col("m").alias("v")).union(low)
        now = small.where("u <> v").distinct().checkpoint()
        before, seen = seen, _mark(now)
        if before == seen:
            break
    else:
        raise RuntimeError("components did not settle")
    return now.select(F.col("u").alias("node"), F.col("v").alias("root"))


def _mark(edges: DataFrame) -> tuple[int, int]:
    row = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
    return row.n, int(row.h or 0)
