"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from metacurate.operators.checkpoints import stored
from metacurate.operators.joins import join_unique

BROADCAST_ROWS = 1 << 20
ROWS_PER_TASK = 1 << 16


def components(links: DataFrame) -> DataFrame:
    """``node, component`` for every node of ``links(a, b)``; the component is its smallest node.

    Each round a node takes the label of the smallest label among its neighbours
    and itself, so paths halve. Labels are stored each round, which cuts the
    lineage. Labels of at most 2**20 links are broadcast, and written by as many tasks as they fill, so that a round
    costs one grouping; beyond that, hot nodes are split by the joins. Links to null are ignored.
    """
    pairs = links.where("a IS NOT NULL AND b IS NOT NULL AND a <> b").select("a", "b")
    tasks = max(1, -(-4 * pairs.count() // ROWS_PER_TASK))
    # both ways, and from each node to itself
    both = stored(
        pairs.select(F.explode(F.array(*[F.struct(F.col(x).alias("a"), F.col(y).alias("b")) for x, y in ("ab", "ba", "aa", "bb")])).alias("l"))
        .select("l.*").distinct().coalesce(tasks),
        "links",
    )
    n = both.count()

    def labelled(df: DataFrame, labels: DataFrame, key: str, label: str) -> DataFrame:
        known = labels.select(F.col("node").alias(key), F.col("component").alias(label))
        return df.join(F.broadcast(known), key) if n <= BROADCAST_ROWS else join_unique(df, known, key)

    labels = stored(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("component")).coalesce(tasks), "labels")
    moved = n > 0
    while moved:
        own = F.min(F.when(F.col("a") == F.col("b"), F.col("m")))
        nearest = labelled(both, labels, "b", "m").groupBy(F.col("a").alias("node")).agg(F.min("m").alias("m"), own.alias("before"))
        labels = stored(
            labelled(nearest, labels, "m", "component")
            .select("node", "component", (F.col("component") < F.col("before")).alias("moved")).coalesce(tasks),
            "labels",
        )
        moved = not labels.where("moved").isEmpty()
    return labels.select("node", "component")
