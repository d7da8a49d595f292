"""Exact places of rows in sorted groups of any size."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from metacurate.operators.checkpoints import stored


def ranked(
    rows: DataFrame, group: Sequence[str], order: Sequence[str], rank: str = "rank", total: str | None = None
) -> DataFrame:
    """Add the place of each row in its group, from 0, and the group's size as ``total`` if asked for.

    Rows are sorted by range over ``group`` and ``order`` (ascending, NULL
    first) and stored; each partition counts its rows of each group, and the
    counts in front of a partition are the place of its first row. So a hot
    group is spread over as many tasks as it fills, and no task sees more than
    one partition. NULL is a group of its own; without ``group`` all rows are
    one. Rows that are equal in all these columns come in any order and stay in
    one partition, so ``order`` should tell rows apart. Names that start with
    ``_ranked`` are reserved.
    """
    keys = [*group, *order]
    placed = stored(
        rows.repartitionByRange(*keys).sortWithinPartitions(*keys).withColumn("_ranked_row", F.monotonically_increasing_id()),
        "ranked",
    ).withColumn("_ranked_part", F.shiftright("_ranked_row", 33))
    names = {k: f"_ranked_key{i}" for i, k in enumerate(group)}
    runs = (
        placed.groupBy(*[F.col(k).alias(name) for k, name in names.items()], F.col("_ranked_part").alias("_ranked_run"))
        .agg(F.min("_ranked_row").alias("_ranked_first"), F.count("*").alias("_ranked_n"))
    )
    # at most one row a partition in each group
    whole = Window.partitionBy(*names.values())
    before = whole.orderBy("_ranked_run").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.withColumn("_ranked_before", F.coalesce(F.sum("_ranked_n").over(before), F.lit(0)))
    if total:
        runs = runs.withColumn(total, F.sum("_ranked_n").over(whole))
    same = reduce(and_, [F.col(k).eqNullSafe(F.col(n)) for k, n in names.items()], F.col("_ranked_part") == F.col("_ranked_run"))
    place = F.col("_ranked_before") + F.col("_ranked_row") - F.col("_ranked_first")
    return placed.join(runs, same).select(*rows.columns, place.alias(rank), *([total] if total else []))
