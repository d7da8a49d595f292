"""Joins to a side that has one row per key, for a left side whose keys may be hot."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

def join_unique(left: DataFrame, right: DataFrame, on: str | Sequence[str], how: str = "inner") -> DataFrame:
    """Join rows to a table that was grouped or made distinct by the key. NULL keys match nothing.

    AQE splits a hot key only if both sides of a sort-merge join come straight
    from a shuffle. A grouped side does not: it is already partitioned by the
    key and is used as it is, so all rows of a hot left key would end up in one
    task. Comparing null-safely makes Spark shuffle the (small, unique) grouped
    side once more, and also keeps a later grouping by this key and others from
    reusing the skewed partitioning.
    """
    keys = [on] if isinstance(on, str) else list(on)
    renamed = {k: f"_unique_{k}" for k in keys}
    keyed = right.withColumnsRenamed(renamed)
    for k in renamed.values():
        keyed = keyed.where(F.col(k).isNotNull())
    same = reduce(and_, [left[k].eqNullSafe(keyed[r]) for k, r in renamed.items()])
    return left.join(keyed, same, how).drop(*renamed.values())


def keep_matching(df: DataFrame, keys: DataFrame, on: str) -> DataFrame:
    """Rows whose key occurs in ``keys``. Keys are made distinct first, so a hot key is sent once."""
    return join_unique(df, keys.select(on).distinct(), on, "left_semi")


def drop_matching(df: DataFrame, keys: DataFrame, on: str) -> DataFrame:
    """Rows whose key does not occur in ``keys``; rows without a key stay."""
    return join_unique(df, keys.select(on).distinct(), on, "left_anti")
