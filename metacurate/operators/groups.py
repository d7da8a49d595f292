"""Grouped output that stays bounded: packed rows instead of one value per group."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from metacurate.operators.checkpoints import stored
from metacurate.operators.ranks import ranked

DEFAULT_PER_ROW = 1000


def pack_groups(
    rows: DataFrame,
    keys: Sequence[str],
    item: str,
    order: Sequence[str] | None = None,
    carry: str | None = None,
    into: str = "items",
    total: str = "n",
    part: str = "part",
    per_row: int = DEFAULT_PER_ROW,
) -> DataFrame:
    """Collect the distinct items of each group in order, ``per_row`` to an output row.

    Items are sorted by the ``order`` columns, if given, and by themselves; row
    ``part`` of a group holds the items from place ``part * per_row`` on, so the
    rows of a group in order of ``part`` are the sorted group. All groups follow
    this one rule: every item is kept, and no task holds more of a group than
    its share of the sorted rows. ``total`` is the full size of the group in
    every row. ``item`` identifies an element within its group; ``order`` columns
    are collected in front of it and a ``carry`` column behind it, as a struct.

    The rows are stored once, because sorting by range reads them twice.
    """
    columns = [*(order or []), item, *([carry] if carry else [])]
    placed = ranked(
        stored(rows.select(*keys, *columns), "groups"), keys, [*(order or []), item], rank="_place", total="_size"
    )
    element = F.struct(*columns) if len(columns) > 1 else F.col(item)
    packed = placed.groupBy(*keys, F.expr(f"_place DIV {per_row}").alias(part)).agg(
        F.max("_size").alias(total), F.array_sort(F.collect_list(F.struct("_place", element.alias("e")))).alias(into)
    )
    return packed.withColumn(into, F.transform(into, lambda x: x["e"]))


def joined_groups(
    rows: DataFrame,
    keys: Sequence[str],
    item: str,
    sep: str = ", ",
    into: str = "items",
    **options,
) -> DataFrame:
    """Distinct items of each group, sorted and joined to text, ``per_row`` to an output row; see ``pack_groups``."""
    packed = pack_groups(rows, keys, item, into=into, **options)
    return packed.withColumn(into, F.array_join(into, sep))
