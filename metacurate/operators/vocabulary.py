"""Controlled vocabularies: lookup of allowed values, conformance, union."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType

from metacurate.operators.groups import joined_groups, pack_groups
from metacurate.operators.joins import keep_matching
from metacurate.presets import COMMON_PREFIX


def allowed_for(
    nodes: DataFrame, allowed: DataFrame, common_file: str, prefix: str = COMMON_PREFIX
) -> DataFrame:
    """Add the allowed values of each ``(file, name, type)`` node: by type, else by name.

    A type with the shared prefix is looked up without it in the shared file, and
    so is its name. ``allowed`` is ``(file, tag, allowed)``; of a tag that a file
    repeats the smallest list counts.
    """
    allowed = allowed.groupBy("file", "tag").agg(F.min("allowed").alias("allowed"))
    shared = F.coalesce(F.col("type").startswith(prefix), F.lit(False))
    keyed = nodes.withColumns(
        {
            "_file": F.when(shared, F.lit(common_file)).otherwise(F.col("file")),
            "_type": F.when(shared, F.substring("type", len(prefix) + 1, 2147483647)).otherwise(F.col("type")),
        }
    )
    by_type = allowed.select(
        F.col("file").alias("_file"), F.col("tag").alias("_type"), F.col("allowed").alias("_by_type")
    )
    by_name = allowed.select(
        F.col("file").alias("_file"), F.col("tag").alias("name"), F.col("allowed").alias("_by_name")
    )
    joined = keyed.join(by_type, ["_file", "_type"], "left").join(by_name, ["_file", "name"], "left")
    return joined.select(*nodes.columns, F.coalesce("_by_type", "_by_name").alias("allowed"))


def vocabulary_terms(allowed: DataFrame, key: Sequence[str] = ("file", "tag")) -> DataFrame:
    """Vocabulary lists in long form, one distinct ``(…key, value)`` row each."""
    return allowed.select(*key, F.explode("allowed").alias("value")).distinct()


def conformance(values: DataFrame, terms: DataFrame, column: str = "column") -> DataFrame:
    """Values outside their column's vocabulary, with their number of occurrences.

    ``values`` is ``(column, value)`` rows, counted before anything is joined, so
    only distinct values travel. Columns without a vocabulary are not judged.
    NULL values are nothing to judge.
    """
    counted = values.where(F.col("value").isNotNull()).groupBy(column, "value").agg(F.count("*").alias("n"))
    governed = keep_matching(counted, terms, column)
    return governed.join(terms.select(column, "value"), [column, "value"], "left_anti")


def offender_samples(
    values: DataFrame, terms: DataFrame, k: int = 10, column: str = "column", key: str = "id"
) -> DataFrame:
    """Values outside their column's vocabulary, ``(column, value, n, ids)``: occurrences and ``k`` of the records.

    ``values`` is ``(column, value, id)`` rows. The sample of a value is the
    records with the smallest hash (MD5) of their id: every record has the same
    chance, equal data give equal samples, and the smallest of parts are merged.
    So each task passes on at most ``k`` records of a value before anything is
    shuffled, however many there are; a record counts once in the sample.
    """
    given = values.where(F.col("value").isNotNull() & F.col(key).isNotNull())
    hashed = given.select(column, "value", F.col(key).alias("_id"), F.md5(F.col(key).cast("string").cast("binary")).alias("_hash"))
    order = Window.partitionBy(column, "value").orderBy("_hash", "_id")
    smallest = hashed.withColumn("_place", F.dense_rank().over(order)).where(F.col("_place") <= k)
    picked = smallest.groupBy(column, "value").agg(F.array_sort(F.collect_set(F.struct("_hash", "_id"))).alias("picked"))
    found = conformance(values.select(column, "value"), terms, column)
    none = F.array().cast(ArrayType(values.schema[key].dataType))
    ids = F.coalesce(F.transform("picked", lambda p: p["_id"]), none).alias("ids")
    return found.join(picked, [column, "value"], "left").select(column, "value", "n", ids)


def vocabulary_union(lists: DataFrame, column: str = "column") -> DataFrame:
    """Distinct values per column over several lists, with the place each was first seen.

    ``lists`` is ``(column, list_pos, value_pos, value)``. Sort by ``list_pos,
    value_pos`` for first-seen order.
    """
    first = F.min(F.struct("list_pos", "value_pos")).alias("f")
    return lists.groupBy(column, "value").agg(first).select(column, "value", "f.list_pos", "f.value_pos")


def vocabulary_lines(union: DataFrame, column: str = "column", per_row: int = 1000) -> DataFrame:
    """First-seen-order value lists, ``(column, part, n, values)``; long lists take several rows, in order of ``part``."""
    packed = pack_groups(union, [column], "value", order=["list_pos", "value_pos"], into="items", per_row=per_row)
    return packed.select(column, "part", "n", F.transform("items", lambda i: i["value"]).alias("values"))


def type_names(nodes: DataFrame, keys: Sequence[str] = ("file", "type"), **options) -> DataFrame:
    """Names that use each type, sorted and joined by ``|``."""
    return joined_groups(nodes.select(*keys, "name").distinct(), keys, "name", sep="|", into="names", **options)


def rule_entries(
    nodes: DataFrame,
    keys: Sequence[str],
    fields: Sequence[Column | str],
    identity: Sequence[str] = ("path", "name"),
    per_row: int = 1000,
) -> DataFrame:
    """Entries grouped by ``keys`` as arrays of structs, several rows for large groups.

    ``identity`` tells the entries of a group apart and orders them. It includes
    the name because siblings share their path.
    """
    rows = nodes.select(
        *keys, F.concat_ws("::", *identity).alias("_id"), F.struct(*fields).alias("_entry")
    )
    packed = pack_groups(rows, keys, "_id", order=None, into="entries", carry="_entry", per_row=per_row)
    return packed.withColumn("entries", F.transform("entries", lambda e: e["_entry"]))
