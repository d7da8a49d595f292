"""Joins along entity references and ordered lookups with fallback."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from metacurate.functions.values import truthy
from metacurate.operators.joins import join_unique


def first_available(lookups: DataFrame) -> DataFrame:
    """First truthy value per key over prioritised lookups ``(priority, key, value)``."""
    usable = lookups.where(truthy(F.col("value")))
    return usable.groupBy("key").agg(F.min_by("value", "priority").alias("value"))


def lookup_with_fallback(
    df: DataFrame,
    lookups: DataFrame,
    key: str,
    into: str,
    eligible: Column | None = None,
    unique_keys: bool = False,
) -> DataFrame:
    """Add the first available value for ``key``; NULL where there is none or the row is not eligible.

    Rows are joined on their own key even when not eligible: nulling the key
    instead would send all those rows to one partition. ``unique_keys`` says that
    no two rows share a key, so that an existing partitioning by it can be used.
    """
    found = first_available(lookups).select(F.col("key").alias(key), F.col("value").alias("_found"))
    value = F.col("_found") if eligible is None else F.when(eligible, F.col("_found"))
    joined = df.join(found, key, "left") if unique_keys else join_unique(df, found, key, "left")
    return joined.select(*df.columns, value.alias(into))


def reference_chain(
    runs: DataFrame, experiments: DataFrame, samples: DataFrame, studies: DataFrame
) -> DataFrame:
    """Run -> experiment -> sample, experiment -> study."""
    return (
        runs.join(experiments, "experiment_id")
        .join(samples, "sample_id")
        .join(studies, "study_id")
    )


def missing_references(df: DataFrame, referenced: DataFrame, on: str) -> DataFrame:
    """Keys that refer to nothing."""
    return df.select(on).distinct().join(referenced.select(on), on, "left_anti")


def require_references(df: DataFrame, referenced: DataFrame, on: str) -> DataFrame:
    """Fail if any key refers to nothing. Runs a job that stops at the first few offenders."""
    missing = missing_references(df, referenced, on).take(3)
    if missing:
        raise ValueError(f"cannot find {on}: {[r[0] for r in missing]}")
    return df
