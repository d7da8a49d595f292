"""Attribute rows to columns and back, and membership rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from metacurate.presets import GROUP_PATTERN, MEMBER_RELATION, SAMPLE_FIELDS


def unpivot_columns(df: DataFrame, key: str, columns: Mapping[str, Column] | Sequence[str]) -> DataFrame:
    """Columns as attribute rows ``(key, pos, name, value)``; a NULL column gives no row."""
    if not isinstance(columns, Mapping):
        columns = {c: F.col(c) for c in columns}
    cells = [
        F.struct(F.lit(i).alias("pos"), F.lit(n).alias("name"), c.cast("string").alias("value"))
        for i, (n, c) in enumerate(columns.items())
    ]
    return df.select(key, F.inline(F.array(*cells))).where(F.col("value").isNotNull())


def pivot_fields(fields: DataFrame, key: str, names: Sequence[str] = SAMPLE_FIELDS) -> DataFrame:
    """Field rows ``(key, pos, name, value)`` as one column per expected field.

    Names that differ in case only are one field: the first spelling names it,
    and the first row in position order gives its value.
    """
    columns: dict[str, str] = {}
    for n in names:
        columns.setdefault(n.lower(), n)
    firsts = [
        F.min(F.when(F.lower("name") == low, F.struct("pos", "value")))["value"].alias(n)
        for low, n in columns.items()
    ]
    return fields.where(F.lower("name").isin(list(columns))).groupBy(key).agg(*firsts)


def project_samples(samples: DataFrame, project: str, field: str = "project") -> DataFrame:
    """Samples of a project, by the first instance of the project field, in any case."""
    first = F.try_element_at(F.try_element_at("characteristics", F.lit(field)), F.lit(1))
    return samples.where(F.upper(first["text"]) == project.upper())


def group_ids(samples: DataFrame, pattern: str = GROUP_PATTERN, relation: str = MEMBER_RELATION) -> DataFrame:
    """Groups that samples are members of, ``(accession, group_id)``."""
    links = samples.select("accession", F.inline("relationships"))
    found = links.where((F.col("type") == relation) & F.col("source").rlike(pattern))
    return found.select("accession", F.col("source").alias("group_id")).distinct()


def group_members(groups: DataFrame, relation: str = MEMBER_RELATION) -> DataFrame:
    """Members of group records, ``(group_id, id)``."""
    links = groups.select(F.col("accession").alias("group_id"), F.inline("relationships"))
    found = links.where((F.col("type") == relation) & (F.col("source") == F.col("group_id")))
    return found.select("group_id", F.col("target").alias("id")).distinct()


def group_headers(groups: DataFrame) -> DataFrame:
    """Display fields of group records: names, dates, contacts, e-mails, organisations; no e-mail at all gives NULL."""

    def first_text(name: str) -> Column:
        return F.try_element_at(F.try_element_at("characteristics", F.lit(name)), F.lit(1))["text"]

    return groups.select(
        F.col("accession").alias("group_id"),
        "name",
        first_text("Submission Title").alias("title"),
        F.col("releaseDate").alias("release_date"),
        F.col("updateDate").alias("update_date"),
        F.array_join(F.transform("contact", lambda c: c["Name"]), ", ").alias("contacts"),
        F.nullif(F.array_join(F.transform("contact", lambda c: c["E-mail"]), ", "), F.lit("")).alias("emails"),
        F.array_join(F.array_distinct(F.transform("organization", lambda o: o["Name"])), ", ").alias(
            "organizations"
        ),
    )
