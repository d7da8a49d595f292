"""Mandatory fields of schema documents, with their paths, descriptions and allowed values."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from metacurate.functions.text import clean_description
from metacurate.operators.hierarchy import expand, inline_types, is_mandatory, path_labels
from metacurate.operators.vocabulary import allowed_for


def mandatory_fields(
    edges: DataFrame, allowed: DataFrame, common_file: str, describe_all: bool = False
) -> DataFrame:
    """Mandatory nodes reachable from the roots, ``(file, kind, name, path, desc, allowed_values)``.

    ``edges`` is ``(file, parent, name, kind, type, min_occurs, use, description)``,
    ``allowed`` is ``(file, tag, allowed)``. Only root elements keep their
    description unless ``describe_all``; absent descriptions and values are NULL.
    """
    wanted = inline_types(edges.where(is_mandatory())).drop("min_occurs", "use")
    nodes = expand(wanted)
    labelled = allowed_for(path_labels(nodes), allowed, common_file)
    description = clean_description(F.col("description"))
    kept = description != ""
    if not describe_all:
        kept = kept & (F.col("depth") == 0)
    return labelled.select(
        "file",
        "kind",
        "name",
        F.col("label").alias("path"),
        F.when(kept, description).alias("desc"),
        F.col("allowed").alias("allowed_values"),
    )
