"""URL audit: values of URI-typed fields that are no valid URLs."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from metacurate.functions.urls import is_url
from metacurate.functions.values import variant_path
from metacurate.presets import URL_FIELDS


def url_values(
    docs: DataFrame,
    kind: str,
    id_path: str,
    fields: Sequence[str],
    standard: str | None = None,
    standard_path: str = "standardMet",
) -> DataFrame:
    """Values at the listed paths, ``(kind, id, field, value, is_text)``.

    ``docs`` has a variant column ``doc``. Repeated paths count once; absent and
    empty values give no row; ``standard`` keeps the documents that met it.
    """
    if standard is not None:
        docs = docs.where(F.try_variant_get("doc", variant_path(standard_path), "string") == standard)

    def cell(path: str):
        value = F.try_variant_get("doc", variant_path(path), "variant")
        return F.struct(
            F.lit(path).alias("field"),
            F.try_variant_get(value, "$", "string").alias("value"),
            (F.schema_of_variant(value) == "STRING").alias("is_text"),
            F.try_variant_get(value, "$", "double").alias("number"),
        )

    cells = F.array(*[cell(p) for p in dict.fromkeys(fields)])

    # zero, false and empty containers count as empty although they have a text form
    def empty(c: Column) -> Column:
        nothing = F.coalesce(c["number"] == 0, F.lit(False)) | c["value"].isin("[]", "{}")
        return ~c["is_text"] & nothing

    rows = docs.select(
        F.lit(kind).alias("kind"),
        F.try_variant_get("doc", variant_path(id_path), "string").alias("id"),
        F.inline(F.filter(cells, lambda c: (F.length(c["value"]) > 0) & ~empty(c))),
    )
    return rows.select("kind", "id", "field", "value", "is_text")


def column_values(df: DataFrame, kind: str, id_column: str, columns: Sequence[str]) -> DataFrame:
    """The same rows from flat text columns."""
    cells = F.array(*[F.struct(F.lit(c).alias("field"), F.col(c).alias("value")) for c in dict.fromkeys(columns)])
    rows = df.select(
        F.lit(kind).alias("kind"), F.col(id_column).cast("string").alias("id"), F.inline(cells)
    )
    return rows.where(F.length("value") > 0).withColumn("is_text", F.lit(True))


def invalid_urls(values: DataFrame) -> DataFrame:
    """Offending values with the reason, ``(kind, id, field, value, reason)``."""
    reason = F.when(~F.col("is_text"), "not_a_string").when(~is_url(F.col("value")), "invalid_url")
    return values.select("kind", "id", "field", "value", reason.alias("reason")).where(
        F.col("reason").isNotNull()
    )


def url_summary(values: DataFrame) -> DataFrame:
    """Checked and invalid values per field."""
    bad = ~F.col("is_text") | ~is_url(F.col("value"))
    return values.groupBy("kind", "field").agg(F.count("*").alias("n"), F.count_if(bad).alias("n_invalid"))


def url_audit(
    documents: Mapping[str, DataFrame],
    id_paths: Mapping[str, str],
    standard: str,
    fields: Mapping[str, Sequence[str]] = URL_FIELDS,
) -> DataFrame:
    """Invalid URLs over several document types that met the standard."""
    out = None
    for kind, docs in documents.items():
        part = invalid_urls(url_values(docs, kind, id_paths[kind], fields[kind], standard))
        out = part if out is None else out.unionByName(part)
    return out
