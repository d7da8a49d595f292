"""Field coverage and gaps over documents, always aggregated before rules are joined."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from metacurate.functions.text import lower_camel
from metacurate.functions.values import as_object, at_path, is_meaningful, is_present, meaningful_text
from metacurate.presets import EMPTY_VALUES, SHARED_FIELDS

# Top-level fields are filed under this container, nested ones under their object's name.
TOP = ""


def material_totals(docs: DataFrame, material: str | Column, grand_total: bool = False) -> DataFrame:
    """Documents per material ``(material, n, is_total)``; ``grand_total`` adds a row over all."""
    named = docs.select((F.col(material) if isinstance(material, str) else material).alias("material"))
    if not grand_total:
        return named.groupBy("material").agg(F.count("*").alias("n")).withColumn("is_total", F.lit(False))
    rolled = named.rollup("material").agg(
        F.count("*").alias("n"), (F.grouping_id() == 1).alias("is_total")
    )
    return rolled.select("material", "n", "is_total")


def column_coverage(
    df: DataFrame, section: str, fields: Sequence[str], empty_values: Sequence[str] = EMPTY_VALUES
) -> DataFrame:
    """Coverage of flat columns, ``(section, field, total, n_meaningful, n_present)``.

    One pass with two counters per field; rows are not multiplied.
    """
    counters = [F.count("*").alias("total")]
    for i, f in enumerate(fields):
        text = F.col(f).cast("string")
        counters.append(F.count_if(is_meaningful(text, empty_values)).alias(f"m{i}"))
        counters.append(F.count(F.col(f)).alias(f"p{i}"))
    counts = df.groupBy(F.col(section).alias("section")).agg(*counters)
    cells = [
        F.struct(F.lit(f).alias("field"), F.col(f"m{i}").alias("n_meaningful"), F.col(f"p{i}").alias("n_present"))
        for i, f in enumerate(fields)
    ]
    return counts.select("section", "total", F.inline(F.array(*cells))).select(
        "section", "field", "total", "n_meaningful", "n_present"
    )


def _entry(container: Column, field: Column, value: Column) -> Column:
    return F.struct(container.alias("container"), field.alias("field"), value.alias("value"))


def document_fields(docs: DataFrame, nested: bool) -> DataFrame:
    """Documents ``(scope, id, material, doc)`` unpivoted to ``(scope, material, container, field, value)``.

    ``nested`` adds the fields of each top-level object, filed under its name.
    Every document also gives one row without a field, which counts the document.
    """
    fields = F.map_entries(as_object(F.col("doc")))
    none = F.lit(None).cast("string")
    itself = F.array(_entry(none, none, F.lit(None).cast("variant")))
    parts = [itself, F.transform(fields, lambda e: _entry(F.lit(TOP), e["key"], e["value"]))]
    if nested:

        def members(e: Column) -> Column:
            inner = F.coalesce(F.map_entries(as_object(e["value"])), F.array())
            return F.transform(inner, lambda m: _entry(e["key"], m["key"], m["value"]))

        parts.append(F.flatten(F.transform(fields, members)))
    empty = F.slice(itself, 1, 0)
    entries = F.concat(*[F.coalesce(p, empty) for p in parts])
    return docs.select("scope", "material", F.inline(entries))


def prepare_documents(hits: DataFrame, scope: str) -> DataFrame:
    """Search hits ``(_id, doc)`` as ``(scope, id, material, doc)``."""
    return hits.select(
        F.lit(scope).alias("scope"),
        F.col("_id").alias("id"),
        at_path(F.col("doc"), "material.text").alias("material"),
        "doc",
    )


def field_counts(fields: DataFrame, empty_values: Sequence[str] = EMPTY_VALUES) -> DataFrame:
    """Counters per ``(scope, container, field, material)``: the one aggregation over all fields.

    Rows without a field hold the number of documents, see ``scope_totals``. The
    result does not grow with the documents, only with their field names.
    """
    value = F.col("value")
    return fields.groupBy("scope", "container", "field", "material").agg(
        F.count("*").alias("n"),
        F.count_if(is_meaningful(meaningful_text(value), empty_values)).alias("n_meaningful"),
        F.count_if(is_present(value)).alias("n_present"),
    )


def ruled_counts(
    docs: DataFrame, paths: Sequence[tuple[str, str]], empty_values: Sequence[str] = EMPTY_VALUES
) -> DataFrame:
    """The counters of ``field_counts``, of the given ``(container, field)`` paths only, in one pass over ``docs``.

    Each path has two counters beside the other paths' ones, and no document is
    spread over rows. Of documents kept as variants in a table, the scan extracts
    just these paths and the material.
    """
    counters = [F.count("*").alias("n")]
    for i, (container, field) in enumerate(paths):
        steps = [field] if container == TOP else [container, field]
        path = "$" + "".join('["{}"]'.format(s.replace('"', '\\"')) for s in steps)
        value = F.try_variant_get("doc", path, "variant")
        counters += [
            F.count(value).alias(f"n{i}"),
            F.count_if(is_meaningful(meaningful_text(value), empty_values)).alias(f"m{i}"),
            F.count_if(value.isNotNull() & is_present(value)).alias(f"p{i}"),
        ]
    counted = docs.groupBy("scope", "material").agg(*counters)

    def cell(container: str | None, field: str | None, n: str, meaningful: Column, present: Column) -> Column:
        return F.struct(
            F.lit(container).cast("string").alias("container"), F.lit(field).cast("string").alias("field"), F.col(n).alias("n"),
            meaningful.alias("n_meaningful"), present.alias("n_present"),
        )

    none = F.lit(0).cast("bigint")
    cells = [cell(None, None, "n", none, none)]
    cells += [cell(c, f, f"n{i}", F.col(f"m{i}"), F.col(f"p{i}")) for i, (c, f) in enumerate(paths)]
    return counted.select("scope", "material", F.inline(F.array(*cells))).select(
        "scope", "container", "field", "material", "n", "n_meaningful", "n_present"
    )


def scope_totals(counts: DataFrame) -> DataFrame:
    """Documents per ``(scope, material)``."""
    return counts.where(F.col("field").isNull()).select("scope", "material", "n")


def rule_targets(
    rules: DataFrame, organism_scope: str, specimen_scope: str, shared: Sequence[str] = SHARED_FIELDS
) -> DataFrame:
    """Where each rule's field is found: ``standard`` and the organism section at the top level of
    organism documents, other sections inside the object named after them in specimen documents.
    Shared fields stay at the top level."""
    top = F.col("section").isin("standard", organism_scope)
    nested_name = F.when(F.col("field").isin(list(shared)), F.lit(TOP)).otherwise(lower_camel(F.col("section")))
    return rules.withColumns(
        {
            "scope": F.when(top, F.lit(organism_scope)).otherwise(F.lit(specimen_scope)),
            "container": F.when(top, F.lit(TOP)).otherwise(nested_name),
        }
    )


def coverage_detail(
    rules: DataFrame, counts: DataFrame, organism_scope: str, specimen_scope: str
) -> DataFrame:
    """Coverage per rule; ratios are NULL where the section has no documents.

    A value is meaningful only in documents of the section's own material
    (``standard`` takes all organisms); presence counts over the whole scope.
    """
    totals = scope_totals(counts)
    targets = rule_targets(rules, organism_scope, specimen_scope, shared=())
    keys = ["scope", "container", "field"]
    seen = targets.join(counts.drop("n"), keys, "left")
    own = (F.col("section") == "standard") | (F.col("material") == F.col("section"))
    detail = seen.groupBy("section", "status", "field", "scope", "section_pos", "rule_pos").agg(
        F.coalesce(F.sum(F.when(own, F.col("n_meaningful"))), F.lit(0)).alias("count"),
        F.coalesce(F.sum("n_present"), F.lit(0)).alias("present"),
    )
    # the standard and organism sections are measured against all documents of the organism scope
    by_section = totals.where(F.col("scope") == specimen_scope).select(
        F.col("material").alias("section"), F.col("n").alias("total")
    ).where(~F.col("section").isin("standard", organism_scope))
    organisms = totals.where(F.col("scope") == organism_scope).agg(F.coalesce(F.sum("n"), F.lit(0)).alias("total"))
    by_section = by_section.unionByName(
        organisms.select(
            F.explode(F.array(F.lit("standard"), F.lit(organism_scope))).alias("section"), "total"
        )
    )
    total = F.coalesce("total", F.lit(0))
    return detail.join(by_section, "section", "left").select(
        "section",
        "status",
        "field",
        "scope",
        "section_pos",
        "rule_pos",
        total.alias("total"),
        "count",
        F.when(total > 0, F.col("count") / total).alias("ratio"),
        F.when(total > 0, F.col("present")).otherwise(0).alias("present"),
        F.when(total > 0, F.col("present") / total).alias("present_ratio"),
    )


def coverage_averages(detail: DataFrame, organism_scope: str | None = None) -> DataFrame:
    """Unweighted mean ratios per status over overlapping groups: each section, its kind, and all.

    ``detail`` needs ``section, status, ratio, present_ratio`` and, unless
    ``organism_scope`` is given, a ``kind`` column.
    """
    if organism_scope is not None:
        kind = F.when(F.col("scope") == organism_scope, F.lit("animal")).otherwise(F.lit("specimen"))
        detail = detail.withColumn("kind", kind)
    groups = F.array(F.col("section"), F.col("kind"), F.lit("overall"))
    rated = detail.where(F.col("ratio").isNotNull())
    return (
        rated.select(F.explode(F.array_distinct(groups)).alias("section"), "status", "ratio", "present_ratio")
        .groupBy("section", "status")
        .agg(F.avg("ratio").alias("excluding"), F.avg("present_ratio").alias("including"))
    )


def gap_counts(targets: DataFrame, counts: DataFrame) -> DataFrame:
    """Documents lacking each rule's field, ``n_missing``, and how many are expected to, ``n_expected``.

    Nothing may be missing in the organism scope; elsewhere the documents of
    other materials are expected to lack the field.
    """
    totals = scope_totals(counts)
    keys = ["scope", "container", "field"]
    present = counts.groupBy(*keys).agg(F.sum("n_present").alias("present"))
    size = totals.groupBy("scope").agg(
        F.sum("n").alias("n_scope"), F.sum(F.when(F.col("material").isNotNull(), F.col("n"))).alias("n_material")
    )
    own = totals.where(F.col("material").isNotNull()).select(
        "scope", F.col("material").alias("section"), F.col("n").alias("n_own")
    )
    joined = targets.join(present, keys, "left").join(size, "scope", "left").join(own, ["scope", "section"], "left")
    return joined.select(
        *targets.columns,
        (F.coalesce("n_scope", F.lit(0)) - F.coalesce("present", F.lit(0))).alias("n_missing"),
        (F.coalesce("n_material", F.lit(0)) - F.coalesce("n_own", F.lit(0))).alias("n_expected"),
    )


def missing_fields(docs: DataFrame, rules: DataFrame, sections: Sequence[str]) -> DataFrame:
    """Documents ``(id, doc)`` lacking a top-level field that a section's rules name, one row ``(section, field, id)`` each.

    The distinct ``(section, field)`` of the rules are joined to the documents
    by section; the optimizer sends the smaller side, as a rule the rules.
    """
    fields = rules.where(F.col("section").isin(list(sections)) & F.col("field").isNotNull()).select("section", "field").distinct()
    present = F.map_keys(F.map_filter(as_object(F.col("doc")), lambda _, v: is_present(v)))
    held = docs.select(
        "id", F.coalesce(present, F.array().cast("array<string>")).alias("held"),
        F.explode(F.array(*[F.lit(s) for s in sections])).alias("section"),
    )
    lacking = (held["section"] == fields["section"]) & ~F.array_contains(held["held"], fields["field"])
    return held.join(fields, lacking).select(fields["section"], fields["field"], "id")
