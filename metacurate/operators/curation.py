"""Curation change records: remove a field, replace its value, term or unit, copy it from the parent.

A record is ``(sample, field, before, after)``; ``before`` and ``after`` are arrays
of ``struct<type, value, iri, unit>``. Terms win over a unit, a unit over plain text.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from metacurate.functions.values import merged_value, truthy
from metacurate.operators.joins import join_unique
from metacurate.presets import PARENT_RELATION

ATTRIBUTE = "struct<type:string,value:string,iri:array<string>,unit:string>"
_NO_TERMS = "array<string>"


def _attribute(field: Column, value: Column, iri: Column | None = None, unit: Column | None = None) -> Column:
    return F.struct(
        field.alias("type"),
        F.coalesce(value, F.lit("")).alias("value"),
        (iri if iri is not None else F.lit(None).cast(_NO_TERMS)).alias("iri"),
        (unit if unit is not None else F.lit(None).cast("string")).alias("unit"),
    ).cast(ATTRIBUTE)


def _by_form(m: Column, terms: Column, unit: Column, plain: Column) -> Column:
    return F.when(m["iri"].isNotNull(), terms).when(truthy(m["unit"]), unit).otherwise(plain)


def _current(field: Column, m: Column) -> Column:
    return _by_form(
        m,
        _attribute(field, m["text"], iri=m["iri"]),
        _attribute(field, m["text"], unit=m["unit"]),
        _attribute(field, m["text"]),
    )


def _nothing() -> Column:
    return F.array().cast(f"array<{ATTRIBUTE}>")


def characteristic_rows(samples: DataFrame) -> DataFrame:
    """Samples in long form ``(sample, field, instances)``."""
    return samples.select(
        F.col("accession").alias("sample"), F.explode("characteristics").alias("field", "instances")
    ).where(F.col("instances").isNotNull())


def worklist_values(worklist: DataFrame, samples: DataFrame) -> DataFrame:
    """Merged current value of each listed field; a field the sample lacks gives nothing.

    Fields that the list does not name for any sample are dropped beside the
    scan; what is left is joined on sample and field, so that a sample listed for
    many fields is spread.
    """
    # the least of equal names, so that a list of one constant name is still joined by it
    fields = worklist.groupBy("field").agg(F.min("field").alias("name")).select(F.col("name").alias("field"))
    named = join_unique(characteristic_rows(samples), fields, "field", "left_semi")
    rows = worklist.select("sample", "field").join(named, ["sample", "field"])
    return rows.select("sample", "field", merged_value(F.col("instances")).alias("m"))


def _records(rows: DataFrame, before: Column, after: Column) -> DataFrame:
    return rows.select("sample", "field", before.alias("before"), after.alias("after"))


def remove_field(worklist: DataFrame, samples: DataFrame) -> DataFrame:
    """Take the field away: the merged value before, nothing after."""
    field, m = F.col("field"), F.col("m")
    return _records(worklist_values(worklist, samples), F.array(_current(field, m)), _nothing())


def replace_value(worklist: DataFrame, samples: DataFrame, replacement: str | Column) -> DataFrame:
    """Put a new value. With terms, the terms stay; with a unit, the value stays and the unit is replaced."""
    new = F.lit(replacement) if isinstance(replacement, str) else replacement
    field, m = F.col("field"), F.col("m")
    after = _by_form(
        m,
        _attribute(field, new, iri=m["iri"]),
        _attribute(field, m["text"], unit=new),
        _attribute(field, new),
    )
    return _records(worklist_values(worklist, samples), F.array(_current(field, m)), F.array(after))


def replace_term(
    worklist: DataFrame, samples: DataFrame, term_map: DataFrame | Mapping[str, str]
) -> tuple[DataFrame, DataFrame]:
    """Replace the terms by the one mapped from the text.

    Returns the change records and the ``(sample, field, text)`` rows without a
    mapping. ``term_map`` is a dict or a table ``(text, iri)``; of a text that it
    repeats the smallest term counts.
    """
    values = worklist_values(worklist, samples)
    if isinstance(term_map, Mapping):
        pairs = [x for t, i in term_map.items() for x in (F.lit(t), F.lit(i))]
        mapping = F.create_map(*pairs) if pairs else F.lit(None).cast("map<string,string>")
        mapped = values.withColumn("_iri", F.try_element_at(mapping, F.col("m.text")))
    else:
        terms = term_map.groupBy(F.col("text").alias("_text")).agg(F.min("iri").alias("_iri"))
        mapped = join_unique(values.withColumn("_text", F.col("m.text")), terms, "_text", "left").drop("_text")
    field, m = F.col("field"), F.col("m")
    old_terms = F.coalesce(m["iri"], F.array().cast(_NO_TERMS))
    records = _records(
        mapped.where(F.col("_iri").isNotNull()),
        F.array(_attribute(field, m["text"], iri=old_terms)),
        F.array(_attribute(field, m["text"], iri=F.array("_iri"))),
    )
    unmapped = mapped.where(F.col("_iri").isNull()).select("sample", "field", m["text"].alias("text"))
    return records, unmapped


def replace_unit(worklist: DataFrame, samples: DataFrame, unit: str) -> DataFrame:
    """Keep the value and put a new unit."""
    field, m = F.col("field"), F.col("m")
    return _records(
        worklist_values(worklist, samples),
        F.array(_attribute(field, m["text"], unit=F.coalesce(m["unit"], F.lit("")))),
        F.array(_attribute(field, m["text"], unit=F.lit(unit))),
    )


def samples_lacking(samples: DataFrame, field: str) -> DataFrame:
    """Samples without the field."""
    return samples.where(F.try_element_at("characteristics", F.lit(field)).isNull())


def parent_of(relation: str = PARENT_RELATION) -> Column:
    """Target of the sample's last own relationship of that type, NULL if it has none."""
    own = F.filter(
        "relationships", lambda r: (r["type"] == relation) & (r["source"] == F.col("accession"))
    )
    return F.try_element_at(own, F.lit(-1))["target"]


def copy_from_parent(
    samples: DataFrame, field: str, relation: str = PARENT_RELATION
) -> tuple[DataFrame, DataFrame]:
    """Copy a missing field from the parent sample.

    Returns the change records (nothing before, the parent's merged value after)
    and the ``(sample, field, parent)`` rows that could not be resolved: no
    parent, or a parent without the field.
    """
    lacking = samples_lacking(samples, field).select(
        F.col("accession").alias("sample"), F.lit(field).alias("field"), parent_of(relation).alias("parent")
    )
    instances = F.try_element_at("characteristics", F.lit(field))
    holders = samples.where(instances.isNotNull())
    values = holders.select(F.col("accession").alias("parent"), merged_value(instances).alias("m"))
    records = _records(lacking.join(values, "parent"), _nothing(), F.array(_current(F.col("field"), F.col("m"))))
    # samples without a parent get a key of their own: a shared NULL key would be one hot key
    own_key = F.coalesce(F.concat(F.lit("parent "), "parent"), F.concat(F.lit("sample "), "sample"))
    known = holders.select(F.concat(F.lit("parent "), "accession").alias("_key"))
    unresolved = lacking.withColumn("_key", own_key).join(known, "_key", "left_anti")
    return records, unresolved.select("sample", "field", "parent")


def curation_payload(records: DataFrame, domain: str) -> DataFrame:
    """Change records as JSON payloads ``(sample, field, payload)``."""
    no_references = F.array().cast("array<string>")
    payload = F.struct(
        F.col("sample"),
        F.struct(
            F.col("before").alias("attributesPre"),
            F.col("after").alias("attributesPost"),
            no_references.alias("externalReferencesPre"),
            no_references.alias("externalReferencesPost"),
        ).alias("curation"),
        F.lit(domain).alias("domain"),
    )
    return records.select("sample", "field", F.to_json(payload).alias("payload"))
