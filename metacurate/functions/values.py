"""Values inside documents: nested paths, polymorphic fields, presence, merges."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from metacurate.presets import EMPTY_VALUES


def truthy(c: Column) -> Column:
    """True for text other than NULL, the empty string and ``0``."""
    text = c.cast("string")
    return F.coalesce(~text.isin("", "0"), F.lit(False))


def is_meaningful(c: Column, empty_values: Sequence[str] = EMPTY_VALUES) -> Column:
    """The value is more than a placeholder; NULL counts as the empty string."""
    return ~F.coalesce(c, F.lit("")).isin(list(empty_values))


def variant_path(path: str) -> str:
    """Dotted field path as a variant path, with every name quoted."""
    return "$" + "".join('["{}"]'.format(name.replace('"', '\\"')) for name in path.split("."))


def at_path(doc: Column, path: str) -> Column:
    """Text at a dotted path of a nested document, NULL where the path ends early."""
    return F.try_variant_get(doc, variant_path(path), "string")


def as_object(v: Column) -> Column:
    """The variant as a field map; NULL unless it is an object."""
    return F.try_variant_get(v, "$", "map<string,variant>")


def as_array(v: Column) -> Column:
    """The variant as an array of variants; NULL unless it is an array."""
    return F.try_variant_get(v, "$", "array<variant>")


def as_text(v: Column) -> Column:
    return F.try_variant_get(v, "$", "string")


def _object_text(fields: Column) -> Column:
    # an existing but empty text hides the terms
    return F.when(F.map_contains_key(fields, "text"), as_text(fields["text"])).when(
        F.map_contains_key(fields, "ontologyTerms"), as_text(fields["ontologyTerms"])
    )


def meaningful_text(v: Column) -> Column:
    """Text of a field that may be an object, an array of either, or a scalar.

    An object yields its ``text``, or else its ``ontologyTerms``. An array yields
    its first element of non-zero length, even if that is a placeholder.
    """

    def element_text(e: Column) -> Column:
        fields = as_object(e)
        return F.when(fields.isNotNull(), _object_text(fields)).otherwise(as_text(e))

    texts = F.transform(as_array(v), element_text)
    first = F.try_element_at(F.filter(texts, lambda t: F.length(t) > 0), F.lit(1))
    fields = as_object(v)
    return (
        F.when(fields.isNotNull(), _object_text(fields))
        .when(as_array(v).isNotNull(), first)
        .otherwise(as_text(v))
    )


def is_present(v: Column) -> Column:
    """The field holds some non-null value; objects and arrays need a non-null member."""

    def holds(member: Column) -> Column:
        return ~F.is_variant_null(member)

    members = F.coalesce(F.map_values(as_object(v)), as_array(v))
    return F.coalesce(
        F.when(members.isNotNull(), F.exists(members, holds)).otherwise(holds(v)), F.lit(False)
    )


def last_defined(items: Column, part: str) -> Column:
    """Last non-null ``part`` over an array of structs, NULL if there is none."""
    parts = F.transform(items, lambda x: x[part])
    return F.try_element_at(F.filter(parts, lambda p: p.isNotNull()), F.lit(-1))


def merged_value(instances: Column) -> Column:
    """Merge the instances of one field: last text, last term list and last unit, each on its own."""
    return F.struct(
        last_defined(instances, "text").alias("text"),
        last_defined(instances, "ontologyTerms").alias("iri"),
        last_defined(instances, "unit").alias("unit"),
    )


def joined_text(items: Column, part: str | None = None, sep: str = ", ") -> Column:
    """Array field as a list for display: elements, or one part of struct elements."""
    return F.array_join(F.transform(items, lambda x: x[part]) if part else items, sep)
