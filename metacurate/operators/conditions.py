"""Require / exclude conditions over columns, named attributes and multi-valued attributes."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from metacurate.presets import STATUS_ATTRIBUTE, STATUS_ERROR


def as_values(values) -> list[str]:
    """Accept one value or a list; conditions compare as text."""
    if isinstance(values, (str, int, float)):
        values = [values]
    return [str(v) for v in values]


def check_columns(df: DataFrame, names: Sequence[str]) -> None:
    """An unknown column in a condition or an output list is an error."""
    unknown = [n for n in names if n not in df.columns]
    if unknown:
        raise ValueError(f"no column {unknown} among {df.columns}")


def _among(df: DataFrame, name: str, values: list[str]) -> tuple[Column, bool]:
    """``IN`` predicate in a form that reaches the file scan, and whether NULL (= "") is allowed."""
    col, blank = df[name], "" in values
    dtype = df.schema[name].dataType
    if isinstance(dtype, T.IntegralType):
        # compare in the column's own type: a cast would keep the filter out of the scan
        whole = [int(v) for v in values if v.lstrip("-").isdigit() and str(int(v)) == v]
        return (col.isin(whole) if whole else F.lit(False)), blank
    if not isinstance(dtype, T.StringType):
        col = col.cast("string")
    return col.isin(values), blank


def require_columns(df: DataFrame, conditions: Mapping[str, Sequence[str] | str]) -> DataFrame:
    """Keep rows where every named column has one of its values; NULL counts as the empty string."""
    check_columns(df, list(conditions))
    for name, values in conditions.items():
        hit, blank = _among(df, name, as_values(values))
        df = df.where(df[name].isNull() | hit if blank else hit)
    return df


def exclude_columns(df: DataFrame, conditions: Mapping[str, Sequence[str] | str]) -> DataFrame:
    """Drop rows where any named column has one of its values; NULL counts as the empty string."""
    check_columns(df, list(conditions))
    for name, values in conditions.items():
        hit, blank = _among(df, name, as_values(values))
        df = df.where(~hit & df[name].isNotNull() if blank else df[name].isNull() | ~hit)
    return df


def output_columns(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Project the output columns."""
    check_columns(df, names)
    return df.select(*names)


# --- named attributes in long form: (key, pos, name, value), first occurrence counts ---


NAME_KEY = "name_key"


def folded_name(attributes: DataFrame) -> Column:
    """Attribute names in lower case: the column that ``write_attributes`` adds, which reaches the scan, else computed."""
    return F.col(NAME_KEY) if NAME_KEY in attributes.columns else F.lower("name")


def first_attributes(attributes: DataFrame, key: str, names: Sequence[str]) -> DataFrame:
    """First value per entity and attribute, one column per requested name.

    Names match in any case. Each cell is ``struct<pos, value>``: NULL when the
    entity lacks the attribute, so that a present NULL value stays apart. The
    aggregate combines on the map side, however many rows one entity has.
    """
    wanted, folded = [n.lower() for n in names], folded_name(attributes)
    rows = attributes.where(folded.isin(wanted))
    firsts = [F.min(F.when(folded == n.lower(), F.struct("pos", "value"))).alias(n) for n in names]
    return rows.groupBy(key).agg(*firsts)


def attribute_conditions(
    df: DataFrame,
    attributes: DataFrame,
    key: str,
    require: Mapping[str, Sequence[str] | str] | None = None,
    exclude: Mapping[str, Sequence[str] | str] | None = None,
    output: Sequence[str] = (),
) -> DataFrame:
    """Filter entities by their attributes and add the output attributes as columns.

    An absent attribute fails a requirement and passes an exclusion. An output
    attribute that the entity lacks is NULL.
    """
    require, exclude = require or {}, exclude or {}
    # names differing in case only are one attribute
    names = list(dict.fromkeys(n.lower() for n in [*require, *exclude, *output]))
    if not names:
        return df
    firsts = first_attributes(attributes, key, names)
    found = [F.col(f"`{n}`").alias(f"_a{i}") for i, n in enumerate(names)]
    cell = {n: F.col(f"_a{names.index(n.lower())}") for n in [*require, *exclude, *output]}
    # a requirement makes every kept entity have attributes, so the join can be inner
    out = df.join(firsts.select(key, *found), key, "inner" if require else "left")
    for n, values in require.items():
        out = out.where(cell[n].isNotNull() & F.coalesce(cell[n]["value"], F.lit("")).isin(as_values(values)))
    for n, values in exclude.items():
        hit = cell[n].isNotNull() & F.coalesce(cell[n]["value"], F.lit("")).isin(as_values(values))
        out = out.where(~hit)
    kept = [c for c in df.columns if c not in output]
    return out.select(*kept, *[cell[n]["value"].alias(n) for n in output])


# --- multi-valued attributes: any instance may match, by term or by value ---


def instance_matches(term: Column, value: Column, conditions: Sequence[Mapping[str, str]]) -> Column:
    """An attribute instance meets one of the conditions ``{"term_source_id": ..}`` / ``{"value": ..}``."""
    terms = [str(c["term_source_id"]) for c in conditions if c.get("term_source_id") is not None]
    values = [str(c["value"]) for c in conditions if c.get("value") is not None]
    hit = F.lit(False)
    if terms:
        hit = hit | F.coalesce(term.cast("string").isin(terms), F.lit(False))
    if values:
        hit = hit | F.coalesce(value.cast("string").isin(values), F.lit(False))
    return hit


def any_instance(attributes: Column, name: str, conditions: Sequence[Mapping[str, str]]) -> Column:
    """Some instance of the named attribute matches, over ``array<struct<name,value,term_source_id>>``."""
    return F.coalesce(
        F.exists(
            attributes,
            lambda a: (F.lower(a["name"]) == name.lower())
            & instance_matches(a["term_source_id"], a["value"], conditions),
        ),
        F.lit(False),
    )


def multi_value_conditions(
    attributes: Column,
    require: Mapping[str, Sequence[Mapping[str, str]]] | None = None,
    exclude: Mapping[str, Sequence[Mapping[str, str]]] | None = None,
) -> Column:
    """Every required attribute matches and no excluded one does."""
    checks = [any_instance(attributes, n, c) for n, c in (require or {}).items()]
    checks += [~any_instance(attributes, n, c) for n, c in (exclude or {}).items()]
    return reduce(and_, checks, F.lit(True))


def output_instances(attributes: Column, names: Sequence[str]) -> Column:
    """Keep all instances of the named attributes, in their order."""
    return F.filter(attributes, lambda a: F.lower(a["name"]).isin([n.lower() for n in names]))


def instances_of(attributes: Column, name: str) -> Column:
    return F.filter(attributes, lambda a: F.lower(a["name"]) == name.lower())


def multi_value_filter(
    df: DataFrame,
    instances: DataFrame,
    key: str,
    require: Mapping[str, Sequence[Mapping[str, str]]] | None = None,
    exclude: Mapping[str, Sequence[Mapping[str, str]]] | None = None,
) -> DataFrame:
    """The same conditions over instances in long form ``(key, name, value, term_source_id)``.

    For entities whose instances are too many for one array. One pass over the
    instances gives a flag per condition and entity, combined on the map side.
    """
    checks = [(True, n, c) for n, c in (require or {}).items()]
    checks += [(False, n, c) for n, c in (exclude or {}).items()]
    if not checks:
        return df

    def hit(name: str, conditions) -> Column:
        match = instance_matches(F.col("term_source_id"), F.col("value"), conditions)
        return F.coalesce(F.lower("name") == name.lower(), F.lit(False)) & match

    hits = [hit(n, c) for _, n, c in checks]
    matching = instances.where(reduce(or_, hits))
    flags = matching.groupBy(key).agg(*[F.bool_or(h).alias(f"_f{i}") for i, h in enumerate(hits)])
    # an entity without any match has no flags: it fails a requirement and passes exclusions
    out = df.join(flags, key, "inner" if require else "left")
    for i, (wanted, _, _) in enumerate(checks):
        flag = F.coalesce(F.col(f"_f{i}"), F.lit(False))
        out = out.where(flag if wanted else ~flag)
    return out.select(*df.columns)


# --- validation status ---


def strict_gate(status: Column, error: str = STATUS_ERROR) -> Column:
    """A status is known and is not the error status."""
    return F.coalesce(status != error, F.lit(False))


def lenient_gate(status: Column, error: str = STATUS_ERROR) -> Column:
    """Only the error status fails; an unknown status passes."""
    return F.coalesce(status != error, F.lit(True))


def entity_status(attributes: Column, name: str = STATUS_ATTRIBUTE) -> Column:
    """First status of an entity, NULL if it has none; an empty text when its value is missing."""
    first = F.try_element_at(instances_of(attributes, name), F.lit(1))
    return F.when(first.isNotNull(), F.coalesce(first["value"], F.lit("")))
