"""Entity files, lookups, logs, search hits, sample pages, rule sets, vocabularies, XML schemas.

JSON inputs come in three layouts: ``lines`` (one record per line, splittable),
``array`` (whole-file JSON, one task per file) and ``split`` (files that are one
array of objects, of any size, each read by many tasks).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from metacurate.functions.text import lower_camel
from metacurate.operators.checkpoints import stored
from metacurate.presets import FIELD_ALIASES
from metacurate.sources import schemas
from metacurate.sources.arrays import read_array_elements

LAYOUTS = ("lines", "array", "split")


def _json(spark: SparkSession, path, schema: str, layout: str) -> DataFrame:
    if layout not in LAYOUTS:
        raise ValueError(f"layout must be one of {LAYOUTS}, not {layout!r}")
    if layout == "split":
        record = F.from_json("element", schema, {"mode": "FAILFAST"}).alias("record")
        return read_array_elements(spark, path).select(record).select("record.*")
    return spark.read.schema(schema).option("mode", "FAILFAST").option("multiLine", layout == "array").json(path)


def _tsv(spark: SparkSession, path, schema: str, **options) -> DataFrame:
    # quote="" because the format has no quoting; a quote is an ordinary character
    reader = spark.read.schema(schema).option("sep", "\t").option("quote", "")
    return reader.options(**options).csv(path)


def unique_by(df: DataFrame, key: str, on_duplicate: str = "fail", position: str | None = None) -> DataFrame:
    """One row per key: fail on a repeated key, or keep the one with the highest position."""
    if on_duplicate == "last":
        if position is None:
            raise ValueError("on_duplicate='last' needs a position column")
        rest = [c for c in df.columns if c != key]
        return df.groupBy(key).agg(F.max_by(F.struct(*rest), position).alias("_last")).select(key, "_last.*")
    if on_duplicate != "fail":
        raise ValueError(f"on_duplicate must be 'fail' or 'last', not {on_duplicate!r}")
    repeated = df.groupBy(key).count().where("count > 1").select(key).take(3)
    if repeated:
        raise ValueError(f"repeated {key}: {[r[0] for r in repeated]}")
    return df


def read_entities(
    spark: SparkSession, path, layout: str = "array", on_duplicate: str = "fail", position: str | None = None
) -> DataFrame:
    """Entities with their attributes, one row per id."""
    schema = schemas.ENTITY + (f", {position} bigint" if position else "")
    rows = _json(spark, path, schema, layout).where(F.col("id").isNotNull())
    return unique_by(rows, "id", on_duplicate, position)


def read_lookups(spark: SparkSession, paths: Sequence[str], layout: str = "array") -> DataFrame:
    """Ordered lookup files as ``(priority, key, value)``; the first path wins.

    ``array`` reads one JSON object per file, ``lines`` one ``{"key": …, "value": …}`` per line.
    """
    lookups = None
    for priority, path in enumerate(paths):
        if layout == "array":
            text = spark.read.text(path, wholetext=True)
            pairs = text.select(F.explode(F.from_json("value", "map<string,string>")).alias("key", "value"))
        else:
            pairs = _json(spark, path, "key string, value string", layout)
        pairs = pairs.select(F.lit(priority).alias("priority"), "key", "value")
        lookups = pairs if lookups is None else lookups.unionByName(pairs)
    if lookups is None:
        return spark.createDataFrame([], "priority int, key string, value string")
    return lookups


def read_worklist(spark: SparkSession, path) -> DataFrame:
    """Work-list of ``(sample, field)``."""
    return _tsv(spark, path, schemas.WORKLIST)


def read_sample_log(spark: SparkSession, path) -> DataFrame:
    """Sample validation log, four columns."""
    return _tsv(spark, path, schemas.SAMPLE_LOG)


def read_experiment_log(spark: SparkSession, path) -> DataFrame:
    """Experiment validation log, five columns of which the third is unused."""
    return _tsv(spark, path, schemas.EXPERIMENT_LOG).drop("unused")


def read_hits(spark: SparkSession, path, layout: str = "array") -> DataFrame:
    """Search hits as ``(_id, doc)``; ``doc`` is a variant because fields are polymorphic.

    ``array`` reads result pages ``{"hits": {"hits": [...]}}``, ``lines`` one hit
    per line, ``split`` arrays of hits.
    """
    if layout in ("lines", "split"):
        hits = _json(spark, path, "_id string, _source variant", layout)
    else:
        pages = _json(spark, path, "hits struct<hits:array<struct<_id:string,_source:variant>>>", "array")
        hits = pages.select(F.inline("hits.hits"))
    return hits.select("_id", F.col("_source").alias("doc"))


def read_sample_pages(spark: SparkSession, path, layout: str = "array") -> DataFrame:
    """Repository samples from a directory of result pages, one sample per line, or arrays of samples (``split``)."""
    if layout in ("lines", "split"):
        return _json(spark, path, schemas.SAMPLE, layout)
    return _json(spark, path, schemas.SAMPLE_PAGE, "array").select(F.inline("_embedded.samples"))


def read_groups(spark: SparkSession, path, layout: str = "lines") -> DataFrame:
    """Group records with contacts, organisations and member relationships."""
    return _json(spark, path, schemas.GROUP, layout)


def read_ruleset(spark: SparkSession, path, aliases: dict[str, str] = FIELD_ALIASES) -> DataFrame:
    """Field rules ``(section, field, status, section_pos, rule_pos)`` in document order."""
    return field_rules(_json(spark, path, schemas.RULESET, "array"), aliases)


def field_rules(ruleset: DataFrame, aliases: dict[str, str] = FIELD_ALIASES) -> DataFrame:
    """Flatten a rule set. A section is named by its condition's first material, else by its group."""
    groups = ruleset.select(F.posexplode("rule_groups").alias("section_pos", "g"))
    material = F.try_element_at("g.condition.attribute_value_match.Material", F.lit(1))
    rules = groups.select(
        F.coalesce(material, F.col("g.name")).alias("section"),
        "section_pos",
        F.posexplode("g.rules").alias("rule_pos", "r"),
    )
    field = lower_camel(F.col("r.name"))
    renamed = field
    for name, alias in aliases.items():
        renamed = F.when(field == name, F.lit(alias)).otherwise(renamed)
    return rules.select(
        "section", renamed.alias("field"), F.col("r.mandatory").alias("status"), "section_pos", "rule_pos"
    )


def read_field_list(spark: SparkSession, path) -> DataFrame:
    """Vocabulary field list ``(column, sheet, file, element)``; comments and blank lines are skipped."""
    rows = _tsv(spark, path, schemas.FIELD_LIST, comment="#", mode="PERMISSIVE")
    return rows.where(F.col("element").isNotNull())


def read_allowed_values(spark: SparkSession, path) -> DataFrame:
    """Vocabulary lists ``(file, tag, allowed)``: five leading cells, then any number of values."""
    cells = F.split("value", "\t")
    lines = spark.read.text(path).where((F.length("value") > 0) & ~F.col("value").startswith("#"))
    return lines.select(
        F.try_element_at(cells, F.lit(3)).alias("file"),
        F.try_element_at(cells, F.lit(4)).alias("tag"),
        F.filter(cells, lambda v, i: (i >= 5) & (F.length(v) > 0)).alias("allowed"),
    ).where(F.col("tag").isNotNull())


def read_table(spark: SparkSession, path: str, columns: Sequence[str] | None = None) -> DataFrame:
    """Relational table kept as Parquet."""
    df = spark.read.parquet(path)
    return df.select(*columns) if columns else df


# put in front of attribute values, which a variant would else turn into numbers and truth values
_MARK = "\ue000"
_ATTRIBUTE = r"""(\s[\w:.-]+\s*=\s*["'])"""
_PROLOGUE = r"^\s*<\?xml[^>]*\?>"
_OWNER = "struct<name:string,use:string,depth:int>"


def read_xml_documents(spark: SparkSession, path) -> DataFrame:
    """XML documents as ``(file, doc)``, one variant each; attributes are texts that start with a mark (see ``unmarked``).

    A document is one value, so its size is bounded by a row's; documents are read in parallel.
    """
    text = F.regexp_replace(F.regexp_replace("value", _PROLOGUE, ""), _ATTRIBUTE, f"$1{_MARK}")
    file = F.element_at(F.split(F.col("_metadata.file_path"), "/"), -1)
    return spark.read.text(path, wholetext=True).select(file.alias("file"), F.from_xml(text, "variant").alias("doc"))


def unmarked(value: Column) -> Column:
    """An attribute's text as written."""
    return F.replace(value, F.lit(_MARK), F.lit(""))


def one_or_many(node: Column) -> Column:
    """The values of a variant that holds one value or an array of them."""
    return F.coalesce(F.try_variant_get(node, "$", "array<variant>"), F.array(node))


def _attribute(node: Column, name: str) -> Column:
    return unmarked(F.try_variant_get(node, f"$._{name}", "string"))


def read_schema_lists(spark: SparkSession, path, prefix: str = "xs") -> DataFrame:
    """All enumerations and choices of XML schema documents, ``(file, owners, place, allowed)``.

    ``owners`` are the named nodes around a list, outermost first, ``(name, use,
    depth)``; ``place`` the positions that lead to it. Documents are scanned once
    and descended level by level: the children of a level's nodes are the next
    level, stored, so each node is looked at once at any depth.
    """
    named = F.struct(
        _attribute(F.col("node"), "name").alias("name"), _attribute(F.col("node"), "use").alias("use"), F.size("place").alias("depth")
    ).cast(_OWNER)
    owners = F.when(named["name"].isNotNull(), F.array_append("owners", named)).otherwise(F.col("owners"))

    def with_owners(nodes: DataFrame) -> DataFrame:
        return stored(nodes.withColumn("owners", owners), "xml_nodes")

    documents = read_xml_documents(spark, path)
    level = with_owners(
        documents.select(
            "file", F.lit("").alias("kind"), F.array().cast("array<int>").alias("place"), F.array().cast(f"array<{_OWNER}>").alias("owners"),
            F.col("doc").alias("node"),
        )
    )

    def listed(tag: str, attribute: str) -> Column:
        values = one_or_many(F.try_variant_get("node", f'$["{prefix}:{tag}"]', "variant"))
        return F.filter(F.transform(values, lambda v: _attribute(v, attribute)), lambda v: v.isNotNull())

    # a choice lists its elements, any other node its enumerated values
    allowed = F.when(F.col("kind") == f"{prefix}:choice", listed("element", "name")).otherwise(listed("enumeration", "value"))
    found = None
    while not level.isEmpty():
        lists = level.select("file", "owners", "place", allowed.alias("allowed")).where(F.size("allowed") > 0)
        found = lists if found is None else found.unionByName(lists)
        children = level.lateralJoin(spark.tvf.variant_explode(F.col("node").outer())).where(~F.col("key").startswith("_"))
        items = children.select("file", F.col("key").alias("kind"), "place", "owners", "pos", F.posexplode(one_or_many(F.col("value"))).alias("i", "node"))
        nested = items.where(F.schema_of_variant("node").startswith("OBJECT"))
        level = with_owners(nested.select("file", "kind", F.concat("place", F.array("pos", "i")).alias("place"), "owners", "node"))
    return found if found is not None else level.select("file", "owners", "place", F.array().cast("array<string>").alias("allowed"))


def read_schema_vocabularies(spark: SparkSession, path, prefix: str = "xs", inherit: bool = False) -> DataFrame:
    """Allowed values kept in XML schema documents, ``(file, tag, allowed, use)``, one row a file and name.

    Covers enumerations and choices of elements at any depth, below named simple
    and complex types, elements and attributes. A list belongs to the nearest
    named node around it; with ``inherit`` also to those further out, which then
    have the nearest of the lists inside them. If a file uses a name for several
    nodes with a list, the outermost one counts, and the first of equally deep ones.
    """
    lists = read_schema_lists(spark, path, prefix)
    chosen = F.col("owners") if inherit else F.slice("owners", -1, 1)
    owned = lists.where(F.size("owners") > 0).select("file", "place", "allowed", F.explode(chosen).alias("owner"))
    first = F.struct(F.col("owner.depth").alias("depth"), F.size("place").alias("below"), "place")
    value = F.min_by(F.struct("allowed", F.col("owner.use").alias("use")), first).alias("v")
    return owned.groupBy("file", F.col("owner.name").alias("tag")).agg(value).select("file", "tag", "v.allowed", "v.use")


def field_status(use: Column) -> Column:
    """``optional`` where the schema says so, NULL (taken as mandatory) otherwise."""
    return F.when(use == "optional", F.lit("optional"))
