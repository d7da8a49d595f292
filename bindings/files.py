"""Readers and writers: rows derived from the tables are written, read back and compared."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bindings.audits import _COVERAGE, _profile, _rules
from bindings.curation import _documents, _worklist
from bindings.logs import _GROUPED, _dataset_members, _event_log, _item_log, _members, _order_log
from bindings.registry import query, table
from bindings.selection import _SELECTED, manifest
from metacurate.functions.text import words_from_camel
from metacurate.functions.values import at_path
from metacurate.operators.checkpoints import new_folder
from metacurate.operators.curation import curation_payload, remove_field
from metacurate.operators.entities import group_headers, group_members
from metacurate.operators.lookups import lookup_with_fallback
from metacurate.operators.ranks import ranked
from metacurate.operators.vocabulary import rule_entries
from metacurate.plans.reports import curation_candidates, dataset_error_lines, dataset_headers, group_error_lines, unmet
from metacurate.plans.coverage import coverage_audit
from metacurate.presets import MANIFEST_COLUMNS
from metacurate.sinks import writers
from metacurate.sources import readers


def _lines(df: DataFrame, label: str) -> str:
    """Write rows as tab-separated lines."""
    path = new_folder(df.sparkSession, label)
    df.select(F.concat_ws("\t", *df.columns).alias("value")).write.text(path)
    return path


@query(
    "source_sample_log",
    """
    SELECT 'C' || o_custkey AS id, CASE WHEN o_orderstatus = 'F' THEN 'pass' ELSE 'error' END AS overall,
           '(ERROR)status:' || o_orderstatus || ' not accepted' ||
           CASE WHEN o_orderpriority = '5-LOW' THEN ';(ERROR)priority:too low' ELSE ';(WARNING)priority:check' END
             AS detail, CAST(count(*) AS BIGINT) AS n
    FROM orders GROUP BY ALL
    """,
)
def sample_log(spark: SparkSession, sf: str) -> DataFrame:
    log = readers.read_sample_log(spark, _lines(_order_log(spark, sf), "sample-log"))
    return log.groupBy("id", "overall", "detail").agg(F.count("*").alias("n"))


@query(
    "source_experiment_log",
    """
    SELECT CAST(o_custkey AS VARCHAR) AS dataset, CASE WHEN l_returnflag = 'R' THEN 'error' ELSE 'pass' END AS overall,
           '(ERROR)flag:' || l_returnflag || ' returned;(WARNING)tax:check' AS detail, CAST(count(*) AS BIGINT) AS n
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY ALL
    """,
)
def experiment_log(spark: SparkSession, sf: str) -> DataFrame:
    lines = _item_log(spark, sf).select("id", "dataset", F.lit("x").alias("unused"), "overall", "detail")
    log = readers.read_experiment_log(spark, _lines(lines, "experiment-log"))
    return log.groupBy("dataset", "overall", "detail").agg(F.count("*").alias("n"))


@query(
    "sink_candidates",
    """
    SELECT DISTINCT 'U' || user_id AS sample, 'props' AS field FROM events WHERE event_type <> 'view'
    """,
)
def candidates(spark: SparkSession, sf: str) -> DataFrame:
    """The candidate list is the work-list of the curation operators."""
    found = curation_candidates(_event_log(spark, sf), ["This field is optional, so"])
    path = new_folder(spark, "candidates")
    writers.write_candidates(found, path)
    return readers.read_worklist(spark, path)


@query(
    "sink_manifest",
    f"""
    WITH {_SELECTED}
    SELECT 'R' || o_orderkey AS accession, c_name AS epigenome, CAST(o_orderkey AS VARCHAR) AS br,
           CASE WHEN is_input THEN '1' ELSE '0' END AS is_control, md5(path) AS md5sum, path AS local_url,
           coalesce(CASE WHEN NOT is_input THEN control END, '') AS control_id, 'RUNS-R' || o_orderkey AS xrefs
    FROM selected
    """,
)
def manifest_file(spark: SparkSession, sf: str) -> DataFrame:
    path = new_folder(spark, "manifest")
    writers.write_manifest(manifest(spark, sf), path)
    schema = ", ".join(f"`{c}` string" for c in MANIFEST_COLUMNS)
    rows = spark.read.schema(schema).option("header", True).csv(path)
    return rows.select(
        "accession", "epigenome", "br", "is_control", "md5sum", "local_url",
        F.coalesce("control_id", F.lit("")).alias("control_id"), "xrefs",
    )


@query(
    "sink_payloads",
    """
    SELECT 'D' || doc_id AS sample, f.field AS type
    FROM documents JOIN labels USING (doc_id), (VALUES ('lang'), ('size'), ('source')) AS f(field) WHERE toxic = 1
    """,
)
def payload_file(spark: SparkSession, sf: str) -> DataFrame:
    path = new_folder(spark, "payloads")
    records = remove_field(_worklist(spark, sf), _documents(spark, sf))
    writers.write_payloads(curation_payload(records, "self.lab"), path)
    schema = "sample string, curation struct<attributesPre:array<struct<type:string>>>, domain string"
    rows = spark.read.schema(schema).json(path)
    return rows.select("sample", F.get("curation.attributesPre", F.lit(0))["type"].alias("type"))


@query(
    "source_hits",
    """
    SELECT CAST(doc_id AS VARCHAR) AS id, lang, CAST(length(text) AS BIGINT) AS size, md5(text) AS checksum
    FROM documents
    """,
)
def hits(spark: SparkSession, sf: str) -> DataFrame:
    """Whole texts through search-hit documents."""
    path = new_folder(spark, "hits")
    source = F.struct(F.struct(F.col("lang").alias("text")).alias("material"), F.col("text").alias("body text"))
    table(spark, sf, "documents").select(
        F.col("doc_id").cast("string").alias("_id"), source.alias("_source")
    ).write.json(path)
    docs = readers.read_hits(spark, path, layout="lines")
    body = at_path(F.col("doc"), "body text")
    return docs.select(
        F.col("_id").alias("id"),
        at_path(F.col("doc"), "material.text").alias("lang"),
        F.length(body).cast("bigint").alias("size"),
        F.md5(body.cast("binary")).alias("checksum"),
    )


@query(
    "source_hit_arrays",
    """
    SELECT CAST(doc_id AS VARCHAR) AS id, lang, CAST(length(text) AS BIGINT) AS size, md5(text) AS checksum
    FROM documents
    """,
)
def hit_arrays(spark: SparkSession, sf: str) -> DataFrame:
    """Whole texts through array files of hits, one for each language and source, cut into byte ranges."""
    source = F.struct(F.struct(F.col("lang").alias("text")).alias("material"), F.col("text").alias("body text"))
    hit = F.to_json(F.struct(F.col("doc_id").cast("string").alias("_id"), source.alias("_source")))
    arrays = table(spark, sf, "documents").groupBy("lang", "source").agg(
        F.concat(F.lit("["), F.array_join(F.collect_list(hit), ",\n"), F.lit("]")).alias("value")
    )
    path = new_folder(spark, "hit-arrays")
    arrays.write.partitionBy("lang", "source").text(path)
    docs = readers.read_hits(spark, path, layout="split")
    body = at_path(F.col("doc"), "body text")
    return docs.select(
        F.col("_id").alias("id"), at_path(F.col("doc"), "material.text").alias("lang"), F.length(body).cast("bigint").alias("size"),
        F.md5(body.cast("binary")).alias("checksum"),
    )


@query(
    "source_samples",
    """
    SELECT 'D' || doc_id AS accession, lang, 'the "' || source || '"' AS source, CAST(n_chars AS VARCHAR) AS size
    FROM documents
    """,
)
def samples(spark: SparkSession, sf: str) -> DataFrame:
    path = new_folder(spark, "samples")
    _documents(spark, sf).write.json(path)
    rows = readers.read_sample_pages(spark, path, layout="lines")
    fields = F.col("characteristics")
    return rows.select(
        "accession",
        fields["lang"][1]["text"].alias("lang"),
        fields["source"][1]["text"].alias("source"),
        fields["size"][0]["text"].alias("size"),
    )


@query(
    "source_entities",
    "SELECT 'P' || p_partkey AS id, p_type AS first, CAST(p_size AS VARCHAR) AS last FROM part",
)
def entities(spark: SparkSession, sf: str) -> DataFrame:
    """Two versions of every entity are written; the one with the higher position counts."""

    def attribute(name: str, value):
        return F.struct(F.lit(name).alias("name"), value.alias("value"), F.lit(None).cast("string").alias("term_source_id"))

    path = new_folder(spark, "entities")
    current = F.array(attribute("type", F.col("p_type")), attribute("size", F.col("p_size").cast("string")))
    outdated = F.array(attribute("type", F.lit("outdated")))
    table(spark, sf, "part").select(
        F.concat(F.lit("P"), F.col("p_partkey").cast("string")).alias("id"),
        F.inline(
            F.array(
                F.struct(F.lit(1).cast("bigint").alias("pos"), current.alias("attributes")),
                F.struct(F.lit(0).cast("bigint").alias("pos"), outdated.alias("attributes")),
            )
        ),
    ).write.json(path)
    rows = readers.read_entities(spark, path, layout="lines", on_duplicate="last", position="pos")
    attributes = F.col("attributes")
    return rows.select(
        "id",
        attributes[0]["value"].alias("first"),
        F.try_element_at(attributes, F.lit(-1))["value"].alias("last"),
    )


@query(
    "sink_vocabulary",
    """
    SELECT p_brand AS tag, string_agg(DISTINCT p_type, '|' ORDER BY p_type) AS allowed FROM part GROUP BY p_brand
    """,
)
def vocabulary_file(spark: SparkSession, sf: str) -> DataFrame:
    """The vocabulary lines written here are the allowed-value lists read there."""
    allowed = table(spark, sf, "part").groupBy(F.col("p_brand").alias("element")).agg(
        F.array_sort(F.collect_set("p_type")).alias("allowed")
    )
    path = new_folder(spark, "vocabulary")
    fields = allowed.select(
        F.lit("COLUMN").alias("column"), F.lit("sheet").alias("sheet"), F.lit("a.xsd").alias("file"), "element", "allowed"
    )
    writers.write_vocabulary(fields, path, with_file=True)
    lists = readers.read_allowed_values(spark, path)
    return lists.select("tag", F.array_join("allowed", "|").alias("allowed"))


@query(
    "source_schema_vocabularies",
    """
    SELECT p_brand AS tag, string_agg(DISTINCT p_type, '|' ORDER BY p_type) AS allowed,
           CAST(NULL AS VARCHAR) AS use FROM part GROUP BY p_brand
    UNION ALL
    SELECT 'attribute ' || p_type, string_agg(DISTINCT p_brand, '|' ORDER BY p_brand), 'optional' FROM part GROUP BY p_type
    """,
)
def schema_vocabularies(spark: SparkSession, sf: str) -> DataFrame:
    """Enumerations of XML schema documents: brands as named types, types as optional attributes."""
    part = table(spark, sf, "part")
    body = '<xs:restriction base="xs:string">%s</xs:restriction>'

    def documents(key: str, value: str, wrapped: str) -> DataFrame:
        """One document per key, each in a file of its own."""
        item = F.format_string('<xs:enumeration value="%s"/>', value)
        lists = part.groupBy(F.col(key).alias("tag")).agg(F.array_join(F.array_sort(F.collect_set(item)), "").alias("v"))
        return lists.select(
            F.format_string(f"<xs:schema>{wrapped}</xs:schema>", "tag", "v").alias("value"), F.col("tag").alias("document")
        )

    simple = documents("p_brand", "p_type", f'<xs:simpleType name="%s">{body}</xs:simpleType>')
    inline = documents(
        "p_type",
        "p_brand",
        '<xs:complexType><xs:attribute name="attribute %s" use="optional">'
        f"<xs:simpleType>{body}</xs:simpleType></xs:attribute></xs:complexType>",
    )
    path = new_folder(spark, "schemas")
    simple.unionByName(inline).write.partitionBy("document").text(path)
    found = readers.read_schema_vocabularies(spark, path)
    return found.select("tag", F.array_join("allowed", "|").alias("allowed"), "use")


@query(
    "source_nested_schemas",
    """
    WITH c AS (SELECT p_brand, p_type, string_agg(DISTINCT p_name, '|' ORDER BY p_name) AS names FROM part GROUP BY ALL),
    s AS (SELECT p_brand, p_type, string_agg(DISTINCT lpad(CAST(p_size AS VARCHAR), 3, '0'), '|'
                 ORDER BY lpad(CAST(p_size AS VARCHAR), 3, '0')) AS sizes FROM part GROUP BY ALL)
    SELECT p_brand || '>' || p_type AS owners, names AS allowed, 'choice' AS form FROM c
    UNION ALL
    SELECT p_brand || '>' || p_type || '>size', sizes, 'enumeration' FROM s
    """,
)
def nested_schemas(spark: SparkSession, sf: str) -> DataFrame:
    """Elements inside elements: each type of a brand is a choice of names beside an enumeration of sizes."""
    part = table(spark, sf, "part")
    size = F.lpad(F.col("p_size").cast("string"), 3, "0")
    element, value = F.format_string('<xs:element name="%s"/>', "p_name"), F.format_string('<xs:enumeration value="%s"/>', size)
    types = part.groupBy("p_brand", "p_type").agg(
        F.array_join(F.array_sort(F.collect_set(element)), "").alias("names"), F.array_join(F.array_sort(F.collect_set(value)), "").alias("sizes")
    )
    inner = F.format_string(
        '<xs:element name="%s"><xs:complexType><xs:sequence><xs:choice>%s</xs:choice><xs:element name="size"><xs:simpleType>'
        '<xs:restriction base="xs:string">%s</xs:restriction></xs:simpleType></xs:element></xs:sequence></xs:complexType></xs:element>',
        "p_type", "names", "sizes",
    )
    brands = types.groupBy("p_brand").agg(F.array_join(F.array_sort(F.collect_list(inner)), "").alias("types"))
    document = F.format_string(
        '<?xml version="1.0"?><xs:schema><xs:complexType name="%s"><xs:sequence>%s</xs:sequence></xs:complexType></xs:schema>', "p_brand", "types"
    )
    path = new_folder(spark, "schemas")
    brands.select(document.alias("value"), F.col("p_brand").alias("document")).write.partitionBy("document").text(path)
    lists = readers.read_schema_lists(spark, path)
    form = F.when(F.size("owners") == 2, "choice").otherwise("enumeration")
    return lists.select(
        F.array_join("owners.name", ">").alias("owners"), F.array_join("allowed", "|").alias("allowed"), form.alias("form")
    )


def _ruleset_file(df: DataFrame, section: str, label: str) -> str:
    """A rule document of ``(section, material, name, mandatory)`` rows, sections and rules in order of their names."""
    rule = F.struct("name", "mandatory")
    groups = df.groupBy(section, "material").agg(F.array_sort(F.collect_list(rule)).alias("rules"))
    condition = F.struct(F.struct(F.when(F.col("material").isNotNull(), F.array("material", F.lit("other"))).alias("Material")).alias("attribute_value_match"))
    group = F.struct(F.col(section).alias("name"), condition.alias("condition"), "rules")
    path = new_folder(df.sparkSession, label)
    groups.agg(F.array_sort(F.collect_list(group)).alias("rule_groups")).select(F.to_json(F.struct("rule_groups")).alias("value")).write.text(path)
    return path


@query(
    "source_ruleset",
    """
    WITH g AS (SELECT p_brand, CASE WHEN p_brand < 'Brand#2' THEN min(p_type) END AS material,
                      row_number() OVER (ORDER BY p_brand) - 1 AS section_pos FROM part GROUP BY p_brand),
    r AS (SELECT p_brand, p_name, CASE WHEN max(p_size) > 25 THEN 'mandatory' ELSE 'optional' END AS status FROM part GROUP BY ALL),
    n AS (SELECT *, row_number() OVER (PARTITION BY p_brand ORDER BY p_name) - 1 AS rule_pos, string_split(p_name, ' ') AS w FROM r)
    SELECT coalesce(material, p_brand) AS section,
           CASE WHEN p_name = 'red widget' THEN 'description' ELSE w[1] || upper(w[2][1]) || w[2][2:] END AS field,
           status, CAST(section_pos AS INTEGER) AS section_pos, CAST(rule_pos AS INTEGER) AS rule_pos
    FROM n JOIN g USING (p_brand)
    """,
)
def ruleset(spark: SparkSession, sf: str) -> DataFrame:
    """Rule groups of brands, some with a condition that names the section."""
    part = table(spark, sf, "part")
    first = part.groupBy("p_brand").agg(F.min("p_type").alias("material"))
    rules = part.groupBy("p_brand", F.col("p_name").alias("name")).agg(
        F.when(F.max("p_size") > 25, "mandatory").otherwise("optional").alias("mandatory")
    )
    named = rules.join(first, "p_brand").withColumn("material", F.when(F.col("p_brand") < "Brand#2", F.col("material")))
    return readers.read_ruleset(spark, _ruleset_file(named, "p_brand", "ruleset"), aliases={"redWidget": "description"})


@query(
    "sink_coverage",
    f"""
    WITH {_COVERAGE},
    d AS (SELECT section, status, field, total, n, p, CASE WHEN total > 0 THEN n / total END AS r, CASE WHEN total > 0 THEN p / total END AS q,
                 list_position(['standard', 'organism', 'specimen from organism', 'pool of specimens', 'cell specimen', 'cell culture', 'cell line'],
                               section) AS s FROM c),
    a AS (SELECT section, status, r, q, s + 3 AS s FROM d WHERE total > 0
          UNION ALL
          SELECT CASE WHEN s <= 2 THEN 'animal' ELSE 'specimen' END, status, r, q, CASE WHEN s <= 2 THEN 2 ELSE 3 END FROM d WHERE total > 0
          UNION ALL SELECT 'overall', status, r, q, 1 FROM d WHERE total > 0)
    SELECT 'detail' AS block, row_number() OVER (ORDER BY s, status DESC) - 1 AS place, section, status,
           CASE field WHEN 'birthDate' THEN 'birth date' ELSE field END AS field, CAST(total AS BIGINT) AS total, CAST(n AS BIGINT) AS "count",
           round(r, 6) AS excluding, CAST(p AS BIGINT) AS present, round(q, 6) AS including
    FROM d
    UNION ALL
    SELECT 'averages', row_number() OVER (ORDER BY s, status DESC) - 1, section, status, NULL, NULL, NULL, round(avg(r), 6), NULL, round(avg(q), 6)
    FROM a GROUP BY section, status, s
    """,
)
def coverage_file(spark: SparkSession, sf: str) -> DataFrame:
    """From a rule document over the documents to the lines of the written report, in order."""
    organism = F.col("section") == "organism"
    # one section is named by its condition, and one field is written under its other name
    rules = _rules(spark).select(
        F.when(organism, "animal").otherwise(F.col("section")).alias("section"), F.when(organism, F.col("section")).alias("material"),
        F.when(F.col("field") == "description", "Sample Description").otherwise(words_from_camel(F.col("field"))).alias("name"),
        F.col("status").alias("mandatory"),
    )
    read = readers.read_ruleset(spark, _ruleset_file(rules, "section", "rules"))
    report = coverage_audit(_profile(spark, sf), read)
    path = new_folder(spark, "coverage")
    writers.write_coverage(report.detail, report.averages, path)
    head = "section string, status string"

    def block(name: str, columns: str, *picked) -> DataFrame:
        lines = spark.read.schema(f"{head}, {columns}").option("sep", "\t").option("header", True).option("nullValue", "NA").csv(f"{path}/{name}")
        at = lines.withColumns({"_file": F.input_file_name(), "_start": F.input_file_block_start(), "_line": F.monotonically_increasing_id()})
        placed = ranked(at, [], ["_file", "_start", "_line"], rank="place")
        return placed.select(F.lit(name).alias("block"), "place", "section", "status", *picked)

    detail = block(
        "detail", "field string, total bigint, count bigint, excluding double, present bigint, including double",
        "field", "total", "count", F.round("excluding", 6).alias("excluding"), "present", F.round("including", 6).alias("including"),
    )
    averages = block(
        "averages", "excluding double, including double", F.round("excluding", 6).alias("excluding"), F.round("including", 6).alias("including")
    )
    return detail.unionByName(averages, allowMissingColumns=True)


@query(
    "source_lookups",
    """
    SELECT o_orderkey, CASE WHEN o_orderpriority = '1-URGENT' THEN 'manual ' || o_orderkey
                            WHEN o_orderstatus <> 'F' THEN 'auto ' || o_orderkey
                            WHEN o_orderpriority = '2-HIGH' THEN 'late ' || o_orderkey END AS control
    FROM orders
    """,
)
def lookup_files(spark: SparkSession, sf: str) -> DataFrame:
    """Three ordered files: the first has empty values, which count as absent, and a key may be in several."""
    orders = table(spark, sf, "orders")
    key = F.col("o_orderkey").cast("string")

    def written(name: str, condition: str, empty: str = "false") -> str:
        path = new_folder(spark, name)
        value = F.when(F.expr(empty), "").otherwise(F.concat(F.lit(f"{name} "), key))
        orders.where(condition).select(key.alias("key"), value.alias("value")).write.json(path)
        return path

    paths = [
        written("manual", "o_orderpriority IN ('1-URGENT', '2-HIGH')", "o_orderpriority = '2-HIGH'"),
        written("auto", "o_orderstatus <> 'F'"),
        written("late", "o_orderpriority = '2-HIGH'"),
    ]
    lookups = readers.read_lookups(spark, paths, layout="lines")
    found = lookup_with_fallback(orders.withColumn("key", key), lookups, "key", "control")
    return found.select("o_orderkey", "control")


@query(
    "source_groups",
    """
    SELECT 'G' || c_nationkey AS group_id, n_name AS name, n_name || ' desk, ' || n_name AS contacts,
           CASE WHEN n_regionkey <> 1 THEN lower(n_name) || '@lab.org' END AS emails, 'Lab' AS organizations, 'C' || c_custkey AS id
    FROM customer JOIN nation ON c_nationkey = n_nationkey
    """,
)
def group_records(spark: SparkSession, sf: str) -> DataFrame:
    """Group records, written with their members and read again."""
    nation = table(spark, sf, "nation")
    group = F.concat(F.lit("G"), F.col("c_nationkey").cast("string"))

    def relation(kind: str, source):
        target = F.concat(F.lit("C"), F.col("c_custkey").cast("string"))
        return F.struct(F.lit(kind).alias("type"), source.alias("source"), target.alias("target"))

    members = table(spark, sf, "customer").select("c_nationkey", F.explode(F.array(
        relation("has member", group), relation("has member", group), relation("derived from", group), relation("has member", F.lit("X")),
    )).alias("r"))
    listed = members.groupBy("c_nationkey").agg(F.collect_list("r").alias("relationships"))
    mail = F.when(F.col("n_regionkey") != 1, F.concat(F.lower("n_name"), F.lit("@lab.org")))
    contacts = F.array(
        F.struct(F.concat("n_name", F.lit(" desk")).alias("Name"), mail.alias("E-mail")),
        F.struct(F.col("n_name").alias("Name"), F.lit(None).cast("string").alias("E-mail")),
    )
    lab = F.struct(F.lit("Lab").alias("Name"))
    path = new_folder(spark, "groups")
    nation.join(listed, F.col("c_nationkey") == F.col("n_nationkey")).select(
        F.concat(F.lit("G"), F.col("n_nationkey").cast("string")).alias("accession"), F.col("n_name").alias("name"),
        contacts.alias("contact"), F.array(lab, lab).alias("organization"), "relationships",
    ).write.json(path)
    records = readers.read_groups(spark, path)
    headers = group_headers(records).select("group_id", "name", "contacts", "emails", "organizations")
    return headers.join(group_members(records), "group_id")


@query(
    "sink_ruleset_fields",
    """
    SELECT 'column ' || p_type AS name, 'sheet of ' || p_type AS expected_sheet, 'text' AS type,
           string_agg(DISTINCT p_name, '|' ORDER BY p_name) AS valid_values, CASE WHEN p_type < 'M' THEN 'optional' END AS mandatory
    FROM part GROUP BY p_type
    """,
)
def ruleset_of_lists(spark: SparkSession, sf: str) -> DataFrame:
    """A field list joined to the allowed values of a schema, written as rule-set entries and read again."""
    part = table(spark, sf, "part")
    types = part.groupBy("p_type").agg(F.array_sort(F.collect_set("p_name")).alias("names"))
    listed = types.select(
        F.explode(F.array(
            F.concat_ws("\t", F.lit("#comment"), "p_type"),
            F.concat_ws("\t", F.concat(F.lit("column "), "p_type"), F.concat(F.lit("sheet of "), "p_type"), F.lit("own.xsd"), "p_type"),
            F.lit(""),
        )).alias("value")
    )
    fields, schema = new_folder(spark, "field-list"), new_folder(spark, "schema")
    listed.write.text(fields)
    values = F.array_join(F.transform("names", lambda n: F.format_string('<xs:enumeration value="%s"/>', n)), "")
    attribute = F.format_string(
        '<xs:attribute name="%s" use="%s"><xs:simpleType><xs:restriction base="xs:string">%s</xs:restriction></xs:simpleType></xs:attribute>',
        "p_type", F.when(F.col("p_type") < "M", "optional").otherwise("required"), values,
    )
    document = F.format_string("<xs:schema><xs:complexType>%s</xs:complexType></xs:schema>", F.array_join(F.collect_list(attribute), ""))
    types.agg(document.alias("value")).write.text(schema)
    allowed = readers.read_schema_vocabularies(spark, schema).select(
        F.col("tag").alias("element"), "allowed", readers.field_status(F.col("use")).alias("mandatory")
    )
    path = new_folder(spark, "ruleset-fields")
    writers.write_rule_entries(writers.ruleset_fields(readers.read_field_list(spark, fields).join(allowed, "element")), path)
    read = spark.read.schema("name string, expected_sheet string, type string, valid_values array<string>, mandatory string").json(path)
    return read.withColumn("valid_values", F.array_join("valid_values", "|"))


@query(
    "sink_rule_entries",
    """
    SELECT p_brand AS file, p_type AS kind, p_name AS name, CASE WHEN max(p_size) > 25 THEN 'large' END AS "desc"
    FROM part GROUP BY ALL
    """,
)
def rule_file(spark: SparkSession, sf: str) -> DataFrame:
    nodes = (
        table(spark, sf, "part")
        .groupBy(F.col("p_brand").alias("file"), F.col("p_type").alias("kind"), F.col("p_name").alias("name"))
        .agg(F.when(F.max("p_size") > 25, "large").alias("desc"))
    )
    path = new_folder(spark, "rules")
    writers.write_rule_entries(rule_entries(nodes, ["file", "kind"], ["name", "desc"], identity=["name"]), path)
    schema = "file string, kind string, entries array<struct<name:string,desc:string>>"
    return spark.read.schema(schema).json(path).select("file", "kind", F.inline("entries"))


def _printed(spark: SparkSession, path: str, records: str) -> DataFrame:
    """The lines of a written report in order, each affected id on a place of its own, ``(place, item)``."""
    begun = F.lit(f"Affected {records} records: ")
    value = F.col("value")
    items = (
        F.when(value.startswith(begun), F.concat(F.array(F.rtrim(begun)), F.split(F.replace("value", begun), ", ")))
        .when(value.startswith(", "), F.split(F.substring(value, 3, 2147483647), ", "))
        .otherwise(F.array(value))
    )
    lines = spark.read.text(path).select(
        F.input_file_name().alias("file"), F.input_file_block_start().alias("start"),
        F.monotonically_increasing_id().alias("line"), F.posexplode(items).alias("pos", "item"),
    )
    return ranked(lines, [], ["file", "start", "line", "pos"], rank="place").select("place", "item")


def _page(headers: list[str], shown: str, lines: str, records: str) -> str:
    """SQL for the printed report: ``shown`` holds the groups, ``lines`` ``(g, severity, msg, id)``."""
    parts = [f"SELECT g, 0 AS section, '' AS severity, '' AS msg, {i} AS line, '' AS id, {h} AS item FROM {shown}" for i, h in enumerate(headers)]
    texts = [
        "''", "'List of fields that are in ' || severity || ': ' || string_split(msg, ':')[1]",
        "'Summary of ' || severity || ': ' || string_split(msg, ':')[2]", f"'Affected {records} records:'",
    ]
    messages = f"(SELECT DISTINCT g, severity, msg FROM {lines})"
    parts += [f"SELECT g, 1, severity, msg, {i}, '', {t} FROM {messages}" for i, t in enumerate(texts)]
    parts += [f"SELECT g, 1, severity, msg, 9, id, id FROM {lines}"]
    parts += [f"SELECT g, 2, '', '', {i}, '', '' FROM {shown}" for i in range(4)]
    order = "g, section, severity, msg, line, id"
    return f"SELECT row_number() OVER (ORDER BY {order}) - 1 AS place, item FROM ({' UNION ALL '.join(parts)})"


def _group_records(spark: SparkSession, sf: str) -> DataFrame:
    """Group records of nations, with two contacts, one of which has no e-mail, and one organisation twice."""
    nations = table(spark, sf, "nation").join(table(spark, sf, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    contact = "struct<Name:string,`E-mail`:string>"
    desk = F.struct(F.concat("n_name", F.lit(" desk")).alias("Name"), F.concat(F.lower("n_name"), F.lit("@lab.org")).alias("E-mail"))
    office = F.struct(F.col("r_name").alias("Name"), F.lit(None).cast("string").alias("E-mail"))
    organisation = F.struct(F.concat(F.lit("Institute of "), "r_name").alias("Name"))
    return nations.select(
        F.concat(F.lit("G"), F.col("n_nationkey").cast("string")).alias("accession"),
        F.col("n_name").alias("name"),
        F.create_map(F.lit("Submission Title"), F.array(F.struct(F.concat(F.lit("samples of "), "n_name").alias("text")))).alias("characteristics"),
        F.lit("2018-01-01").alias("releaseDate"),
        F.lit("2019-02-03").alias("updateDate"),
        F.when(F.col("n_regionkey") == 1, F.array(office)).otherwise(F.array(desk, office)).cast(f"array<{contact}>").alias("contact"),
        F.array(organisation, organisation).alias("organization"),
    )


GROUP_TITLES = [
    ("Submission id", "group_id"), ("Submission name", "name"), ("Submission title", "title"), ("Release date", "release_date"),
    ("Update date", "update_date"), ("Submitters", "contacts"), ("Submitter emails", "emails"), ("Submitter institution", "organizations"),
]
_GROUP_HEADER = [
    "'Submission id: ' || g", "'Submission name: ' || n_name", "'Submission title: samples of ' || n_name",
    "'Release date: 2018-01-01'", "'Update date: 2019-02-03'",
    "'Submitters: ' || CASE WHEN n_regionkey = 1 THEN '' ELSE n_name || ' desk, ' END || r_name",
    "CASE WHEN n_regionkey <> 1 THEN 'Submitter emails: ' || lower(n_name) || '@lab.org' END",
    "'Submitter institution: Institute of ' || r_name",
]


@query(
    "sink_report",
    f"""
    WITH {_GROUPED},
    shown AS (SELECT 'G' || n_nationkey AS g, n_name, n_regionkey, r_name FROM nation JOIN region ON n_regionkey = r_regionkey
              WHERE 'G' || n_nationkey IN (SELECT group_id FROM a)),
    ids AS (SELECT group_id AS g, severity, msg, id FROM a WHERE group_id IN (SELECT g FROM shown)),
    page AS ({_page(_GROUP_HEADER, "shown", "ids", "sample")})
    -- a group without e-mails has no such line
    SELECT row_number() OVER (ORDER BY place) - 1 AS place, item FROM page WHERE item IS NOT NULL
    """,
)
def report_file(spark: SparkSession, sf: str) -> DataFrame:
    """Every line of the written report by group, in the order of the files."""
    path = new_folder(spark, "report")
    headers = group_headers(_group_records(spark, sf))
    lines = group_error_lines(_order_log(spark, sf), _members(spark, sf), per_row=40)
    writers.write_report(headers, lines, GROUP_TITLES, "group_id", "sample", path)
    return _printed(spark, path, "sample")


DATASET_TITLES = [
    ("Study id", "dataset"), ("Secondary accession", "secondary_accession"), ("Title", "title"), ("Animals", "animals"),
    ("Instruments", "instruments"), ("Centres", "centres"),
]
_DATASET_HEADER = [
    "'Study id: ' || g", "'Secondary accession: S' || g", "'Title: ' || c_name",
    "'Animals: ' || lower(c_mktsegment) || ', ' || upper(c_mktsegment)", "'Instruments: ' || c_mktsegment", "'Centres: '",
]


@query(
    "sink_dataset_report",
    f"""
    WITH shown AS (SELECT CAST(c_custkey AS VARCHAR) AS g, c_name, c_mktsegment FROM customer
                   WHERE c_mktsegment NOT IN ('MACHINERY', 'BUILDING')),
    ids AS (SELECT DISTINCT CAST(o_custkey AS VARCHAR) AS g, 'error' AS severity, 'flag:R returned' AS msg,
                   CAST(l_orderkey AS VARCHAR) AS id
            FROM lineitem JOIN orders ON l_orderkey = o_orderkey
            WHERE l_returnflag = 'R' AND CAST(o_custkey AS VARCHAR) IN (SELECT g FROM shown))
    {_page(_DATASET_HEADER, "shown", "ids", "experiment")}
    """,
)
def dataset_report_file(spark: SparkSession, sf: str) -> DataFrame:
    """Every line of the written report by dataset; datasets without errors have their header as well."""
    segment = F.col("c_mktsegment")
    customer = table(spark, sf, "customer").where(segment != "MACHINERY")
    documents = customer.select(
        F.col("c_custkey").cast("string").alias("id"),
        F.when(segment == "BUILDING", "core").alias("standardMet"),
        F.concat(F.lit("S"), F.col("c_custkey").cast("string")).alias("secondaryAccession"),
        F.col("c_name").alias("title"),
        F.array(F.struct(F.lower(segment).alias("text")), F.struct(F.upper(segment).alias("text"))).alias("species"),
        F.array(segment).alias("instrument"),
        F.array().cast("array<string>").alias("centerName"),
    )
    headers = dataset_headers(unmet(documents, "core"))
    lines = dataset_error_lines(_item_log(spark, sf), _dataset_members(spark, sf), headers, per_row=3)
    path = new_folder(spark, "dataset-report")
    writers.write_report(headers, lines, DATASET_TITLES, "dataset", "experiment", path, include_all=True)
    return _printed(spark, path, "experiment")
