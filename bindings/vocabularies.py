"""Controlled vocabularies, type names and hierarchies."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bindings.registry import query, settings, table
from metacurate.operators.entities import unpivot_columns
from metacurate.operators.hierarchy import expand, is_mandatory, path_dictionary, path_labels
from metacurate.operators.vocabulary import (
    allowed_for,
    conformance,
    offender_samples,
    rule_entries,
    type_names,
    vocabulary_lines,
    vocabulary_terms,
    vocabulary_union,
)
from metacurate.plans.schema_fields import mandatory_fields

_ALLOWED = [
    ("part", "p_type", ["STANDARD", "PROMO", "LARGE", "SMALL"]),
    ("part", "p_brand", [f"Brand#{i}" for i in range(1, 20)]),
    ("orders", "o_orderpriority", ["1-URGENT", "2-HIGH", "3-MEDIUM"]),
]


@query(
    "vocabulary_conformance",
    """
    SELECT 'p_type' AS "column", p_type AS value, CAST(count(*) AS BIGINT) AS n FROM part
    WHERE p_type NOT IN ('STANDARD', 'PROMO', 'LARGE', 'SMALL') GROUP BY ALL
    UNION ALL
    SELECT 'p_brand', p_brand, count(*) FROM part
    WHERE CAST(replace(p_brand, 'Brand#', '') AS INTEGER) NOT BETWEEN 1 AND 19 GROUP BY ALL
    UNION ALL
    SELECT 'o_orderpriority', o_orderpriority, count(*) FROM orders
    WHERE o_orderpriority NOT IN ('1-URGENT', '2-HIGH', '3-MEDIUM') GROUP BY ALL
    """,
)
def vocabulary_conformance(spark: SparkSession, sf: str) -> DataFrame:
    allowed = settings(spark, "file tag allowed", _ALLOWED)
    terms = vocabulary_terms(allowed, ["tag"]).withColumnRenamed("tag", "column")
    parts = unpivot_columns(table(spark, sf, "part"), "p_partkey", ["p_type", "p_brand", "p_name"])
    orders = unpivot_columns(table(spark, sf, "orders"), "o_orderkey", ["o_orderpriority"])
    values = parts.select(F.col("name").alias("column"), "value").unionByName(
        orders.select(F.col("name").alias("column"), "value")
    )
    return conformance(values, terms)


@query(
    "offender_samples",
    """
    WITH v AS (
      SELECT 'p_type' AS c, p_type AS value, p_partkey AS id FROM part WHERE p_type NOT IN ('STANDARD', 'PROMO', 'LARGE', 'SMALL')
      UNION ALL
      SELECT 'o_orderpriority', o_orderpriority, o_orderkey FROM orders WHERE o_orderpriority NOT IN ('1-URGENT', '2-HIGH', '3-MEDIUM')),
    k AS (SELECT *, count(*) OVER (PARTITION BY c, value) AS n,
                 row_number() OVER (PARTITION BY c, value ORDER BY md5(CAST(id AS VARCHAR))) AS place FROM v)
    SELECT c AS "column", value, n, string_agg(CAST(id AS VARCHAR), ', ' ORDER BY place) AS ids FROM k WHERE place <= 5 GROUP BY ALL
    """,
)
def samples_of_offenders(spark: SparkSession, sf: str) -> DataFrame:
    allowed = settings(spark, "file tag allowed", _ALLOWED)
    terms = vocabulary_terms(allowed, ["tag"]).withColumnRenamed("tag", "column")
    parts = unpivot_columns(table(spark, sf, "part"), "p_partkey", ["p_type", "p_name"])
    orders = unpivot_columns(table(spark, sf, "orders"), "o_orderkey", ["o_orderpriority"])
    values = parts.select(F.col("name").alias("column"), "value", F.col("p_partkey").alias("id")).unionByName(
        orders.select(F.col("name").alias("column"), "value", F.col("o_orderkey").alias("id"))
    )
    return offender_samples(values, terms, k=5).withColumn("ids", F.array_join(F.col("ids").cast("array<string>"), ", "))


@query(
    "allowed_lookup",
    """
    SELECT p_partkey,
           CASE WHEN p_size < 25 THEN
             CASE p_type WHEN 'ECONOMY' THEN 'a|b' WHEN 'SMALL' THEN 'c'
                  ELSE CASE p_brand WHEN 'Brand#2' THEN 'shared name' END END
           ELSE
             CASE p_type WHEN 'PROMO' THEN 'd|e|f'
                  ELSE CASE p_brand WHEN 'Brand#3' THEN 'own name' END END
           END AS allowed
    FROM part
    """,
)
def allowed_lookup(spark: SparkSession, sf: str) -> DataFrame:
    allowed = settings(
        spark,
        "file tag allowed",
        [
            ("common", "ECONOMY", ["a", "b"]),
            ("common", "SMALL", ["c"]),
            ("common", "Brand#2", ["shared name"]),
            ("own", "PROMO", ["d", "e", "f"]),
            ("own", "Brand#3", ["own name"]),
        ],
    )
    nodes = table(spark, sf, "part").select(
        "p_partkey",
        F.lit("own").alias("file"),
        F.col("p_brand").alias("name"),
        F.when(F.col("p_size") < 25, F.concat(F.lit("com:"), "p_type")).otherwise(F.col("p_type")).alias("type"),
    )
    return allowed_for(nodes, allowed, "common").select("p_partkey", F.array_join("allowed", "|").alias("allowed"))


def _value_lists(spark: SparkSession, sf: str) -> DataFrame:
    names = table(spark, sf, "part").select(
        F.lit("p_name").alias("column"),
        F.col("p_size").alias("list_pos"),
        F.col("p_partkey").alias("value_pos"),
        F.col("p_name").alias("value"),
    )
    priorities = table(spark, sf, "orders").select(
        F.lit("o_orderpriority").alias("column"),
        F.lit(0).alias("list_pos"),
        F.col("o_orderkey").alias("value_pos"),
        F.col("o_orderpriority").alias("value"),
    )
    return vocabulary_union(names.unionByName(priorities))




@query(
    "vocabulary_union",
    """
    SELECT 'p_name' AS "column", p_name AS value, first.s AS list_pos, first.p AS value_pos
    FROM (SELECT p_name, min({'s': p_size, 'p': p_partkey}) AS first FROM part GROUP BY p_name)
    UNION ALL
    SELECT 'o_orderpriority', o_orderpriority, 0, min(o_orderkey) FROM orders GROUP BY o_orderpriority
    """,
)
def union_of_lists(spark: SparkSession, sf: str) -> DataFrame:
    return _value_lists(spark, sf)


@query(
    "vocabulary_lines",
    """
    WITH u AS (
      SELECT 'p_name' AS c, p_name AS v, first.s AS s, first.p AS p
      FROM (SELECT p_name, min({'s': p_size, 'p': p_partkey}) AS first FROM part GROUP BY p_name)
      UNION ALL
      SELECT 'o_orderpriority', o_orderpriority, 0, min(o_orderkey) FROM orders GROUP BY o_orderpriority),
    k AS (SELECT *, count(*) OVER (PARTITION BY c) AS n, row_number() OVER (PARTITION BY c ORDER BY s, p, v) AS place FROM u)
    SELECT c AS "column", CAST(n AS BIGINT) AS n, (place - 1) // 16 AS part,
           string_agg(v, '|' ORDER BY s, p, v) AS "values"
    FROM k GROUP BY ALL
    """,
)
def lines_of_values(spark: SparkSession, sf: str) -> DataFrame:
    lines = vocabulary_lines(_value_lists(spark, sf), per_row=16)
    return lines.withColumn("values", F.array_join("values", "|"))


@query(
    "type_names",
    """
    SELECT p_brand AS file, p_type AS type, CAST(count(DISTINCT p_name) AS BIGINT) AS n, CAST(0 AS BIGINT) AS part,
           string_agg(DISTINCT p_name, '|' ORDER BY p_name) AS names
    FROM part GROUP BY ALL
    """,
)
def names_of_types(spark: SparkSession, sf: str) -> DataFrame:
    nodes = table(spark, sf, "part").select(
        F.col("p_brand").alias("file"), F.col("p_type").alias("type"), F.col("p_name").alias("name")
    )
    return type_names(nodes)


def _edges(spark: SparkSession, sf: str) -> DataFrame:
    """Regions are root elements, nations their children, customers the leaves, segments shared types."""
    file = F.lit("schema").alias("file")

    def edge(parent, name, type_):
        return [file, parent.alias("parent"), name.alias("name"), type_.alias("type")]

    def key(prefix: str, column: str):
        return F.concat(F.lit(prefix), F.col(column).cast("string"))

    regions = table(spark, sf, "region").select(*edge(F.lit(""), F.col("r_name"), key("R", "r_regionkey")))
    nations = table(spark, sf, "nation").select(*edge(key("R", "n_regionkey"), F.col("n_name"), key("N", "n_nationkey")))
    customers = table(spark, sf, "customer").select(
        *edge(key("N", "c_nationkey"), F.col("c_name"), F.col("c_mktsegment"))
    )
    # every segment leads back to the first region: a cycle for the paths through that region
    back = table(spark, sf, "customer").select("c_mktsegment").distinct().select(
        *edge(F.col("c_mktsegment"), F.concat(F.lit("back "), "c_mktsegment"), F.lit("R0"))
    )
    return regions.unionByName(nations).unionByName(customers).unionByName(back)


@query(
    "hierarchy_paths",
    """
    WITH RECURSIVE e AS (
      SELECT '' AS parent, r_name AS name, 'R' || r_regionkey AS type FROM region
      UNION ALL SELECT 'R' || n_regionkey, n_name, 'N' || n_nationkey FROM nation
      UNION ALL SELECT 'N' || c_nationkey, c_name, c_mktsegment FROM customer
      UNION ALL SELECT DISTINCT c_mktsegment, 'back ' || c_mktsegment, 'R0' FROM customer),
    t AS (SELECT DISTINCT parent, type FROM e),
    -- the paths to each type, without the names that share them
    p AS (
      SELECT type, [] :: VARCHAR[] AS path, 0 AS depth FROM t WHERE parent = ''
      UNION
      SELECT t.type, list_append(p.path, p.type), p.depth + 1
      FROM p JOIN t ON t.parent = p.type WHERE NOT list_contains(p.path, p.type)),
    n AS (
      SELECT name, type, [] :: VARCHAR[] AS path, 0 AS depth FROM e WHERE parent = ''
      UNION ALL
      SELECT e.name, e.type, list_append(p.path, p.type), p.depth + 1
      FROM p JOIN e ON e.parent = p.type WHERE NOT list_contains(p.path, p.type))
    SELECT depth, len(path) AS steps, path[1] AS root, CAST(count(*) AS BIGINT) AS n,
           CAST(count(DISTINCT path) AS BIGINT) AS n_paths, min(array_to_string(path, '/') || '>' || name) AS first_node
    FROM n GROUP BY ALL
    """,
)
def hierarchy_paths(spark: SparkSession, sf: str) -> DataFrame:
    nodes = expand(_edges(spark, sf))
    text = F.array_join("path", "/")
    return nodes.groupBy(
        "depth", F.size("path").cast("bigint").alias("steps"), F.get("path", F.lit(0)).alias("root")
    ).agg(
        F.count("*").alias("n"),
        F.countDistinct("path").alias("n_paths"),
        F.min(F.concat(text, F.lit(">"), "name")).alias("first_node"),
    )


@query(
    "path_dictionary",
    """
    WITH RECURSIVE e AS (
      SELECT '' AS parent, r_name AS name, 'R' || r_regionkey AS type FROM region
      UNION ALL SELECT 'R' || n_regionkey, n_name, 'N' || n_nationkey FROM nation
      UNION ALL SELECT 'N' || c_nationkey, c_name, c_mktsegment FROM customer
      UNION ALL SELECT DISTINCT c_mktsegment, 'back ' || c_mktsegment, 'R0' FROM customer),
    t AS (SELECT DISTINCT parent, type FROM e),
    p AS (
      SELECT type, [] :: VARCHAR[] AS path FROM t WHERE parent = ''
      UNION
      SELECT t.type, list_append(p.path, p.type) FROM p JOIN t ON t.parent = p.type WHERE NOT list_contains(p.path, p.type)),
    -- paths that some node hangs from
    d AS (SELECT DISTINCT list_append(p.path, p.type) AS path FROM p JOIN t ON t.parent = p.type WHERE NOT list_contains(p.path, p.type)),
    u AS (SELECT type, name FROM e WHERE parent = '' UNION SELECT e.type, e.name FROM e JOIN p ON p.type = e.parent WHERE NOT list_contains(p.path, p.type))
    SELECT md5(CAST(to_json(path) AS VARCHAR)) AS path_id, md5(CAST(to_json(path[:-2]) AS VARCHAR)) AS parent_id, path[-1] AS type,
           CAST(len(path) AS INTEGER) AS depth, CAST(count(DISTINCT name) AS BIGINT) AS n_names, min(name) AS first_name
    FROM d LEFT JOIN u ON u.type = path[-1] GROUP BY path
    """,
)
def dictionary_of_paths(spark: SparkSession, sf: str) -> DataFrame:
    """Paths in long form, with the names of their last type joined and counted."""
    paths, names = path_dictionary(expand(_edges(spark, sf)))
    used = names.groupBy("file", "type").agg(F.count("*").alias("n_names"), F.min("name").alias("first_name"))
    return paths.join(used, ["file", "type"]).drop("file")


@query(
    "hierarchy_labels",
    """
    WITH root AS (SELECT DISTINCT p_brand AS name, p_type AS type FROM part),
    label AS (SELECT type, string_agg(name, '|' ORDER BY name) AS label FROM root GROUP BY type)
    SELECT name, type, '' AS label, 0 AS depth FROM root
    UNION ALL
    SELECT p_name, NULL, label, 1 FROM (SELECT DISTINCT p_name, p_type FROM part) JOIN label ON type = p_type
    """,
)
def hierarchy_labels(spark: SparkSession, sf: str) -> DataFrame:
    part = table(spark, sf, "part")
    file = F.lit("schema").alias("file")
    roots = part.select(
        file, F.lit("").alias("parent"), F.col("p_brand").alias("name"), F.col("p_type").alias("type")
    )
    leaves = part.select(
        file, F.col("p_type").alias("parent"), F.col("p_name").alias("name"), F.lit(None).cast("string").alias("type")
    )
    nodes = expand(roots.unionByName(leaves).distinct())
    return path_labels(nodes).select("name", "type", "label", "depth")


@query(
    "mandatory_nodes",
    """
    SELECT p_brand AS parent, p_name AS name, CASE WHEN p_size > 25 THEN 'attribute' ELSE 'element' END AS kind,
           CAST(count(*) AS BIGINT) AS n
    FROM part
    WHERE CASE WHEN p_size > 25 THEN p_type = 'PROMO' ELSE p_type <> 'SMALL' END
    GROUP BY ALL
    """,
)
def mandatory_nodes(spark: SparkSession, sf: str) -> DataFrame:
    edges = table(spark, sf, "part").select(
        F.col("p_brand").alias("parent"),
        F.col("p_name").alias("name"),
        F.when(F.col("p_size") > 25, "attribute").otherwise("element").alias("kind"),
        F.when(F.col("p_type") == "SMALL", "0").when(F.col("p_type") == "LARGE", "1").alias("min_occurs"),
        F.when(F.col("p_type") == "PROMO", "required").when(F.col("p_type") == "LARGE", "optional").alias("use"),
    )
    return edges.where(is_mandatory()).groupBy("parent", "name", "kind").agg(F.count("*").alias("n"))


@query(
    "nested_groups",
    """
    WITH c AS (
      SELECT r_name AS file, c_mktsegment AS kind, c_name AS name, n_name AS path,
             count(*) OVER (PARTITION BY r_name, c_mktsegment) AS n,
             row_number() OVER (PARTITION BY r_name, c_mktsegment ORDER BY c_name) AS place
      FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)
    SELECT file, kind, n, (place - 1) // 20 AS part,
           '[' || string_agg('{"name":"' || name || '","path":"' || path || '"}', ',' ORDER BY name) || ']' AS entries
    FROM c GROUP BY ALL
    """,
)
def nested_groups(spark: SparkSession, sf: str) -> DataFrame:
    nations = table(spark, sf, "nation").join(
        table(spark, sf, "region"), F.col("n_regionkey") == F.col("r_regionkey")
    )
    nodes = (
        table(spark, sf, "customer")
        .join(nations, F.col("c_nationkey") == F.col("n_nationkey"))
        .select(
            F.col("r_name").alias("file"),
            F.col("c_mktsegment").alias("kind"),
            F.col("c_name").alias("name"),
            F.col("n_name").alias("path"),
            F.lit(None).cast("string").alias("desc"),
        )
    )
    entries = rule_entries(nodes, ["file", "kind"], ["name", "path", "desc"], identity=["name"], per_row=20)
    return entries.withColumn("entries", F.to_json("entries"))


@query(
    "mandatory_fields",
    """
    WITH label AS (SELECT p_type AS type, string_agg(DISTINCT p_brand, '|' ORDER BY p_brand) AS path
                   FROM part GROUP BY p_type)
    SELECT DISTINCT 'element' AS kind, p_brand AS name, '' AS path, 'root of ' || p_type AS "desc",
           CASE WHEN p_type = 'PROMO' THEN 'x|y' WHEN p_brand = 'Brand#3' THEN 'z' END AS allowed_values
    FROM part
    UNION ALL
    SELECT 'element', p_name, path, NULL, NULL
    FROM (SELECT DISTINCT p_name, p_type FROM part WHERE p_size <= 25) JOIN label ON type = p_type
    UNION ALL
    SELECT 'attribute', p_name, path, NULL, CASE WHEN p_name = 'red widget' THEN 'w' END
    FROM (SELECT DISTINCT p_name, p_type FROM part WHERE p_size > 25 AND p_type <> 'SMALL') JOIN label ON type = p_type
    """,
)
def fields_of_schemas(spark: SparkSession, sf: str) -> DataFrame:
    """Brands are root elements of their types; names are elements or attributes below them."""
    part = table(spark, sf, "part")
    none = F.lit(None).cast("string")
    large = F.col("p_size") > 25
    roots = part.select(
        F.lit("own").alias("file"), F.lit("").alias("parent"), F.col("p_brand").alias("name"),
        F.lit("element").alias("kind"), F.col("p_type").alias("type"), none.alias("min_occurs"), none.alias("use"),
        F.concat(F.lit("  root  of\n\t"), "p_type").alias("description"),
    )
    below = part.select(
        F.lit("own").alias("file"), F.col("p_type").alias("parent"), F.col("p_name").alias("name"),
        F.when(large, "attribute").otherwise("element").alias("kind"),
        F.when(large, "NA").otherwise("com:text").alias("type"), none.alias("min_occurs"),
        F.when(F.col("p_type") != "SMALL", "required").alias("use"), F.col("p_name").alias("description"),
    )
    allowed = settings(
        spark,
        "file tag allowed",
        [("own", "PROMO", ["x", "y"]), ("own", "Brand#3", ["z"]), ("own", "red widget", ["w"])],
    )
    fields = mandatory_fields(roots.unionByName(below).distinct(), allowed, "common")
    return fields.drop("file").withColumn("allowed_values", F.array_join("allowed_values", "|"))
