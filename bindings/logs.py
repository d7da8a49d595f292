"""Validation logs composed from table rows, parsed and reported."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bindings.registry import query, table
from metacurate.operators.checkpoints import stored
from metacurate.operators.entities import group_ids, project_samples
from metacurate.plans.reports import (
    curation_candidates,
    dataset_error_report,
    group_error_lines,
    group_error_report,
    log_messages,
    message_parts,
    not_imported,
    not_imported_errors,
    unmet,
)
from metacurate.sinks.writers import report_lines
from metacurate.sources.schemas import CHARACTERISTIC, RELATIONSHIP

_NOISE = ["seq:attribute not in rule set"]


def _event_log(spark: SparkSession, sf: str) -> DataFrame:
    """One line per event: a dated complaint, one with brackets, noise, a warning and an empty entry."""
    day = F.date_format("ts", "d/M/yyyy")
    detail = F.concat(
        F.lit("(ERROR)"), "event_type", F.lit(":Collection Date "), day, F.lit(" is in the future;"),
        F.lit("(ERROR)"), "event_type", F.lit(":value (of "), F.col("event_type"), F.lit(") is: wrong;;"),
        F.lit("(ERROR)seq:attribute not in rule set;"),
        F.lit("(WARNING)"), "event_type", F.lit(":no text provided;"),
        F.lit("(Error)props:This field is optional, so drop it;"),
    )
    overall = F.when(F.col("event_type") == "view", "warning").otherwise("error")
    return table(spark, sf, "events").select(
        F.concat(F.lit("U"), F.col("user_id").cast("string")).alias("id"),
        F.col("event_type").alias("type"),
        overall.alias("overall"),
        detail.alias("detail"),
    )


_LINES = """
    l AS (SELECT 'U' || user_id AS id, CASE WHEN event_type = 'view' THEN 'warning' ELSE 'error' END AS overall,
                 '(ERROR)' || event_type || ':Collection Date ' || strftime(ts, '%-d/%-m/%Y') || ' is in the future;'
                 || '(ERROR)' || event_type || ':value (of ' || event_type || ') is: wrong;;'
                 || '(ERROR)seq:attribute not in rule set;(WARNING)' || event_type || ':no text provided;'
                 || '(Error)props:This field is optional, so drop it;' AS detail
          FROM events),
    e AS (SELECT id, overall, unnest(string_split(detail, ';')) AS entry FROM l),
    m AS (SELECT id, overall, lower(substr(string_split(entry, ')')[1], 2)) AS severity,
                 string_split(entry, ')')[2] AS raw
          FROM e WHERE entry <> '')
"""
_STRIPPED = r"regexp_replace(raw, '^(.+Date)\s\d+/\d+/\d+\s(.+)$', '\1 \2')"


@query(
    "log_messages",
    f"""
    WITH {_LINES},
    s AS (SELECT DISTINCT id, severity, {_STRIPPED} AS msg FROM m
          WHERE overall = 'error' AND severity = 'error' AND raw <> 'seq:attribute not in rule set')
    SELECT id, severity, msg, string_split(msg, ':')[1] AS field, string_split(msg, ':')[2] AS detail FROM s
    """,
)
def messages(spark: SparkSession, sf: str) -> DataFrame:
    return message_parts(log_messages(_event_log(spark, sf), noise=_NOISE))


@query(
    "log_messages_with_warnings",
    f"""
    WITH {_LINES},
    s AS (SELECT DISTINCT id, severity, {_STRIPPED} AS msg FROM m WHERE raw <> 'seq:attribute not in rule set')
    SELECT severity, msg, CAST(count(*) AS BIGINT) AS n, min(id) AS first_id FROM s GROUP BY ALL
    """,
)
def messages_with_warnings(spark: SparkSession, sf: str) -> DataFrame:
    found = log_messages(_event_log(spark, sf), include_warnings=True, noise=_NOISE)
    return found.groupBy("severity", "msg").agg(F.count("*").alias("n"), F.min("id").alias("first_id"))


@query(
    "curation_candidates",
    f"""
    WITH {_LINES}
    SELECT DISTINCT id AS sample, string_split(raw, ':')[1] AS field FROM m
    WHERE overall = 'error' AND severity <> 'warning'
      AND (raw LIKE '%This field is optional, so%' OR raw LIKE '%Date 1/1/2024%')
    """,
)
def candidates(spark: SparkSession, sf: str) -> DataFrame:
    patterns = ["This field is optional, so", "Date 1/1/2024"]
    return curation_candidates(_event_log(spark, sf), patterns, noise=_NOISE)


# --- groups: nations with their customers; the log has one line per order ---


def _order_log(spark: SparkSession, sf: str) -> DataFrame:
    low = F.col("o_orderpriority") == "5-LOW"
    detail = F.concat(
        F.lit("(ERROR)status:"), "o_orderstatus", F.lit(" not accepted"),
        F.when(low, F.lit(";(ERROR)priority:too low")).otherwise(F.lit(";(WARNING)priority:check")),
    )
    return table(spark, sf, "orders").select(
        F.concat(F.lit("C"), F.col("o_custkey").cast("string")).alias("id"),
        F.lit("organism").alias("type"),
        F.when(F.col("o_orderstatus") == "F", "pass").otherwise("error").alias("overall"),
        detail.alias("detail"),
    )


def _members(spark: SparkSession, sf: str) -> DataFrame:
    """Every customer is in the group of its nation; those in debt also in one shared group, some in none."""
    nation = F.concat(F.lit("G"), F.col("c_nationkey").cast("string"))
    groups = F.array(
        F.when(F.col("c_nationkey") != 3, nation), F.when(F.col("c_acctbal") < 0, F.lit("G99"))
    )
    rows = table(spark, sf, "customer").select(
        F.explode(groups).alias("group_id"), F.concat(F.lit("C"), F.col("c_custkey").cast("string")).alias("id")
    )
    return rows.where(F.col("group_id").isNotNull())


def _headers(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "nation").select(
        F.concat(F.lit("G"), F.col("n_nationkey").cast("string")).alias("group_id"), F.col("n_name").alias("name")
    )


_PER_ROW = 25
_GROUPED = f"""
    msg AS (
      SELECT DISTINCT 'C' || o_custkey AS id, 'error' AS severity, 'status:' || o_orderstatus || ' not accepted' AS msg
      FROM orders WHERE o_orderstatus <> 'F'
      UNION
      SELECT 'C' || o_custkey, 'error', 'priority:too low' FROM orders
      WHERE o_orderstatus <> 'F' AND o_orderpriority = '5-LOW'),
    mem AS (
      SELECT 'G' || c_nationkey AS group_id, 'C' || c_custkey AS id FROM customer WHERE c_nationkey <> 3
      UNION ALL SELECT 'G99', 'C' || c_custkey FROM customer WHERE c_acctbal < 0),
    a AS (SELECT group_id, severity, msg, id FROM mem JOIN msg USING (id)
          UNION ALL
          SELECT NULL, severity, msg, id FROM msg WHERE id NOT IN (SELECT id FROM mem)),
    k AS (SELECT *, count(*) OVER (PARTITION BY group_id, severity, msg) AS n,
                 row_number() OVER (PARTITION BY group_id, severity, msg ORDER BY id) AS place FROM a),
    r AS (SELECT group_id, severity, msg, n, (place - 1) // {_PER_ROW} AS part, string_agg(id, ', ' ORDER BY id) AS ids
          FROM k GROUP BY ALL),
    hd AS (SELECT 'G' || n_nationkey AS group_id, n_name AS name FROM nation)
"""
_PARTS = "string_split(msg, ':')[1] AS field, string_split(msg, ':')[2] AS detail"


@query(
    "group_error_report",
    f"""
    WITH {_GROUPED}
    SELECT group_id, name, severity, msg, {_PARTS}, n, part, ids FROM hd JOIN r USING (group_id)
    """,
)
def group_report(spark: SparkSession, sf: str) -> DataFrame:
    return group_error_report(
        _order_log(spark, sf), _members(spark, sf), _headers(spark, sf), per_row=_PER_ROW
    )


@query(
    "group_error_report_all",
    f"""
    WITH {_GROUPED}
    SELECT coalesce(hd.group_id, r.group_id) AS group_id, name, severity, msg, {_PARTS}, n, part, ids
    FROM hd FULL JOIN r ON hd.group_id = r.group_id
    """,
)
def group_report_all(spark: SparkSession, sf: str) -> DataFrame:
    return group_error_report(
        _order_log(spark, sf),
        _members(spark, sf),
        _headers(spark, sf),
        include_all=True,
        include_ungrouped=True,
        per_row=_PER_ROW,
    )


@query(
    "report_text",
    f"""
    WITH {_GROUPED},
    shown AS (SELECT * FROM hd WHERE group_id IN (SELECT group_id FROM r))
    SELECT group_id, 0 AS section, NULL AS severity, NULL AS msg, NULL AS part,
           'Group id: ' || group_id || chr(10) || 'Group title: ' || name AS value FROM shown
    UNION ALL
    SELECT group_id, 1, severity, msg, part,
           CASE WHEN part = 0 THEN chr(10) || 'List of fields that are in ' || severity || ': ' || string_split(msg, ':')[1]
                || chr(10) || 'Summary of ' || severity || ': ' || string_split(msg, ':')[2]
                || chr(10) || 'Affected sample records: ' || ids ELSE ', ' || ids END
    FROM shown JOIN r USING (group_id)
    UNION ALL
    SELECT group_id, 2, NULL, NULL, NULL, repeat(chr(10), 3) FROM shown
    """,
)
def report_blocks(spark: SparkSession, sf: str) -> DataFrame:
    lines = stored(group_error_lines(_order_log(spark, sf), _members(spark, sf), per_row=_PER_ROW))
    return report_lines(_headers(spark, sf), lines, [("Group id", "group_id"), ("Group title", "name")], "group_id", "sample")


@query(
    "sample_groups",
    """
    SELECT 'C' || c_custkey AS accession, 'GRP' || c_nationkey AS group_id FROM customer
    WHERE c_mktsegment = 'BUILDING'
    """,
)
def sample_groups(spark: SparkSession, sf: str) -> DataFrame:
    own = F.concat(F.lit("C"), F.col("c_custkey").cast("string"))
    group = F.concat(F.lit("GRP"), F.col("c_nationkey").cast("string"))

    def relation(kind: str, source, target):
        return F.struct(F.lit(kind).alias("type"), source.alias("source"), target.alias("target"))

    instance = F.struct(
        F.lower("c_mktsegment").alias("text"),
        F.lit(None).cast("array<string>").alias("ontologyTerms"),
        F.lit(None).cast("string").alias("unit"),
    )
    samples = table(spark, sf, "customer").select(
        own.alias("accession"),
        F.create_map(F.lit("project"), F.array(instance)).cast(f"map<string,array<{CHARACTERISTIC}>>").alias(
            "characteristics"
        ),
        F.array(
            relation("has member", group, own),
            relation("has member", group, own),
            relation("has member", F.lit("X1"), own),
            relation("derived from", group, own),
        ).cast(f"array<{RELATIONSHIP}>").alias("relationships"),
    )
    return group_ids(project_samples(samples, "Building"), pattern=r"^GRP\d+")


# --- datasets: customers with their orders as experiments; the log has one line per line item ---


def _item_log(spark: SparkSession, sf: str) -> DataFrame:
    detail = F.concat(F.lit("(ERROR)flag:"), "l_returnflag", F.lit(" returned;(WARNING)tax:check"))
    items = table(spark, sf, "lineitem").join(
        table(spark, sf, "orders").select("o_orderkey", "o_custkey"), F.col("l_orderkey") == F.col("o_orderkey")
    )
    return items.select(
        F.col("l_orderkey").cast("string").alias("id"),
        F.col("o_custkey").cast("string").alias("dataset"),
        F.when(F.col("l_returnflag") == "R", "error").otherwise("pass").alias("overall"),
        detail.alias("detail"),
    )


def _datasets(spark: SparkSession, sf: str) -> DataFrame:
    """Customers of one segment are not imported, those of another have met the standard."""
    customer = table(spark, sf, "customer").where(F.col("c_mktsegment") != "MACHINERY")
    return customer.select(
        F.col("c_custkey").cast("string").alias("dataset"),
        F.col("c_name").alias("title"),
        F.when(F.col("c_mktsegment") == "BUILDING", "core").alias("standardMet"),
    )


def _dataset_members(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "orders").select(
        F.col("o_custkey").cast("string").alias("dataset"), F.col("o_orderkey").cast("string").alias("id")
    )


_ITEM_LINES = """
    x AS (SELECT DISTINCT CAST(o_custkey AS VARCHAR) AS dataset, l_orderkey, c_mktsegment, c_name
          FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
          WHERE l_returnflag = 'R'),
    k AS (SELECT dataset, c_mktsegment, c_name, CAST(l_orderkey AS VARCHAR) AS id,
                 count(*) OVER (PARTITION BY dataset) AS n,
                 row_number() OVER (PARTITION BY dataset ORDER BY CAST(l_orderkey AS VARCHAR)) AS place FROM x),
    d AS (SELECT dataset, c_mktsegment, c_name, 'error' AS severity, 'flag:R returned' AS msg, 'flag' AS field,
                 'R returned' AS detail, n, (place - 1) // 1000 AS part,
                 string_agg(id, ', ' ORDER BY id) AS ids
          FROM k GROUP BY ALL)
"""


@query(
    "dataset_error_report",
    f"""
    WITH {_ITEM_LINES}
    SELECT dataset, c_name AS title, severity, msg, field, detail, n, part, ids FROM d
    WHERE c_mktsegment NOT IN ('MACHINERY', 'BUILDING')
    """,
)
def dataset_report(spark: SparkSession, sf: str) -> DataFrame:
    headers = unmet(_datasets(spark, sf), "core").select("dataset", "title")
    return dataset_error_report(_item_log(spark, sf), _dataset_members(spark, sf), headers)


@query(
    "not_imported_errors",
    f"""
    WITH {_ITEM_LINES}
    SELECT dataset, severity, msg, field, detail, n, part, ids FROM d WHERE c_mktsegment = 'MACHINERY'
    """,
)
def errors_not_imported(spark: SparkSession, sf: str) -> DataFrame:
    return not_imported_errors(_item_log(spark, sf), _datasets(spark, sf))


@query(
    "not_imported",
    """
    SELECT 'all' AS mode, doc_id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)
    UNION ALL
    SELECT 'unmet', doc_id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels WHERE NOT quality = 1)
    """,
)
def documents_not_imported(spark: SparkSession, sf: str) -> DataFrame:
    documents = table(spark, sf, "documents").select("doc_id")
    labels = table(spark, sf, "labels")
    every = not_imported(documents, labels, "doc_id")
    literal = not_imported(documents, labels, "doc_id", met=F.col("quality") == 1)
    return every.select(F.lit("all").alias("mode"), "doc_id").unionByName(
        literal.select(F.lit("unmet").alias("mode"), "doc_id")
    )
