"""Coverage, gaps, nested fields and URL audits."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bindings.registry import query, settings, table
from metacurate.functions.values import at_path, is_meaningful, is_present, meaningful_text
from metacurate.operators.checkpoints import new_folder
from metacurate.operators.coverage import column_coverage, material_totals
from metacurate.plans.coverage import coverage_audit, document_profile, gap_audit, missing_documents
from metacurate.plans.url_audit import column_values, invalid_urls, url_summary, url_values


@query(
    "type_totals",
    """
    SELECT lang AS material, CAST(count(*) AS BIGINT) AS n, CAST(grouping(lang) AS INTEGER) AS is_total
    FROM documents GROUP BY ROLLUP (lang)
    """,
)
def type_totals(spark: SparkSession, sf: str) -> DataFrame:
    totals = material_totals(table(spark, sf, "documents"), "lang", grand_total=True)
    return totals.withColumn("is_total", F.col("is_total").cast("int"))


@query(
    "field_coverage",
    """
    WITH d AS (SELECT lang, source, CAST(quality AS VARCHAR) AS quality, CAST(toxic AS VARCHAR) AS toxic
               FROM documents LEFT JOIN labels USING (doc_id)),
    f AS (SELECT lang AS section, 'source' AS field, source AS v FROM d
          UNION ALL SELECT lang, 'quality', quality FROM d
          UNION ALL SELECT lang, 'toxic', toxic FROM d)
    SELECT section, field, CAST(count(*) AS BIGINT) AS total,
           CAST(count(*) FILTER (coalesce(v, '') NOT IN ('src7', '0', '')) AS BIGINT) AS n_meaningful,
           CAST(count(v) AS BIGINT) AS n_present,
           round(count(*) FILTER (coalesce(v, '') NOT IN ('src7', '0', '')) / count(*), 6) AS ratio
    FROM f GROUP BY ALL
    """,
)
def field_coverage(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").select("doc_id", "lang", "source")
    labelled = docs.join(table(spark, sf, "labels"), "doc_id", "left")
    counts = column_coverage(labelled, "lang", ["source", "quality", "toxic"], ["src7", "0", ""])
    return counts.withColumn("ratio", F.round(F.col("n_meaningful") / F.col("total"), 6))


# --- documents as polymorphic search hits: customers are organisms, documents are specimens ---

_RULES = [
    # section, field, status
    ("standard", "description", "mandatory"),
    ("standard", "availability", "optional"),
    ("organism", "breed", "recommended"),
    ("organism", "birthDate", "optional"),
    ("organism", "sex", "mandatory"),
    ("specimen from organism", "quality", "recommended"),
    ("specimen from organism", "origin", "optional"),
    ("specimen from organism", "size", "mandatory"),
    ("specimen from organism", "toxic", "mandatory"),
    ("specimen from organism", "derivedFrom", "mandatory"),
    ("cell line", "quality", "optional"),
    ("cell line", "size", "mandatory"),
    ("cell culture", "quality", "mandatory"),
    ("cell specimen", "origin", "optional"),
]


def _rules(spark: SparkSession) -> DataFrame:
    rows = [(s, f, m, i, i) for i, (s, f, m) in enumerate(_RULES)]
    return settings(spark, "section field status section_pos rule_pos", rows)


def _organisms(spark: SparkSession, sf: str) -> DataFrame:
    breed = F.when(F.col("c_mktsegment") == "FURNITURE", "not provided").otherwise(F.col("c_mktsegment"))
    doc = F.struct(
        F.struct(F.lit("organism").alias("text")).alias("material"),
        F.struct(breed.alias("text")).alias("breed"),
        F.when(F.col("c_acctbal") > 0, F.col("c_acctbal").cast("string")).alias("birthDate"),
        F.when(F.col("c_acctbal") > 1000, F.array(F.lit(""), F.lit("male"))).alias("sex"),
        F.when(F.col("c_nationkey") > 3, F.struct(F.col("c_nationkey").alias("ontologyTerms"))).alias("availability"),
        F.when(F.col("c_nationkey") != 7, F.col("c_name")).alias("description"),
    )
    return table(spark, sf, "customer").select(
        F.col("c_custkey").cast("string").alias("_id"), F.to_variant_object(doc).alias("doc")
    )


def _specimens(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").select("doc_id", "lang", "source", "n_chars")
    labelled = docs.join(table(spark, sf, "labels"), "doc_id", "left")
    fields = F.struct(
        F.array(F.struct(F.col("quality").cast("string").alias("text"))).alias("quality"),
        F.when(F.col("source") == "src7", F.array(F.lit("restricted access"), F.col("source")))
        .otherwise(F.array(F.lit(""), F.col("source")))
        .alias("origin"),
        F.col("n_chars").alias("size"),
        F.col("toxic").alias("toxic"),
    )

    def nested(lang: str):
        return F.when(F.col("lang") == lang, fields)

    material = (
        F.when(F.col("lang") == "en", "specimen from organism")
        .when(F.col("lang") == "fr", "cell line")
        .when(F.col("lang") == "de", "cell culture")
        .otherwise("pool of specimens")
    )
    doc = F.struct(
        F.struct(material.alias("text")).alias("material"),
        F.when(F.col("n_chars") > 500, F.array(F.col("source"))).alias("derivedFrom"),
        nested("en").alias("specimenFromOrganism"),
        nested("fr").alias("cellLine"),
        nested("de").alias("cellCulture"),
    )
    return labelled.select(F.col("doc_id").cast("string").alias("_id"), F.to_variant_object(doc).alias("doc"))


def _profile(spark: SparkSession, sf: str) -> DataFrame:
    return document_profile(_organisms(spark, sf), _specimens(spark, sf))


_COVERAGE = """
    s AS (SELECT * FROM documents LEFT JOIN labels USING (doc_id)),
    c AS (
      SELECT 'standard' AS section, 'optional' AS status, 'availability' AS field, count(*) AS total,
             count(*) FILTER (c_nationkey > 3) AS n, count(*) FILTER (c_nationkey > 3) AS p FROM customer
      UNION ALL
      SELECT 'organism', 'recommended', 'breed', count(*), count(*) FILTER (c_mktsegment <> 'FURNITURE'), count(*)
      FROM customer
      UNION ALL
      SELECT 'organism', 'optional', 'birthDate', count(*), count(*) FILTER (c_acctbal > 0),
             count(*) FILTER (c_acctbal > 0) FROM customer
      UNION ALL
      SELECT 'specimen from organism', 'recommended', 'quality', count(*), count(quality), count(*)
      FROM s WHERE lang = 'en'
      UNION ALL
      SELECT 'specimen from organism', 'optional', 'origin', count(*), count(*) FILTER (source <> 'src7'), count(*)
      FROM s WHERE lang = 'en'
      UNION ALL
      SELECT 'cell line', 'optional', 'quality', count(*), count(quality), count(*) FROM s WHERE lang = 'fr'
      UNION ALL
      SELECT 'cell specimen', 'optional', 'origin', 0, 0, 0)
"""


@query(
    "document_coverage",
    f"""
    WITH {_COVERAGE}
    SELECT section, status, field, CAST(total AS BIGINT) AS total, CAST(n AS BIGINT) AS "count",
           round(CASE WHEN total > 0 THEN n / total END, 6) AS ratio, CAST(p AS BIGINT) AS present,
           round(CASE WHEN total > 0 THEN p / total END, 6) AS present_ratio
    FROM c
    """,
)
def document_coverage(spark: SparkSession, sf: str) -> DataFrame:
    report = coverage_audit(_profile(spark, sf), _rules(spark))
    return report.detail.select(
        "section",
        "status",
        "field",
        "total",
        "count",
        F.round("ratio", 6).alias("ratio"),
        "present",
        F.round("present_ratio", 6).alias("present_ratio"),
    )


@query(
    "ruled_coverage",
    f"""
    WITH {_COVERAGE}
    SELECT section, status, field, CAST(total AS BIGINT) AS total, CAST(n AS BIGINT) AS "count", CAST(p AS BIGINT) AS present
    FROM c
    """,
)
def ruled_coverage(spark: SparkSession, sf: str) -> DataFrame:
    """Coverage of documents kept as variants in a table, reading the paths that the rules name."""

    def kept(docs: DataFrame, label: str) -> DataFrame:
        path = new_folder(spark, label)
        docs.write.parquet(path)
        return spark.read.parquet(path)

    rules = _rules(spark)
    organisms, specimens = kept(_organisms(spark, sf), "organisms"), kept(_specimens(spark, sf), "specimens")
    detail = coverage_audit(document_profile(organisms, specimens, rules=rules), rules).detail
    return detail.select("section", "status", "field", "total", "count", "present")


@query(
    "coverage_averages",
    f"""
    WITH {_COVERAGE},
    g AS (SELECT section, status, n / total AS r, p / total AS q FROM c WHERE total > 0
          UNION ALL
          SELECT CASE WHEN section IN ('standard', 'organism') THEN 'animal' ELSE 'specimen' END, status,
                 n / total, p / total FROM c WHERE total > 0
          UNION ALL
          SELECT 'overall', status, n / total, p / total FROM c WHERE total > 0)
    SELECT section, status, round(avg(r), 6) AS excluding, round(avg(q), 6) AS including FROM g GROUP BY ALL
    """,
)
def coverage_means(spark: SparkSession, sf: str) -> DataFrame:
    report = coverage_audit(_profile(spark, sf), _rules(spark))
    return report.averages.select(
        "section",
        "status",
        F.round("excluding", 6).alias("excluding"),
        F.round("including", 6).alias("including"),
    )


@query(
    "mandatory_gaps",
    """
    WITH s AS (SELECT * FROM documents LEFT JOIN labels USING (doc_id)),
    t AS (SELECT count(*) AS n, count(*) FILTER (lang = 'en') AS en, count(*) FILTER (lang = 'fr') AS fr,
                 count(*) FILTER (lang = 'de') AS de FROM documents),
    g AS (
      SELECT 'standard' AS section, 'description' AS field, count(*) FILTER (c_nationkey = 7) AS m, 0 AS e FROM customer
      UNION ALL SELECT 'organism', 'sex', count(*) FILTER (NOT c_acctbal > 1000), 0 FROM customer
      UNION ALL SELECT 'specimen from organism', 'size', n - en, n - en FROM t
      UNION ALL SELECT 'specimen from organism', 'toxic',
                       n - (SELECT count(toxic) FROM s WHERE lang = 'en'), n - en FROM t
      UNION ALL SELECT 'specimen from organism', 'derivedFrom',
                       (SELECT count(*) FROM documents WHERE NOT n_chars > 500), n - en FROM t
      UNION ALL SELECT 'cell line', 'size', n - fr, n - fr FROM t
      -- the quality array holds an object, so it counts as present
      UNION ALL SELECT 'cell culture', 'quality', n - de, n - de FROM t)
    SELECT section, field, CAST(m AS BIGINT) AS n_missing, CAST(e AS BIGINT) AS n_expected
    FROM g WHERE m <> 0 AND m <> e
    """,
)
def mandatory_gaps(spark: SparkSession, sf: str) -> DataFrame:
    gaps = gap_audit(_profile(spark, sf), _rules(spark))
    return gaps.select("section", "field", "n_missing", F.col("n_expected").cast("bigint").alias("n_expected"))


@query(
    "missing_ids",
    """
    SELECT 'standard' AS section, 'description' AS field, CAST(c_custkey AS VARCHAR) AS id
    FROM customer WHERE c_nationkey = 7
    UNION ALL
    SELECT 'organism', 'sex', CAST(c_custkey AS VARCHAR) FROM customer WHERE NOT c_acctbal > 1000
    """,
)
def missing_ids(spark: SparkSession, sf: str) -> DataFrame:
    return missing_documents(_organisms(spark, sf), _rules(spark))


@query(
    "nested_path",
    """
    SELECT event_id, json_extract_string(props, '$.k') AS k, CAST(NULL AS VARCHAR) AS beyond FROM events
    """,
)
def nested_path(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "events").select("event_id", F.try_parse_json("props").alias("doc"))
    return docs.select(
        "event_id",
        at_path(F.col("doc"), "k").alias("k"),
        at_path(F.col("doc"), "k.deeper").alias("beyond"),
    )


@query(
    "meaningful_value",
    """
    WITH e AS (SELECT event_id, event_type, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events),
    v AS (SELECT event_id, CASE event_type
            WHEN 'click' THEN 'T' || k
            WHEN 'view' THEN CASE WHEN k > 50 THEN 'not provided' ELSE 'k' || k END
            WHEN 'error' THEN ''
            WHEN 'signup' THEN 'O_' || k
            ELSE CAST(k AS VARCHAR) END AS value FROM e)
    SELECT event_id, value, CAST(value NOT IN ('not provided', '') AS INTEGER) AS meaningful,
           1 AS present FROM v
    """,
)
def meaningful_value(spark: SparkSession, sf: str) -> DataFrame:
    k = F.get_json_object("props", "$.k")
    text = (
        F.when(F.col("event_type") == "click", F.format_string('{"text": "T%s", "ontologyTerms": "x"}', k))
        .when(
            F.col("event_type") == "view",
            F.format_string(
                '["", {"text": "%s"}, "later"]',
                F.when(k.cast("bigint") > 50, "not provided").otherwise(F.concat(F.lit("k"), k)),
            ),
        )
        .when(F.col("event_type") == "error", F.format_string('{"text": "", "ontologyTerms": ["%s"]}', k))
        .when(F.col("event_type") == "signup", F.format_string('{"ontologyTerms": "O_%s"}', k))
        .otherwise(k)
    )
    values = table(spark, sf, "events").select("event_id", F.parse_json(text).alias("v"))
    value = meaningful_text(F.col("v"))
    return values.select(
        "event_id",
        value.alias("value"),
        is_meaningful(value).cast("int").alias("meaningful"),
        is_present(F.col("v")).cast("int").alias("present"),
    )


_URL = r"^((http|ftp)s?://)?(www\.)?[-a-zA-Z0-9@:%._+~#=]{2,256}\.[a-z]{2,6}\b([-a-zA-Z0-9@:%_+.~#?&/=]*)\n?$"


def _page_values(spark: SparkSession, sf: str) -> DataFrame:
    doc = F.struct(
        F.concat(F.lit("P"), F.col("page_id").cast("string")).alias("accession"),
        F.when(F.col("page_id") == 7, "old").otherwise("core").alias("standardMet"),
        F.struct(
            F.struct(F.col("url").alias("url")).alias("chip protocol"),
            F.col("page_id").alias("number"),
            F.lit("").alias("blank"),
        ).alias("ChiP-seq histone"),
        F.regexp_replace("url", "^http", "HTTP").alias("loud"),
    )
    docs = table(spark, sf, "pages").select(F.to_variant_object(doc).alias("doc"))
    fields = ["ChiP-seq histone.chip protocol.url", "ChiP-seq histone.number", "ChiP-seq histone.blank", "loud",
              "loud", "absent.url"]
    return url_values(docs, "page", "accession", fields, standard="core")


def _document_values(spark: SparkSession, sf: str) -> DataFrame:
    return column_values(table(spark, sf, "documents"), "document", "doc_id", ["source"])


_URL_VALUES = f"""
    v AS (
      SELECT 'page' AS kind, 'P' || page_id AS id, 'ChiP-seq histone.chip protocol.url' AS field, url AS value,
             true AS is_text FROM pages WHERE page_id <> 7
      UNION ALL
      SELECT 'page', 'P' || page_id, 'ChiP-seq histone.number', CAST(page_id AS VARCHAR), false
      FROM pages WHERE page_id NOT IN (0, 7)
      UNION ALL
      SELECT 'page', 'P' || page_id, 'loud', regexp_replace(url, '^http', 'HTTP'), true FROM pages WHERE page_id <> 7
      UNION ALL
      SELECT 'document', CAST(doc_id AS VARCHAR), 'source', source, true FROM documents),
    j AS (SELECT *, regexp_matches(value, '{_URL}') AS ok FROM v WHERE value <> '')
"""


@query(
    "url_audit",
    f"""
    WITH {_URL_VALUES}
    SELECT kind, id, field, value, CASE WHEN NOT is_text THEN 'not_a_string' ELSE 'invalid_url' END AS reason
    FROM j WHERE NOT (is_text AND ok)
    """,
)
def url_audit(spark: SparkSession, sf: str) -> DataFrame:
    return invalid_urls(_page_values(spark, sf).unionByName(_document_values(spark, sf)))


@query(
    "url_summary",
    f"""
    WITH {_URL_VALUES}
    SELECT kind, field, CAST(count(*) AS BIGINT) AS n,
           CAST(count(*) FILTER (NOT (is_text AND ok)) AS BIGINT) AS n_invalid
    FROM j GROUP BY ALL
    """,
)
def url_counts(spark: SparkSession, sf: str) -> DataFrame:
    return url_summary(_page_values(spark, sf).unionByName(_document_values(spark, sf)))
