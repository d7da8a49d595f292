"""Scalar functions over whole columns."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bindings.registry import query, table
from metacurate.functions import text as t


@query(
    "name_case",
    """
    WITH w AS (SELECT p_partkey, p_name, string_split(p_type || '_' || replace(p_name, ' ', '  '), '_') AS s FROM part),
    u AS (SELECT *, lower(s[1]) AS a, string_split(regexp_replace(s[2], ' +', ' ', 'g'), ' ') AS b FROM w)
    SELECT p_partkey,
           a || array_to_string(list_transform(b, lambda x: upper(substr(x, 1, 1)) || lower(substr(x, 2))), '') AS camel,
           a || ' ' || lower(array_to_string(b, ' ')) AS words,
           upper(substr(p_name, 1, 1)) || substr(p_name, 2) AS title
    FROM u
    """,
)
def name_case(spark: SparkSession, sf: str) -> DataFrame:
    label = F.concat_ws("_", "p_type", F.replace("p_name", F.lit(" "), F.lit("  ")))
    parts = table(spark, sf, "part").select("p_partkey", "p_name", t.lower_camel(label).alias("camel"))
    return parts.select(
        "p_partkey",
        "camel",
        t.words_from_camel(F.col("camel")).alias("words"),
        t.upper_first(F.col("p_name")).alias("title"),
    )


@query(
    "clean_text",
    r"""
    SELECT doc_id,
           md5(regexp_replace(replace(replace(regexp_replace(text, '^\s+|\s+$', '', 'g'), chr(10), ''), chr(9), ' '),
                              ' +', ' ', 'g')) AS cleaned
    FROM documents
    """,
)
def clean_text(spark: SparkSession, sf: str) -> DataFrame:
    cleaned = t.clean_description(F.col("text"))
    return table(spark, sf, "documents").select("doc_id", F.md5(cleaned.cast("binary")).alias("cleaned"))


@query(
    "trim_text",
    r"""
    SELECT page_id,
           md5(regexp_replace(s, '^\s+', '', 'g')) AS l, md5(regexp_replace(s, '\s+$', '', 'g')) AS r,
           md5(regexp_replace(s, '^\s+|\s+$', '', 'g')) AS b
    FROM (SELECT page_id, chr(9) || ' ' || html || chr(10) || ' ' AS s FROM pages)
    """,
)
def trim_text(spark: SparkSession, sf: str) -> DataFrame:
    padded = table(spark, sf, "pages").select(
        "page_id", F.concat(F.lit("\t "), "html", F.lit("\n ")).alias("s")
    )
    s = F.col("s")
    return padded.select(
        "page_id",
        F.md5(t.ltrim_all(s).cast("binary")).alias("l"),
        F.md5(t.rtrim_all(s).cast("binary")).alias("r"),
        F.md5(t.trim_all(s).cast("binary")).alias("b"),
    )


@query(
    "readable_size",
    """
    SELECT doc_id,
           CASE WHEN n_chars < 1024 THEN n_chars || 'B'
                WHEN n_chars < 1048576 THEN printf('%.2fkB', n_chars / 1024.0)
                ELSE printf('%.2fMB', n_chars / 1048576.0) END AS size,
           CASE WHEN n_chars < 1024 THEN printf('%.2fTB', n_chars * 1.0)
                ELSE printf('%.2fPB', n_chars / 1024.0) END AS huge
    FROM documents
    """,
)
def readable_size(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "documents").select(
        "doc_id",
        t.readable_size(F.col("n_chars")).alias("size"),
        t.readable_size(F.col("n_chars") * F.lit(1024**4)).alias("huge"),
    )


@query(
    "split_csv_line",
    """
    SELECT c_custkey,
           c_name || ', ' || c_mktsegment || '|' || c_mktsegment || '||''' || c_nationkey || ', x''' AS fields,
           CAST(4 AS INTEGER) AS n
    FROM customer
    """,
)
def split_csv_line(spark: SparkSession, sf: str) -> DataFrame:
    line = F.concat(
        F.lit('"'), "c_name", F.lit(", "), "c_mktsegment", F.lit('" ,  '), "c_mktsegment",
        F.lit("  ,   , '"), F.col("c_nationkey").cast("string"), F.lit(", x',,"),
    )
    fields = table(spark, sf, "customer").select("c_custkey", t.split_delimited(line).alias("f"))
    return fields.select("c_custkey", F.array_join("f", "|").alias("fields"), F.size("f").alias("n"))


@query(
    "term_rewrite",
    """
    SELECT p_partkey, p_type || ':' || p_size || '_' || replace(p_name, ' ', '_') AS term,
           'LAB-' || p_brand AS project,
           CASE WHEN p_size > 25 THEN 'A-' || p_partkey || ';B-' || p_size ELSE 'A-' || p_partkey END AS xrefs
    FROM part
    """,
)
def term_rewrite(spark: SparkSession, sf: str) -> DataFrame:
    raw = F.concat_ws("_", "p_type", "p_size", F.translate("p_name", " ", "_"))
    return table(spark, sf, "part").select(
        "p_partkey",
        t.term_reference(raw).alias("term"),
        t.project_label("LAB-", F.col("p_brand")).alias("project"),
        t.cross_references([("A", F.col("p_partkey")), ("B", F.when(F.col("p_size") > 25, F.col("p_size")))]).alias(
            "xrefs"
        ),
    )
