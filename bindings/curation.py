"""Curation change records over samples made of documents, parts and conversations."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bindings.registry import query, settings, table
from metacurate.operators.curation import (
    copy_from_parent,
    curation_payload,
    remove_field,
    replace_term,
    replace_unit,
    replace_value,
)
from metacurate.sources.schemas import CHARACTERISTIC, RELATIONSHIP

_CHARACTERISTICS = f"map<string,array<{CHARACTERISTIC}>>"


def _instance(text, terms=None, unit=None):
    return F.struct(
        text.cast("string").alias("text"),
        (terms if terms is not None else F.lit(None).cast("array<string>")).alias("ontologyTerms"),
        (unit if unit is not None else F.lit(None).cast("string")).alias("unit"),
    )


def _fields(**fields):
    cells = [x for name, instances in fields.items() for x in (F.lit(name), instances)]
    return F.create_map(*cells).cast(_CHARACTERISTICS)


def _sample_id(column: str, prefix: str = "D"):
    return F.concat(F.lit(prefix), F.col(column).cast("string"))


def _documents(spark: SparkSession, sf: str) -> DataFrame:
    """Language with terms (two instances), size with a unit, source as plain text."""
    lang = F.col("lang")
    return table(spark, sf, "documents").select(
        _sample_id("doc_id").alias("accession"),
        _fields(
            lang=F.array(
                _instance(F.upper(lang), F.array(F.concat(F.lit("old:"), lang))),
                _instance(lang, F.array(F.concat(F.lit("iso:"), lang), F.lit("x"))),
                _instance(F.lit(None)),
            ),
            size=F.array(_instance(F.col("n_chars"), unit=F.lit("chars"))),
            source=F.array(_instance(F.lit("")), _instance(F.concat(F.lit('the "'), "source", F.lit('"')))),
        ).alias("characteristics"),
    )


def _worklist(spark: SparkSession, sf: str) -> DataFrame:
    """Every field of the documents labelled toxic, one of which no document has."""
    names = F.array(*[F.lit(f) for f in ("lang", "size", "source", "absent")])
    return (
        table(spark, sf, "labels")
        .where(F.col("toxic") == 1)
        .select(_sample_id("doc_id").alias("sample"), F.explode(names).alias("field"))
    )


def _payload(before: str, after: str, sample: str = "'D' || doc_id") -> str:
    """SQL text of a payload with the given attribute lists."""
    return (
        f"""'{{"sample":"' || {sample} || '","curation":{{"attributesPre":[' || {before} || '],"attributesPost":['"""
        f""" || {after} || '],"externalReferencesPre":[],"externalReferencesPost":[]}},"domain":"self.lab"}}'"""
    )


_LANG = """'{"type":"lang","value":"' || lang || '","iri":["iso:' || lang || '","x"]}'"""
_SIZE = """'{"type":"size","value":"' || n_chars || '","unit":"chars"}'"""
_SOURCE = """'{"type":"source","value":"the \\"' || source || '\\""}'"""
_TOXIC = "FROM documents JOIN labels USING (doc_id) WHERE toxic = 1"


@query(
    "curate_remove",
    f"""
    SELECT 'D' || doc_id AS sample, 'lang' AS field, {_payload(_LANG, "''")} AS payload {_TOXIC}
    UNION ALL SELECT 'D' || doc_id, 'size', {_payload(_SIZE, "''")} {_TOXIC}
    UNION ALL SELECT 'D' || doc_id, 'source', {_payload(_SOURCE, "''")} {_TOXIC}
    """,
)
def curate_remove(spark: SparkSession, sf: str) -> DataFrame:
    return curation_payload(remove_field(_worklist(spark, sf), _documents(spark, sf)), "self.lab")


@query(
    "curate_replace_value",
    f"""
    SELECT 'D' || doc_id AS sample, 'lang' AS field,
           {_payload(_LANG, '''replace('{"type":"lang","value":"new","iri":["iso:#","x"]}', '#', lang)''')} AS payload {_TOXIC}
    UNION ALL SELECT 'D' || doc_id, 'size',
           {_payload(_SIZE, '''replace('{"type":"size","value":"#","unit":"new"}', '#', CAST(n_chars AS VARCHAR))''')} {_TOXIC}
    UNION ALL SELECT 'D' || doc_id, 'source', {_payload(_SOURCE, """'{"type":"source","value":"new"}'""")} {_TOXIC}
    """,
)
def curate_replace_value(spark: SparkSession, sf: str) -> DataFrame:
    records = replace_value(_worklist(spark, sf), _documents(spark, sf), "new")
    return curation_payload(records, "self.lab")


_TERMS = {"en": "http://lang.example.org/en", "fr": "http://lang.example.org/fr"}


def _lang_worklist(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "documents").select(_sample_id("doc_id").alias("sample"), F.lit("lang").alias("field"))


@query(
    "curate_replace_term",
    f"""
    SELECT 'D' || doc_id AS sample, 'lang' AS field,
           {_payload(_LANG, '''replace('{"type":"lang","value":"#","iri":["http://lang.example.org/#"]}', '#', lang)''')} AS payload
    FROM documents WHERE lang IN ('en', 'fr')
    """,
)
def curate_replace_term(spark: SparkSession, sf: str) -> DataFrame:
    terms = settings(spark, "text iri", list(_TERMS.items()))
    records, _ = replace_term(_lang_worklist(spark, sf), _documents(spark, sf), terms)
    return curation_payload(records, "self.lab")


@query(
    "curate_unmapped",
    "SELECT 'D' || doc_id AS sample, 'lang' AS field, lang AS text FROM documents WHERE lang NOT IN ('en', 'fr')",
)
def curate_unmapped(spark: SparkSession, sf: str) -> DataFrame:
    _, unmapped = replace_term(_lang_worklist(spark, sf), _documents(spark, sf), _TERMS)
    return unmapped


@query(
    "curate_replace_unit",
    f"""
    SELECT 'P' || p_partkey AS sample, 'size' AS field,
           {_payload(
               '''replace('{"type":"size","value":"#","unit":"inch"}', '#', CAST(p_size AS VARCHAR))''',
               '''replace('{"type":"size","value":"#","unit":"cm"}', '#', CAST(p_size AS VARCHAR))''',
               "'P' || p_partkey")} AS payload
    FROM part WHERE p_size > 20
    """,
)
def curate_replace_unit(spark: SparkSession, sf: str) -> DataFrame:
    part = table(spark, sf, "part")
    samples = part.select(
        _sample_id("p_partkey", "P").alias("accession"),
        _fields(size=F.array(_instance(F.col("p_size"), unit=F.lit("inch")))).alias("characteristics"),
    )
    worklist = part.where(F.col("p_size") > 20).select(
        _sample_id("p_partkey", "P").alias("sample"), F.lit("size").alias("field")
    )
    return curation_payload(replace_unit(worklist, samples, "cm"), "self.lab")


def _turns(spark: SparkSession, sf: str) -> DataFrame:
    """A turn derives from the turn before it; only turns of users have a speaker."""
    conv, turn = F.col("conv_id").cast("string"), F.col("turn")
    own = F.concat_ws(":", conv, turn)

    def relation(kind: str, source, target):
        return F.struct(F.lit(kind).alias("type"), source.alias("source"), target.alias("target"))

    links = F.array(
        relation("derived from", own, F.lit("elsewhere")),
        relation("derived from", F.lit("elsewhere"), own),
        relation("derived from", own, F.concat_ws(":", conv, turn - 1)),
        relation("has member", own, F.lit("group")),
    )
    return table(spark, sf, "conversations").select(
        own.alias("accession"),
        F.map_filter(
            _fields(
                text=F.array(_instance(F.lit("x"))),
                speaker=F.when(
                    F.col("role") == "user",
                    F.array(_instance(F.md5(F.col("text").cast("binary")), F.array(F.lit("role:1")))),
                ),
            ),
            lambda _, v: v.isNotNull(),
        ).alias("characteristics"),
        F.when(turn > 0, links).otherwise(F.array()).cast(f"array<{RELATIONSHIP}>").alias("relationships"),
    )


@query(
    "curate_copy_parent",
    f"""
    SELECT c.conv_id || ':' || c.turn AS sample, 'speaker' AS field,
           {_payload("''", '''replace('{"type":"speaker","value":"#","iri":["role:1"]}', '#', md5(p.text))''',
                     "c.conv_id || ':' || c.turn")} AS payload
    FROM conversations c JOIN conversations p ON p.conv_id = c.conv_id AND p.turn = c.turn - 1
    WHERE c.role <> 'user' AND p.role = 'user'
    """,
)
def curate_copy_parent(spark: SparkSession, sf: str) -> DataFrame:
    records, _ = copy_from_parent(_turns(spark, sf), "speaker")
    return curation_payload(records, "self.lab")


@query(
    "curate_unresolved",
    """
    SELECT c.conv_id || ':' || c.turn AS sample, 'speaker' AS field,
           CASE WHEN c.turn > 0 THEN c.conv_id || ':' || (c.turn - 1) END AS parent
    FROM conversations c
    LEFT JOIN conversations p ON p.conv_id = c.conv_id AND p.turn = c.turn - 1 AND p.role = 'user'
    WHERE c.role <> 'user' AND p.conv_id IS NULL
    """,
)
def curate_unresolved(spark: SparkSession, sf: str) -> DataFrame:
    _, unresolved = copy_from_parent(_turns(spark, sf), "speaker")
    return unresolved
