"""Coverage audit of optional fields and gap audit of mandatory fields."""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from metacurate import presets
from metacurate.operators import coverage as ops
from metacurate.operators.checkpoints import stored

ORGANISM, SPECIMEN = "organism", "specimen"


def document_profile(
    organisms: DataFrame,
    specimens: DataFrame,
    organism_scope: str = ORGANISM,
    specimen_scope: str = SPECIMEN,
    empty_values: Sequence[str] = presets.EMPTY_VALUES,
    rules: DataFrame | None = None,
) -> DataFrame:
    """Field and document counters of search hits ``(_id, doc)``, all that the audits need.

    One pass over the documents, run here: the counters are small and go to the
    checkpoint folder, so that any number of audits reads the documents once.
    With ``rules`` only the fields that these name are looked at, by their paths;
    the rules become part of the plan, so they are a document for people to read.
    Without, all fields are counted, for audits of any rules.
    """
    if rules is not None:
        return stored(_ruled_profile(organisms, specimens, organism_scope, specimen_scope, empty_values, rules))
    fields = ops.document_fields(ops.prepare_documents(organisms, organism_scope), nested=False).unionByName(
        ops.document_fields(ops.prepare_documents(specimens, specimen_scope), nested=True)
    )
    return stored(ops.field_counts(fields, empty_values))


def _ruled_profile(
    organisms: DataFrame, specimens: DataFrame, organism_scope: str, specimen_scope: str, empty_values: Sequence[str], rules: DataFrame
) -> DataFrame:
    # shared fields stand inside the object for coverage and at the top level for gaps
    targets = ops.rule_targets(rules, organism_scope, specimen_scope, shared=()).unionByName(
        ops.rule_targets(rules, organism_scope, specimen_scope)
    )
    paths = targets.where(F.col("field").isNotNull()).select("scope", "container", "field").distinct().orderBy("scope", "container", "field")
    found = [tuple(r) for r in paths.collect()]
    parts = [
        ops.ruled_counts(ops.prepare_documents(docs, scope), [(c, f) for s, c, f in found if s == scope], empty_values)
        for docs, scope in ((organisms, organism_scope), (specimens, specimen_scope))
    ]
    return parts[0].unionByName(parts[1])


PROFILE = "scope string, container string, field string, material string, n bigint, n_meaningful bigint, n_present bigint"


def add_to_profile(path: str, batch: str, organisms: DataFrame, specimens: DataFrame, **options) -> None:
    """Count a batch of new documents, and only those, into the profile kept under ``path``.

    A batch's counters are a folder of their own: counting a batch again, after
    a failure or with corrected documents, replaces what it counted before.
    Options are those of ``document_profile``.
    """
    if not batch or "/" in batch or "=" in batch:
        raise ValueError(f"not a batch name: {batch!r}")
    counters = document_profile(organisms, specimens, **options)
    counters.write.mode("overwrite").parquet(f"{path.rstrip('/')}/batch={batch}")


def merged_profile(spark: SparkSession, path: str) -> DataFrame:
    """The profile of all documents counted so far, as ``document_profile`` of all of them would give.

    Counters add up, so the work depends on field names and batches, not on documents.
    """
    batches = spark.read.schema(f"{PROFILE}, batch string").parquet(path)
    sums = [F.sum(c).alias(c) for c in ("n", "n_meaningful", "n_present")]
    return batches.groupBy("scope", "container", "field", "material").agg(*sums)


class CoverageReport(NamedTuple):
    detail: DataFrame
    averages: DataFrame


def coverage_audit(
    profile: DataFrame, rules: DataFrame, organism_scope: str = ORGANISM, specimen_scope: str = SPECIMEN
) -> CoverageReport:
    """Coverage of every rule that is not mandatory, and its averages."""
    wanted = rules.where(F.col("status") != presets.MANDATORY_STATUS)
    detail = ops.coverage_detail(wanted, profile, organism_scope, specimen_scope)
    return CoverageReport(detail, ops.coverage_averages(detail, organism_scope))


def gap_audit(
    profile: DataFrame, rules: DataFrame, organism_scope: str = ORGANISM, specimen_scope: str = SPECIMEN
) -> DataFrame:
    """Mandatory fields that are missing more often than expected."""
    wanted = rules.where(F.col("status") == presets.MANDATORY_STATUS)
    counted = ops.gap_counts(ops.rule_targets(wanted, organism_scope, specimen_scope), profile)
    expected = F.when(F.col("scope") == organism_scope, F.lit(0)).otherwise(F.col("n_expected"))
    return counted.where((F.col("n_missing") != 0) & (F.col("n_missing") != expected)).select(
        "section", "field", "section_pos", "rule_pos", "n_missing", expected.alias("n_expected")
    )


def missing_documents(
    organisms: DataFrame, rules: DataFrame, organism_scope: str = ORGANISM
) -> DataFrame:
    """Organism documents that lack a mandatory field, ``(section, field, id)``."""
    wanted = rules.where(F.col("status") == presets.MANDATORY_STATUS)
    return ops.missing_fields(ops.prepare_documents(organisms, organism_scope), wanted, ["standard", organism_scope])
