"""Manifest, coverage, payload, candidate, report, rule-set and vocabulary writers.

No writer merges the output into one file. ``ordered`` sorts by range, which
stays distributed: part files in name order are the sorted report.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from metacurate.functions.text import words_from_camel
from metacurate.operators.checkpoints import stored
from metacurate.operators.conditions import NAME_KEY
from metacurate.operators.joins import keep_matching
from metacurate.presets import COVERAGE_STATUSES, SECTIONS


def ordered(df: DataFrame, *columns: str) -> DataFrame:
    """Ascending, over all partitions."""
    return df.orderBy(*columns)


def _position(column: str, values: Sequence[str]) -> Column:
    """Place in the list; values that are not in it come behind."""
    place = F.array_position(F.array(*[F.lit(v) for v in values]), F.col(column))
    return F.when(place > 0, place).otherwise(len(values) + 1)


def write_manifest(manifest: DataFrame, path: str, delimiter: str = ",", mode: str = "errorifexists") -> None:
    """Delimited manifest with a header; missing cells are empty, values are quoted where needed."""
    cells = [F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")).alias(c) for c in manifest.columns]
    # a quote inside a cell is doubled
    options = {"header": True, "sep": delimiter, "emptyValue": "", "escape": '"'}
    manifest.select(*cells).write.mode(mode).options(**options).csv(path)


def write_coverage(
    detail: DataFrame,
    averages: DataFrame,
    path: str,
    sections: Sequence[str] = SECTIONS,
    statuses: Sequence[str] = COVERAGE_STATUSES,
    mode: str = "errorifexists",
) -> None:
    """Coverage report: ``detail`` and ``averages`` as tab-separated files, ratios NA where undefined.

    Rows come in order of ``sections``, ``statuses`` and the rules; sections and
    statuses that these lists do not name follow behind by name.
    """
    na = F.lit("NA")
    options = {"header": True, "sep": "\t"}
    rows = detail.withColumns({"_s": _position("section", sections), "_t": _position("status", statuses)})
    rows = ordered(rows, "_s", "section", "_t", "status", "section_pos", "rule_pos")
    rows.select(
        F.col("section").alias("Section"),
        F.col("status").alias("Status"),
        words_from_camel(F.col("field")).alias("Field"),
        F.col("total").alias("Total Entries"),
        F.col("count").alias("Count"),
        F.coalesce(F.col("ratio").cast("string"), na).alias("Percentage"),
        F.col("present").alias("Count including not provided"),
        F.coalesce(F.col("present_ratio").cast("string"), na).alias("Percentage including"),
    ).write.mode(mode).options(**options).csv(f"{path}/detail")
    order = ["overall", "animal", "specimen", *sections]
    means = averages.withColumns({"_s": _position("section", order), "_t": _position("status", statuses)})
    ordered(means, "_s", "section", "_t", "status").select(
        F.col("section").alias("Section"),
        F.col("status").alias("Status"),
        F.col("excluding").alias("Excluding"),
        F.col("including").alias("Including"),
    ).write.mode(mode).options(**options).csv(f"{path}/averages")


def write_payloads(payloads: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Curation payloads, one JSON document per line."""
    payloads.select("payload").write.mode(mode).text(path)


def write_candidates(candidates: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Manual-curation candidates, ``sample<TAB>field``."""
    candidates.select(F.concat_ws("\t", "sample", "field").alias("value")).write.mode(mode).text(path)


def write_attributes(attributes: DataFrame, path: str, key: str = "entity_id", mode: str = "errorifexists") -> None:
    """Attribute rows ``(key, name, …)`` as a Parquet table for conditions on attribute names.

    The name is added in lower case; rows are sorted by it over all files, which
    a hot name shares out by ``key``, and each row group has a bloom filter of
    it, so a condition reads the row groups that can hold its names.
    """
    folded = attributes.withColumn(NAME_KEY, F.lower("name"))
    placed = folded.repartitionByRange(NAME_KEY, key).sortWithinPartitions(NAME_KEY, key)
    placed.write.mode(mode).option(f"parquet.bloom.filter.enabled#{NAME_KEY}", "true").parquet(path)


def report_lines(
    headers: DataFrame,
    lines: DataFrame,
    titles: Sequence[tuple[str, str]],
    group: str,
    records: str,
    include_all: bool = False,
) -> DataFrame:
    """A report as text, ``(group, section, severity, msg, part, value)``, which sorted by these columns is the page.

    Each group has its header once (``titles`` are title and column; a NULL
    column has no line), then its messages, each behind an empty line, then four
    empty lines. ``lines`` is ``(group, severity, msg, field, detail, part,
    ids)``: a message starts with part 0, and the further parts of its ids
    continue the list, each on a line of its own that starts with the comma.

    Groups of either side that the other does not have are left out, except for
    headers if ``include_all`` and for lines of no group at all, which come
    first and have no header.
    """
    place = [group, "section", "severity", "msg", "part"]
    header = F.concat_ws("\n", *[F.concat(F.lit(f"{title}: "), F.col(f"`{c}`").cast("string")) for title, c in titles])
    begun = F.format_string(
        f"\nList of fields that are in %s: %s\nSummary of %s: %s\nAffected {records} records: %s",
        *[F.coalesce(c, F.lit("")) for c in ("severity", "field", "severity", "detail", "ids")],
    )
    text = F.when(F.col("part") == 0, begun).otherwise(F.concat(F.lit(", "), "ids"))
    shown = headers if include_all else keep_matching(headers, lines, group)
    known = keep_matching(lines, headers, group).unionByName(lines.where(F.col(group).isNull()))

    def frame(section: int, value: Column) -> DataFrame:
        none = F.lit(None).cast("string")
        return shown.select(
            group, F.lit(section).alias("section"), none.alias("severity"), none.alias("msg"),
            F.lit(None).cast("bigint").alias("part"), value.alias("value"),
        )

    body = known.select(group, F.lit(1).alias("section"), "severity", "msg", "part", text.alias("value"))
    return frame(0, header).unionByName(body).unionByName(frame(2, F.lit("\n\n\n"))).select(*place, "value")


def write_report(
    headers: DataFrame,
    lines: DataFrame,
    titles: Sequence[tuple[str, str]],
    group: str,
    records: str,
    path: str,
    include_all: bool = False,
    mode: str = "errorifexists",
) -> None:
    """The report of ``report_lines`` as text files, in order of group, message and id. The lines are computed once."""
    page = report_lines(headers, stored(lines, "report_lines"), titles, group, records, include_all)
    ordered(page, group, "section", "severity", "msg", "part").select("value").write.mode(mode).text(path)


def write_rule_entries(entries: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Grouped rule entries as JSON lines; absent descriptions and value lists are left out."""
    entries.write.mode(mode).json(path)


def write_mandatory_fields(fields: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Mandatory schema fields as tab-separated lines with a header; allowed values joined by ``|``."""
    fields.select(
        F.col("file").alias("xsd file"),
        F.col("kind").alias("type"),
        "name",
        "path",
        F.coalesce("desc", F.lit("")).alias("description"),
        F.coalesce(F.array_join("allowed_values", "|"), F.lit("")).alias("allowed values"),
    ).write.mode(mode).option("header", True).option("sep", "\t").option("emptyValue", "").csv(path)


def ruleset_fields(fields: DataFrame) -> DataFrame:
    """Vocabulary fields ``(column, sheet, allowed, mandatory)`` as rule-set entries."""
    return fields.select(
        F.col("column").alias("name"),
        F.col("sheet").alias("expected_sheet"),
        F.lit("text").alias("type"),
        F.col("allowed").alias("valid_values"),
        "mandatory",
    )


def vocabulary_text(fields: DataFrame, with_file: bool = False) -> DataFrame:
    """Vocabulary rows as ``column, sheet, [file,] element``, a blank cell and the values."""
    head = ["column", "sheet", *(["file"] if with_file else []), "element"]
    cells = [F.coalesce(F.col(c), F.lit("")) for c in head]
    return fields.select(
        F.concat_ws("\t", *cells, F.lit(""), F.array_join("allowed", "\t")).alias("value")
    )


def write_vocabulary(fields: DataFrame, path: str, with_file: bool = False, mode: str = "errorifexists") -> None:
    """Vocabulary as tab-separated lines."""
    vocabulary_text(fields, with_file).write.mode(mode).text(path)
