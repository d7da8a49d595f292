"""Validation logs: messages, curation candidates, error reports by group and by dataset."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from metacurate.functions.messages import (
    message_detail,
    message_field,
    message_severity,
    message_text,
    split_messages,
    strip_date,
)
from metacurate.functions.values import joined_text
from metacurate.operators.checkpoints import stored
from metacurate.operators.groups import DEFAULT_PER_ROW, joined_groups
from metacurate.operators.joins import drop_matching, join_unique, keep_matching
from metacurate.presets import CANDIDATE_PATTERNS, NOISE_MESSAGES

MESSAGE = ["severity", "msg"]
REPORT = [*MESSAGE, "field", "detail", "n", "part", "ids"]


def _wanted_lines(log: DataFrame, include_warnings: bool) -> DataFrame:
    return log if include_warnings else log.where(F.col("overall") == "error")


def log_messages(
    log: DataFrame,
    include_warnings: bool = False,
    noise: Sequence[str] = NOISE_MESSAGES,
    full_message: bool = False,
    strip_dates: bool = True,
) -> DataFrame:
    """Distinct messages per record, ``(id, severity, msg)``, without the ones to ignore.

    A message given twice in one line counts once, with its last severity.
    Severities other than error, and warning if wanted, are not reported.
    """
    messages = F.transform(
        split_messages(F.col("detail")),
        lambda e, i: F.struct(
            message_text(e, full_message).alias("msg"), message_severity(e).alias("severity"), i.alias("i")
        ),
    )
    if not include_warnings:
        messages = F.filter(messages, lambda m: m["severity"] != "warning")
    if noise:
        messages = F.filter(messages, lambda m: ~m["msg"].isin(list(noise)))

    def ranked(m: Column) -> Column:
        text = strip_date(m["msg"]) if strip_dates else m["msg"]
        return F.struct(text.alias("msg"), (-m["i"]).alias("rank"), m["severity"].alias("severity"))

    lines = _wanted_lines(log, include_warnings).select(
        "id", F.array_sort(F.transform(messages, ranked)).alias("m")
    )
    # sorted by message, its last occurrence in front: drop the repeats behind that
    last = F.filter("m", lambda m, i: (i == 0) | (m["msg"] != F.get(F.col("m"), i - 1)["msg"]))
    reported = ["error", "warning"] if include_warnings else ["error"]
    return (
        lines.select("id", F.inline(last))
        .where(F.col("severity").isin(reported))
        .select("id", "severity", "msg")
        .distinct()
    )


def message_parts(messages: DataFrame, full_message: bool = False) -> DataFrame:
    """Add the ``field`` and ``detail`` of each message."""
    return messages.withColumns(
        {"field": message_field(F.col("msg")), "detail": message_detail(F.col("msg"), full_message)}
    )


def curation_candidates(
    log: DataFrame,
    patterns: Sequence[str] = CANDIDATE_PATTERNS,
    include_warnings: bool = False,
    noise: Sequence[str] = NOISE_MESSAGES,
) -> DataFrame:
    """Records whose messages ask for manual curation, distinct ``(sample, field)``.

    The test looks at the message as logged, before dates are stripped. ``patterns`` are plain texts.
    """
    entry = F.explode(split_messages(F.col("detail"))).alias("entry")
    entries = _wanted_lines(log, include_warnings).select("id", entry)
    msg = message_text(F.col("entry"))
    asked = F.lit(False)
    for p in patterns:
        asked = asked | msg.contains(p)
    if not include_warnings:
        asked = asked & (message_severity(F.col("entry")) != "warning")
    if noise:
        asked = asked & ~msg.isin(list(noise))
    return entries.where(asked).select(F.col("id").alias("sample"), message_field(msg).alias("field")).distinct()


def affected(messages: DataFrame, members: DataFrame, group: str) -> DataFrame:
    """``(group, severity, msg, id)`` of group members with messages.

    Members are ``(group, id)``; a record in several groups counts in each. Both
    sides are distinct, so the joined rows are too.
    """
    rows = members.select(group, "id").distinct().join(messages, "id")
    return rows.select(group, *MESSAGE, "id")


def error_lines(
    rows: DataFrame, group: str, per_row: int = DEFAULT_PER_ROW, full_message: bool = False
) -> DataFrame:
    """Affected ids per group and message, sorted and joined, with the full count ``n``.

    Messages with more than ``per_row`` ids take several rows, which in order of ``part`` are the sorted list.
    """
    packed = joined_groups(rows, [group, *MESSAGE], "id", sep=", ", into="ids", per_row=per_row)
    return message_parts(packed, full_message)


def _under_headers(
    headers: DataFrame, lines: DataFrame, on: str, all_headers: bool, all_lines: bool = False
) -> DataFrame:
    """Report lines with the fields of their header.

    Headers without lines and lines without a header are added by anti joins:
    AQE splits a hot group in an inner join, but not in an outer one.
    """
    if all_headers or all_lines:
        lines = stored(lines, "report_lines")
    parts = [join_unique(lines, headers, on)]
    if all_headers:
        parts.append(drop_matching(headers, lines, on))
    if all_lines:
        parts.append(drop_matching(lines, headers, on))
    out = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    return out.select(*headers.columns, *REPORT)


def group_error_lines(
    log: DataFrame,
    members: DataFrame,
    include_ungrouped: bool = False,
    per_row: int = DEFAULT_PER_ROW,
    full_message: bool = False,
    **options,
) -> DataFrame:
    """Messages and affected ids by group; those of records without a group under a NULL group if asked for.

    ``members`` is ``(group_id, id)``.
    """
    messages = log_messages(log, full_message=full_message, **options)
    rows = affected(messages, members, "group_id")
    if include_ungrouped:
        loose = drop_matching(messages, members, "id").select(
            F.lit(None).cast("string").alias("group_id"), *MESSAGE, "id"
        )
        rows = rows.unionByName(loose)
    return error_lines(rows, "group_id", per_row, full_message)


def group_error_report(
    log: DataFrame,
    members: DataFrame,
    headers: DataFrame,
    include_all: bool = False,
    include_ungrouped: bool = False,
    per_row: int = DEFAULT_PER_ROW,
    full_message: bool = False,
    **options,
) -> DataFrame:
    """Error report by group: header fields, message, affected ids.

    ``members`` is ``(group_id, id)``, ``headers`` has ``group_id`` and display
    fields. Groups without errors appear only with ``include_all``; records
    without a group only with ``include_ungrouped``, under a NULL group.
    """
    lines = group_error_lines(log, members, include_ungrouped, per_row, full_message, **options)
    return _under_headers(headers, lines, "group_id", include_all, include_ungrouped)


def dataset_headers(datasets: DataFrame) -> DataFrame:
    """Display fields of dataset documents; list fields may hold texts or ``struct<text>``."""

    def listed(name: str) -> Column:
        is_struct = "struct" in datasets.schema[name].dataType.simpleString()
        return joined_text(F.col(name), "text" if is_struct else None)

    return datasets.select(
        F.col("id").alias("dataset"),
        F.col("secondaryAccession").alias("secondary_accession"),
        "title",
        listed("species").alias("animals"),
        listed("instrument").alias("instruments"),
        listed("centerName").alias("centres"),
    )


def dataset_experiments(datasets: DataFrame) -> DataFrame:
    """Experiments of dataset documents, ``(dataset, id)``."""
    return datasets.select(F.col("id").alias("dataset"), F.explode("experiment").alias("e")).select(
        "dataset", F.col("e.accession").alias("id")
    )


def dataset_error_lines(
    log: DataFrame,
    members: DataFrame,
    headers: DataFrame,
    per_row: int = DEFAULT_PER_ROW,
    full_message: bool = False,
    **options,
) -> DataFrame:
    """Messages and affected ids of the datasets that ``headers`` holds; ``members`` is ``(dataset, id)``."""
    options.setdefault("strip_dates", False)
    options.setdefault("noise", [])
    messages = log_messages(log, full_message=full_message, **options)
    reported = keep_matching(members, headers, "dataset")
    return error_lines(affected(messages, reported, "dataset"), "dataset", per_row, full_message)


def dataset_error_report(
    log: DataFrame,
    members: DataFrame,
    headers: DataFrame,
    include_all: bool = False,
    per_row: int = DEFAULT_PER_ROW,
    full_message: bool = False,
    **options,
) -> DataFrame:
    """Error report by dataset, for datasets that have not met the standard.

    ``members`` is ``(dataset, id)``; ``headers`` holds the datasets to report on.
    """
    lines = dataset_error_lines(log, members, headers, per_row, full_message, **options)
    return _under_headers(headers, lines, "dataset", include_all)


def unmet(datasets: DataFrame, standard: str, column: str = "standardMet") -> DataFrame:
    """Datasets that have not met the standard."""
    return datasets.where(F.col(column).isNull() | (F.col(column) != standard))


def _imported(imported: DataFrame, met: Column | None) -> DataFrame:
    return imported if met is None else imported.where(~F.coalesce(met, F.lit(False)))


def not_imported(logged: DataFrame, imported: DataFrame, on: str, met: Column | None = None) -> DataFrame:
    """Logged keys that are not among the imported ones.

    With ``met``, a condition on ``imported``, the rows that meet it do not count
    as imported, so that their keys are listed too.
    """
    return drop_matching(logged.select(on).distinct(), _imported(imported, met), on)


def not_imported_errors(
    log: DataFrame,
    imported: DataFrame,
    met: Column | None = None,
    per_row: int = DEFAULT_PER_ROW,
    full_message: bool = False,
    **options,
) -> DataFrame:
    """Error lines of the logged datasets that were not imported."""
    options.setdefault("strip_dates", False)
    options.setdefault("noise", [])
    members = drop_matching(log.select("dataset", "id"), _imported(imported, met), "dataset")
    messages = log_messages(log, full_message=full_message, **options)
    return error_lines(affected(messages, members, "dataset"), "dataset", per_row, full_message)
