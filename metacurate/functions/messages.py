"""Messages of validation logs: ``(ERROR)field:detail;(WARNING)field:detail``."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from metacurate.presets import DATED_MESSAGE


def split_messages(detail: Column) -> Column:
    """Entries of a detail text; empty ones are dropped."""
    return F.filter(F.split(detail, ";"), lambda e: F.length(e) > 0)


def message_severity(entry: Column) -> Column:
    """Lower-case category of an entry, without its opening parenthesis."""
    return F.lower(F.substring(F.split_part(entry, F.lit(")"), F.lit(1)), 2, 2147483647))


def message_text(entry: Column, full_message: bool = False) -> Column:
    """Text after the category. It ends at the next ``)`` unless ``full_message``."""
    if full_message:
        return F.regexp_replace(entry, r"(?s)\A[^)]*\)?", "")
    return F.split_part(entry, F.lit(")"), F.lit(2))


def strip_date(msg: Column) -> Column:
    """``... Date 12/3/2018 is wrong`` -> ``... Date is wrong``, so that equal complaints group."""
    return F.regexp_replace(msg, DATED_MESSAGE, "$1 $2")


def message_field(msg: Column) -> Column:
    """Field name in front of the first colon."""
    return F.split_part(msg, F.lit(":"), F.lit(1))


def message_detail(msg: Column, full_message: bool = False) -> Column:
    """Complaint after the first colon. It ends at the next colon unless ``full_message``."""
    if full_message:
        return F.regexp_replace(msg, r"(?s)\A[^:]*:?", "")
    return F.split_part(msg, F.lit(":"), F.lit(2))
