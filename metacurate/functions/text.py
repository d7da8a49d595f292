"""Text helpers: case conversion, trimming, sizes, delimited lines, labels."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from metacurate.presets import SIZE_UNITS

# The characters with the Unicode property White_Space.
WHITESPACE = (
    "\t\n\x0b\x0c\r \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

# Trimming a character set looks at the ends only; a regular expression would scan the whole text.


def ltrim_all(c: Column) -> Column:
    """Drop leading whitespace of any kind (``F.ltrim`` drops spaces only)."""
    return F.ltrim(c, F.lit(WHITESPACE))


def rtrim_all(c: Column) -> Column:
    """Drop trailing whitespace of any kind."""
    return F.rtrim(c, F.lit(WHITESPACE))


def trim_all(c: Column) -> Column:
    """Drop whitespace of any kind from both ends."""
    return F.btrim(c, F.lit(WHITESPACE))


def upper_first(c: Column) -> Column:
    """Upper-case the first character and keep the rest as it is."""
    return F.concat(F.upper(F.substring(c, 1, 1)), F.substring(c, 2, 2147483647))


def lower_camel(c: Column) -> Column:
    """``health status`` / ``HEALTH_STATUS`` -> ``healthStatus``.

    A run of blanks is a word break only in front of a word character.
    """
    # (?U): a word character of any script
    words = F.split(F.lower(trim_all(F.translate(c, "_", " "))), r"(?U) +(?=\w)")
    return F.array_join(F.transform(words, lambda w, i: F.when(i == 0, w).otherwise(upper_first(w))), "")


def words_from_camel(c: Column) -> Column:
    """``healthStatus`` -> ``health status``."""
    return F.lower(F.regexp_replace(c, r"(?<!^)(?=[A-Z])", " "))


def readable_size(c: Column) -> Column:
    """Byte count as 1024-based text: plain ``B`` below 1024, else two decimals.

    Works on whole numbers so that ties round to even exactly. Sizes beyond the
    last unit keep that unit and grow in front of it.
    """
    size = c.cast("decimal(20,0)")

    def scaled(power: int) -> Column:
        unit = F.lit(1024**power).cast("decimal(17,0)")
        hundredths = (size * 100).cast("decimal(23,0)")
        rest = (hundredths % unit).cast("decimal(17,0)")
        low = ((hundredths - rest) / unit).cast("decimal(23,0)")
        half = rest * 2
        up = (half > unit) | ((half == unit) & (low % 2 == 1))
        rounded = (low + F.when(up, 1).otherwise(0)).cast("decimal(23,0)")
        return F.concat((rounded / 100).cast("decimal(25,2)").cast("string"), F.lit(SIZE_UNITS[power]))

    out = F.when(size < 1024, F.concat(size.cast("string"), F.lit(SIZE_UNITS[0])))
    last = len(SIZE_UNITS) - 1
    for power in range(1, last):
        out = out.when(size < 1024 ** (power + 1), scaled(power))
    return out.when(size.isNotNull(), scaled(last))


def clean_description(c: Column) -> Column:
    """Strip the ends, delete newlines, turn tabs into spaces, squeeze spaces."""
    return F.regexp_replace(F.translate(trim_all(c), "\t\n", " "), " {2,}", " ")


# One field after its comma: quoted up to a closing quote that ends the field, or plain.
_FIELD = r"""(?s)\G,(\s*".*?"\s*(?=,|\z)|\s*'.*?'\s*(?=,|\z)|(?!\s*["'])[^,]*)"""


def split_delimited(c: Column, on_error: str = "fail") -> Column:
    """Split one comma-delimited line, honouring quoted fields.

    A field that starts with a quote runs to the next such quote followed by a
    comma or the end. Fields are trimmed and lose their double quotes; empty
    fields at the end are dropped. A line with an unclosed quote raises, or
    gives NULL with ``on_error="null"``.
    """
    if on_error not in ("fail", "null"):
        raise ValueError(f"on_error must be 'fail' or 'null', not {on_error!r}")
    line = F.regexp_replace(c, r",+\z", "")
    raw = F.regexp_extract_all(F.concat(F.lit(","), line), F.lit(_FIELD), F.lit(0))
    used = F.length(F.array_join(raw, ""))
    fields = F.transform(
        raw,
        lambda f: F.regexp_replace(trim_all(F.substring(f, 2, 2147483647)), r'^"+|"+\z', ""),
    )
    bad = F.lit(None) if on_error == "null" else F.raise_error(F.concat(F.lit("unclosed quote in: "), c))
    return (
        F.when(c.isNull(), F.lit(None))
        .when(F.length(c) <= 1, F.array(c))
        .when(F.length(line) == 0, F.array().cast("array<string>"))
        .when(used == F.length(line) + 1, fields)
        .otherwise(bad.cast("array<string>"))
    )


def project_label(prefix: str, c: Column) -> Column:
    """Label of the owning project: prefix plus study id."""
    return F.concat(F.lit(prefix), c.cast("string"))


def term_reference(c: Column) -> Column:
    """``EFO_0001_x`` -> ``EFO:0001_x``: only the first underscore is rewritten."""
    return F.regexp_replace(c, r"(?s)\A([^_]*)_", "$1:")


def cross_references(pairs: list[tuple[str, Column]]) -> Column:
    """``DB-id`` entries joined by ``;``; an undefined id gives no entry."""
    # concat is NULL when the id is, and array_join skips NULLs
    return F.array_join(F.array(*[F.concat(F.lit(f"{db}-"), c.cast("string")) for db, c in pairs]), ";")
