"""Large JSON array files, read by many tasks.

A file is cut at every closing brace, which Spark's text source does by byte
ranges. Whether a piece starts inside a string depends on the quotes before it,
and how deep it is nested on the brackets outside strings before it. Both are
running sums over the file: each byte range adds up its own pieces, and the sums
of the ranges in front are added to that. An element ends where the depth is
back to one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from metacurate.operators.checkpoints import stored

_RANGE = ["file", "start"]


def _without_strings(text: Column) -> Column:
    """The text outside strings; a string that is still open at the end is cut off."""
    return F.regexp_replace(text, r'"[^"]*("|$)', "")


def _depth(outside: Column, closed: Column) -> Column:
    """How much deeper it is behind a piece; its closing brace counts outside strings only."""
    return F.regexp_count(outside, F.lit(r"[{\[]")) - F.regexp_count(outside, F.lit(r"\]")) - closed.cast("int")


def _before(pieces: DataFrame, total: Column, name: str) -> DataFrame:
    """Add what the ranges of the file in front of a piece's range add up to, ``total`` being that of one range."""
    ranges = pieces.groupBy(*_RANGE).agg(total.alias("_total"))
    front = Window.partitionBy("file").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    summed = F.max("_total").over(front) if name == "_last" else F.coalesce(F.sum("_total").over(front), F.lit(0))
    return pieces.join(ranges.select(*_RANGE, summed.alias(name)), _RANGE)


def read_array_elements(spark: SparkSession, path) -> DataFrame:
    """The objects of JSON array files as text, ``(file, element)``, of files of any size.

    An element may span byte ranges; an element as a whole is one value. Only
    sums travel until the pieces of an element are put together. A file that is
    not an array is an error; elements other than objects are not looked for.
    """
    source = spark.read.option("lineSep", "}").text(path)
    pieces = stored(
        source.select(
            F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"),
            F.monotonically_increasing_id().alias("line"), "value",
        ),
        "pieces",
    )
    here = Window.partitionBy(*_RANGE).orderBy("line")
    earlier, so_far = here.rowsBetween(Window.unboundedPreceding, -1), here.rowsBetween(Window.unboundedPreceding, 0)

    plain = F.regexp_replace("value", r"(?s)\\.", "")  # an escape is never a quote
    quotes = F.length(plain) - F.length(F.replace(plain, F.lit('"'), F.lit("")))
    open_ = quotes % 2 == 1
    counted = pieces.select(
        *_RANGE, "line", quotes.alias("quotes"), _depth(_without_strings(plain), ~open_).alias("outside"),
        _depth(_without_strings(F.concat(F.lit('"'), plain)), open_).alias("inside"),
    )
    counted = stored(counted.withColumn("seen", F.coalesce(F.sum("quotes").over(earlier), F.lit(0))), "quotes")

    starts_inside = (F.col("_quotes") + F.col("seen")) % 2 == 1
    ends_inside = (F.col("_quotes") + F.col("seen") + F.col("quotes")) % 2 == 1
    nested = _before(counted, F.sum("quotes"), "_quotes").select(
        *_RANGE, "line", ends_inside.alias("string"), F.when(starts_inside, F.col("inside")).otherwise(F.col("outside")).alias("depth")
    )
    nested = stored(nested.withColumn("deep", F.sum("depth").over(so_far)), "depths")

    ends = ~F.col("string") & (F.col("_depth") + F.col("deep") == 1)
    ended = _before(nested, F.sum("depth"), "_depth").select(*_RANGE, "line", ends.alias("ends"))
    place = F.when(F.col("ends"), F.struct("start", "line"))
    ended = stored(ended.withColumn("last", F.max(place).over(earlier)), "ends")
    # an element is known by the end of the one in front
    owned = _before(ended, F.max(place), "_last").select(*_RANGE, "line", "ends", F.coalesce("last", "_last").alias("after"))

    whole = pieces.join(owned, [*_RANGE, "line"]).groupBy("file", "after").agg(
        F.array_sort(F.collect_list(F.struct("start", "line", "value"))).alias("p"), F.max("ends").alias("complete")
    )
    text = F.array_join(F.transform("p", lambda p: p["value"]), "}")
    begins = F.col("after").isNull() & ~text.rlike(r"^\s*\[")
    checked = F.when(begins, F.raise_error(F.concat(F.lit("not an array: "), F.col("file"))).cast("string")).otherwise(text)
    found = whole.select("file", checked.alias("text"), "complete").where(F.col("text").isNotNull() & F.col("complete"))
    return found.select("file", F.concat(F.regexp_replace("text", r"^[\s,\[]+", ""), F.lit("}")).alias("element"))
