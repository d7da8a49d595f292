"""URL validity."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from metacurate.presets import URL_PATTERN


def is_url(c: Column, pattern: str = URL_PATTERN) -> Column:
    """The text has the accepted URL form; ``$`` admits one final newline and nothing else."""
    return c.rlike("(?d)" + pattern)
