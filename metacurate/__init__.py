"""Curation and audit of metadata tables on Spark.

Every operator is a plain ``DataFrame -> DataFrame`` or ``Column -> Column``
function. The library never creates a session and never hints a broadcast:
Catalyst's size threshold and AQE choose the join strategy.
"""

__version__ = "0.1.0"
