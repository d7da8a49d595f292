"""All queries of the subpackage."""

from __future__ import annotations

from metacurate.llm import (  # noqa: F401
    codes,
    jaccard,
    licences,
    lm,
    merkle,
    packing,
    pieces,
    pii,
    quality,
    secrets,
    simhash,
    topk,
    warc,
)
from metacurate.llm.registry import QUERIES, SQL  # noqa: F401
