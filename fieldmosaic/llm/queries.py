"""Imports every module that registers a query."""

from fieldmosaic.llm import (  # noqa: F401
    conversation_repair,
    decontaminate,
    exact_dedup,
    language,
    line_dedup,
    ngram_join,
    packing,
    pieces,
    quality,
    quotations,
    ranked_search,
    sanitize,
    url_filter,
)
from fieldmosaic.llm.registry import ORACLES, QUERIES  # noqa: F401
