"""Operators for large-scale training-data pipelines, and their queries."""

from panelcast.llm import (byte_bpe, chat_format, exact_dedup, license_scan, line_dedup, merkle, mixing,  # noqa: F401
                           ngram_join, quality_rules, simhash, spelling, substring_dedup,
                           toxicity)
from panelcast.llm.registry import ORACLES, QUERIES  # noqa: F401
