"""Imports every operator module, so that its query is registered."""

from __future__ import annotations

from ampere.llm import (  # noqa: F401
    ann_collisions,
    bpe,
    fingerprints,
    html_extract,
    jaccard_join,
    language_id,
    packing,
    quality_classifier,
    quality_rules,
    source_divergence,
    token_counts,
    token_files,
    vector_codes,
)
from ampere.llm.registry import ORACLES, QUERIES  # noqa: F401
