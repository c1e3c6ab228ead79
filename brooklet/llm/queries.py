"""The registry of this subpackage: one query per operator, and SQL where SQL can express it."""

from __future__ import annotations

from brooklet.llm import alignment, bpe, compression_quality, fingerprints, fm_index, hard_negatives, language, mixing, near_dups, quality_rules, suffix_dups, toxicity, urls

_MODULES = (suffix_dups, urls, fingerprints, toxicity, language, near_dups, bpe, mixing, quality_rules, compression_quality, alignment, hard_negatives, fm_index)

QUERIES = {k: f for m in _MODULES for k, f in m.QUERIES.items()}
ORACLES = {k: s for m in _MODULES for k, s in m.ORACLES.items()}
