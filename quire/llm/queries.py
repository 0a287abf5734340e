"""Queries and SQL of the training-data operators, for the entry module."""

from __future__ import annotations

from quire.llm import conversations, decontaminate, fingerprints, html, jaccard, language, licenses, lm, packing, phrases, quality, secrets, toxicity

_MODULES = (decontaminate, secrets, jaccard, toxicity, quality, language, html, lm, packing, licenses, fingerprints, conversations, phrases)
QUERIES = {name: query for module in _MODULES for name, query in module.QUERIES.items()}
ORACLES = {name: sql for module in _MODULES for name, sql in module.ORACLES.items()}
