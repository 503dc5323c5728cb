"""Registered queries and DuckDB oracles of the corpus operators."""

from __future__ import annotations

from cardiolake.llm import (
    exact_dedup, fill_middle, fingerprint, importance, language_id, lattice_dedup, licenses, lm_scoring, minhash_dedup, mixing,
    pieces, sharding, toxicity,
)

MODULES = [minhash_dedup, language_id, toxicity, sharding, exact_dedup, licenses, pieces, mixing, fingerprint, lm_scoring,
           lattice_dedup, fill_middle, importance]

QUERIES = {k: q for m in MODULES for k, q in m.QUERIES.items()}
ORACLE = {k: s for m in MODULES for k, s in m.ORACLE.items()}
