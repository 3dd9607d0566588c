"""The registered corpus queries and their SQL."""

from __future__ import annotations

import corpus_pipeline
from tallyframe.llm import bpe, decontaminate, exact_dedup, fill_middle, language, license_scan, near_dedup, pii, preference, resample, secrets, suffix_dedup, token_groups

MODULES = (license_scan, exact_dedup, pii, decontaminate, suffix_dedup, preference, secrets, near_dedup, bpe, language, resample, fill_middle, token_groups, corpus_pipeline)
QUERIES = {name: function for module in MODULES for name, function in module.QUERIES.items()}
ORACLES = {name: sql for module in MODULES for name, sql in module.ORACLES.items()}
