"""Operators for preparing training text: quality rules, deduplication,
decontamination, secret scans, scoring, language, URL lists, shards, packing.

Nothing outside this package imports it; `snapkeep.llm.queries` registers its
queries, and `corpus_pipeline.py` at the repository top chains five of them.
"""
