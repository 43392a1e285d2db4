"""Operators of a training-data pipeline, and their registered queries."""

from bidscope.llm import chat, decontaminate, language_model, mixing, near_dedup, quality, repeats, sharding, simhash, spelling, url_filter, warc, whitening  # noqa: F401
from bidscope.llm.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
