"""The registered queries of this package."""

from __future__ import annotations

import importlib

from plumbline.llm.base import ORACLES, QUERIES

OPERATORS = ("quality_rules", "simhash", "packing", "merkle", "warc", "mixing", "paragraphs", "language", "lm_scoring", "quality_lm", "licenses", "spelling", "lexical")


def _load() -> None:
    for name in OPERATORS:
        importlib.import_module(f"plumbline.llm.{name}")


def all_queries():
    _load()
    return dict(QUERIES)


def all_oracles():
    _load()
    return dict(ORACLES)
