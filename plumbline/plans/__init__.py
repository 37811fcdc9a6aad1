"""Registered queries, each with the SQL it is checked against."""

from __future__ import annotations

import importlib

GROUPS = ("statistics", "documents", "changes", "search", "evaluation", "lookups", "answers", "traces", "files")


def _load() -> None:
    for group in GROUPS:
        importlib.import_module(f"plumbline.plans.{group}")


def all_queries():
    from plumbline.plans.base import QUERIES

    _load()
    return dict(QUERIES)


def all_oracles():
    from plumbline.plans.base import ORACLES

    _load()
    return dict(ORACLES)
