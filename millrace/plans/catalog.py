"""Collects the registered queries of every area."""

from __future__ import annotations

import importlib

from .registry import ORACLES, QUERIES

AREAS = (
    "queries_prepare",
    "queries_explore",
    "queries_sample",
    "queries_model",
)


def _load() -> None:
    for area in AREAS:
        importlib.import_module(f"{__package__}.{area}")


def queries() -> dict:
    _load()
    return dict(QUERIES)


def oracle_sql() -> dict:
    _load()
    return dict(ORACLES)
