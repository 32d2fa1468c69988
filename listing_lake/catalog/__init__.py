"""Registered queries, each with the SQL it must agree with where SQL can express it."""

from __future__ import annotations

import importlib

_MODULES = ("cleaning", "increments", "maintenance", "spatial", "pages", "scoring", "state", "lake", "ingest")


def _load():
    for module in _MODULES:
        importlib.import_module(f"listing_lake.catalog.{module}")
    return importlib.import_module("listing_lake.catalog.registry")


def queries() -> dict:
    return dict(_load().QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(_load().ORACLES)
