"""The query catalogue. ``load()`` imports every module and returns queries and oracles."""

import importlib

from chatloom.catalog.registry import ORACLES, QUERIES

MODULES = ["contamination", "filters", "repetition", "conversions", "matching", "mixing", "tokens", "statistics", "preferences", "evaluation", "translation", "verifiers", "sources", "streaming", "plans"]


def load():
    for m in MODULES:
        importlib.import_module(f"chatloom.catalog.{m}")
    return QUERIES, ORACLES
