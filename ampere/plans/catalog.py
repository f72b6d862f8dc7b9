"""All registered queries (importing the catalog modules registers them)."""

from __future__ import annotations

from ampere.plans.registry import QUERIES, Query

_MODULES = [
    "ampere.plans.catalog_gold",
    "ampere.plans.catalog_ml",
    "ampere.plans.catalog_clean",
    "ampere.plans.catalog_features",
    "ampere.plans.catalog_sources",
    "ampere.plans.catalog_landing",
    "ampere.plans.catalog_stream",
]


def all_queries() -> dict[str, Query]:
    import importlib
    for m in _MODULES:
        importlib.import_module(m)
    return dict(QUERIES)
