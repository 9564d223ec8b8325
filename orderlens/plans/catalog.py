"""All registered queries and their DuckDB oracles, merged from the catalog modules."""

from __future__ import annotations

from orderlens.plans import (catalog_features, catalog_ml, catalog_profile, catalog_rollup,
                             catalog_select, catalog_stream, catalog_workflow)

_MODULES = [catalog_rollup, catalog_profile, catalog_select, catalog_features, catalog_ml,
            catalog_stream, catalog_workflow]


def all_queries() -> dict:
    out = {}
    for m in _MODULES:
        out.update(m.QUERIES)
    return out


def all_oracles() -> dict:
    out = {}
    for m in _MODULES:
        out.update(m.ORACLE)
    return out
