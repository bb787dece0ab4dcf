"""The registered queries of the point-in-time operators and their DuckDB SQL."""

from __future__ import annotations

from . import bindings_checks, bindings_facts, bindings_market, bindings_package, bindings_pit, bindings_scalars, bindings_sources, bindings_time

QUERIES, ORACLES = {}, {}
for _part in (bindings_time, bindings_market, bindings_facts, bindings_scalars, bindings_checks, bindings_pit, bindings_sources, bindings_package):
    QUERIES |= _part.QUERIES
    ORACLES |= _part.ORACLES
