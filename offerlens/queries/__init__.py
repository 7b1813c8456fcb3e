"""The registered queries and their SQL equivalents."""

from __future__ import annotations

from offerlens.queries import evaluation, features, ledger, models, profile, records, sampling

_MODULES = (profile, features, sampling, evaluation, models, ledger, records)

QUERIES = {name: run for module in _MODULES for name, run in module.QUERIES.items()}
ORACLES = {name: sql for module in _MODULES for name, sql in module.ORACLES.items()}
