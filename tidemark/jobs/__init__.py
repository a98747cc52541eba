"""The registered queries on the test tables, each next to its SQL oracle."""

from . import aggregates, declared, history, incremental, quality, reshape, scalars, warehouse

_MODULES = (history, warehouse, reshape, aggregates, scalars, quality, incremental, declared)


def queries() -> dict:
    return {name: run for module in _MODULES for name, run in module.QUERIES.items()}


def oracles() -> dict:
    return {name: sql for module in _MODULES for name, sql in module.ORACLES.items()}
