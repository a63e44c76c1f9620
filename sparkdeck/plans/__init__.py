"""Query catalogue (Spark) and its DuckDB oracle."""

from . import facts, ml_catalog  # noqa: F401  (register their entries)
from .catalog import REGISTRY


def queries():
    return {k: fn for k, (fn, _) in REGISTRY.items()}


def oracle_sql():
    return {k: s for k, (_, s) in REGISTRY.items() if s}
