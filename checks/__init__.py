"""Registered queries over the driver's tables and their DuckDB counterparts."""

MODULES = ["q_names", "q_catalog", "q_assets", "q_eval", "q_ml", "q_graphs"]


def all_queries():
    import importlib
    from checks.registry import ORACLES, QUERIES
    for m in MODULES:
        importlib.import_module(f"checks.{m}")
    return QUERIES, ORACLES
