"""The registered queries."""

import importlib

from tablework.workload.registry import all_queries, all_sql

for _module in ("relational", "joins", "aggregates", "files", "streams", "loads", "recommendation", "models"):
    importlib.import_module(f"tablework.workload.{_module}")

__all__ = ["all_queries", "all_sql"]
