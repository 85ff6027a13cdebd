"""DuckDB SQL for the registered queries, used only to check results."""

import importlib

FAMILIES = ["quality", "sqlpack", "analysis", "pages", "advanced"]


def all_sql() -> dict[str, str]:
    merged: dict[str, str] = {}
    for family in FAMILIES:
        try:
            merged |= importlib.import_module(f"oracles.{family}").SQL
        except ModuleNotFoundError as missing:
            if missing.name != f"oracles.{family}":
                raise
    return merged
