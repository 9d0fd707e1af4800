"""Registered queries, each with the SQL that checks it where SQL can."""

from importlib import import_module

MODULES = ["rules", "reports", "cleaning", "ingest", "pages", "series", "streams"]


def _merged(name: str) -> dict:
    out = {}
    for module in MODULES:
        found = getattr(import_module(f"contractlens.catalog.{module}"), name)
        clash = out.keys() & found.keys()
        if clash:
            raise ValueError(f"registered twice: {sorted(clash)}")
        out.update(found)
    return out


def all_queries() -> dict:
    return _merged("QUERIES")


def all_oracles() -> dict:
    return _merged("ORACLES")
