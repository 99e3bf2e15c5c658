"""Registered queries over the derived test tables, each with its check in SQL."""

from importlib import import_module
from importlib.util import find_spec

MODULES = ("costs", "classify", "jobs", "reports", "budget", "rates", "feeds", "workflow", "parts", "io", "storage")


def load_all():
    from haulmark.catalog import base

    for name in MODULES:
        if find_spec(f"haulmark.catalog.{name}"):
            import_module(f"haulmark.catalog.{name}")
    return base.QUERIES, base.CHECKS
