"""Registered queries, one module per operator family."""

from importlib import import_module

FAMILIES = (
    "scans", "writes", "relational", "joins", "aggregates", "windows", "scalars",
    "changes", "streams", "governed", "shop", "usage", "bill",
)


def load() -> dict:
    """Import every family and return the filled registry."""
    for family in FAMILIES:
        import_module(f"millrace.catalog.{family}")
    from millrace.catalog.registry import REGISTRY

    return REGISTRY
