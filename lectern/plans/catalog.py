"""Every query of the library by name, and the SQL that gives the same rows."""

from __future__ import annotations

from importlib import import_module

MODULES = ("terms", "text", "order", "match", "audit", "planted", "files", "office", "varied", "works")
QUERIES: dict = {}
ORACLES: dict[str, str] = {}
COVERS: dict[str, tuple[str, ...]] = {}
for _name in MODULES:
    _listing = import_module(f"lectern.plans.{_name}").L
    QUERIES |= _listing.queries
    ORACLES |= _listing.oracles
    COVERS |= _listing.covers
