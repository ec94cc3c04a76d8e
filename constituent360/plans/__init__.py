"""Registered queries: each one pairs a Spark job over whole tables with SQL that checks it."""

from __future__ import annotations

import importlib

AREAS = ("tables", "sources", "metrics", "golden", "campaign", "quality", "identity", "models", "temporal", "lineage")


def load_all():
    """Import every area and return (queries, sql)."""
    from constituent360.plans import registry

    for area in AREAS:
        importlib.import_module(f"constituent360.plans.{area}")
    return registry.RUN, registry.SQL
