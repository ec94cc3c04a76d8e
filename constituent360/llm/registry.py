"""Queries of the subpackage and the SQL that checks them."""

from __future__ import annotations

RUN: dict = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(run):
        RUN[name] = run
        if sql is not None:
            SQL[name] = sql
        return run

    return add
