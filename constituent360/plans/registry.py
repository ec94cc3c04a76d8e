"""Collects the queries and, where SQL can state the same result, the SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from constituent360.plans.sql_domain import with_tables

RUN: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None, tables: tuple[str, ...] = ()):
    """Register a function of (spark, sf_dir); ``tables`` names the domain tables its SQL reads."""

    def add(run):
        if name in RUN:
            raise ValueError(f"query registered twice: {name}")
        RUN[name] = run
        if sql is not None:
            SQL[name] = with_tables(tables, sql)
        return run

    return add
