"""Named queries with their SQL counterpart."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from tidemart.plans.oracle import check_sql

Query = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Entry:
    run: Query
    sql: str | None


ENTRIES: dict[str, Entry] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query; ``sql`` may name the relations of ``oracle.py``."""

    def register(run: Query) -> Query:
        if name in ENTRIES:
            raise ValueError(f"query {name} is registered twice")
        ENTRIES[name] = Entry(run, check_sql(sql) if sql else None)
        return run

    return register


def load_entries() -> dict[str, Entry]:
    """Import the query modules and return everything they registered."""
    from tidemart.plans import (  # noqa: F401
        queries_columns,
        queries_flows,
        queries_models,
        queries_operations,
    )

    return ENTRIES
