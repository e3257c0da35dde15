"""The list of registered queries."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

Run = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Query:
    run: Run
    sql: str | None


QUERIES: dict[str, Query] = {}


def query(sql: str | None = None) -> Callable[[Run], Run]:
    """Register a function under its own name; ``sql`` is the same question for a SQL engine."""

    def register(run: Run) -> Run:
        if run.__name__ in QUERIES:
            raise ValueError(f"{run.__name__} is registered twice")
        QUERIES[run.__name__] = Query(run, sql)
        return run

    return register


def load_all() -> dict[str, Query]:
    from marlstone.plans import (  # noqa: F401
        evaluation_queries,
        feature_queries,
        history_queries,
        model_queries,
        profile_queries,
        split_queries,
        stream_queries,
        text_queries,
    )

    return QUERIES
