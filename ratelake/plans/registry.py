"""Registered queries: a callable ``(spark, folder) -> DataFrame`` and, where SQL can say it, its SQL."""

from ratelake.plans.sql import with_ctes

QUERIES: dict = {}
ORACLES: dict = {}


def query(name: str, sql: str | None = None, *ctes: str):
    """Register a function under ``name``; ``sql`` runs behind the common table expressions ``ctes``."""
    def add(function):
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = function
        if sql is not None:
            ORACLES[name] = with_ctes(sql, *ctes)
        return function

    return add
