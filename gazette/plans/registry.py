"""The query registry: name -> (Spark builder, DuckDB oracle SQL or None).

Each registered builder first applies the engine's SQL settings to the
caller's session (UTC session time zone, AQE), since results such as feed
dates are defined in UTC, and ships the package to the Python workers."""

from __future__ import annotations

import functools

from ..session import apply_engine_conf, ship_package

QUERIES: dict = {}
ORACLE: dict = {}


def query(name: str, sql: str | None = None):
    def deco(fn):
        if name in QUERIES:
            raise KeyError(f"duplicate query {name}")

        @functools.wraps(fn)
        def run(spark, sf_dir):
            apply_engine_conf(spark)
            ship_package(spark)
            return fn(spark, sf_dir)
        QUERIES[name] = run
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco
