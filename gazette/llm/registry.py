"""The corpus queries: name -> builder, and DuckDB SQL where SQL can say it."""

from __future__ import annotations

import functools

from .common import prepare

QUERIES: dict = {}
ORACLE: dict = {}


def query(name: str, sql: str | None = None):
    def deco(fn):
        if name in QUERIES:
            raise KeyError(f"duplicate query {name}")

        @functools.wraps(fn)
        def run(spark, sf_dir):
            prepare(spark)
            return fn(spark, sf_dir)
        QUERIES[name] = run
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco
