"""All registered queries (importing the modules fills the registry)."""

from . import q_daily, q_feeds, q_html, q_intake, q_keywords, q_report, q_runs, q_scoring, q_store, q_stream  # noqa: F401
from .q_daily import flagship  # noqa: F401
from .registry import ORACLE, QUERIES


def queries() -> dict:
    return dict(QUERIES)


def oracle_sql() -> dict:
    return dict(ORACLE)
