"""Named queries over the test tables, each with SQL for another engine where SQL can say it."""

from __future__ import annotations

from pagesift.catalog import decontam, dedup, extraction, ingest, quality, text, urls

MODULES = (ingest, urls, extraction, text, quality, dedup, decontam)


def queries() -> dict:
    return {name: run for module in MODULES for name, run in module.QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for module in MODULES for name, sql in module.SQL.items()}
