"""Registry of this package's queries and their DuckDB oracles."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from nextbest.llm import (
    chat_query,
    decontam_query,
    entropy_mix_query,
    fingerprint_query,
    model_queries,
    simhash_query,
    spelling_query,
    token_query,
    weak_rules_query,
    whitening_query,
)

_MODULES = (model_queries, simhash_query, entropy_mix_query, token_query, weak_rules_query,
            decontam_query, chat_query, spelling_query, fingerprint_query, whitening_query)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: fn for m in _MODULES for name, fn in m.QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for m in _MODULES for name, sql in m.ORACLES.items()}
