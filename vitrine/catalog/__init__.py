"""The registered queries and, where SQL can say the same, their oracle."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vitrine.catalog import loading, marts, parsing, quality, reports, sql_users, store, streams

Query = Callable[[SparkSession, str], DataFrame]
_MODULES = [marts, parsing, loading, reports, store, quality, sql_users, streams]


def _registered(query: Query) -> Query:
    """Decimal results as DOUBLE, the type the oracle gives them."""

    @wraps(query)
    def run(spark: SparkSession, folder: str) -> DataFrame:
        result = query(spark, folder)
        decimals = {
            f.name: F.col(f.name).cast("double") for f in result.schema if isinstance(f.dataType, T.DecimalType)
        }
        return result.withColumns(decimals) if decimals else result

    return run


def queries() -> dict[str, Query]:
    return {name: _registered(query) for module in _MODULES for name, query in module.QUERIES.items()}


def oracles() -> dict[str, str]:
    return {name: sql for module in _MODULES for name, sql in module.ORACLES.items()}
