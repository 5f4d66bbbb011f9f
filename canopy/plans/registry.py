"""Registered queries: a Spark plan over the given tables and, where SQL can say it, the same in SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from canopy.plans.standins import Roles
from canopy.session import apply_settings

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register ``f(roles) -> DataFrame`` under a name with its SQL check."""
    def register(f: Callable[[Roles], DataFrame]):
        def run(spark: SparkSession, folder: str) -> DataFrame:
            apply_settings(spark)
            return f(Roles(spark, folder))

        run.__doc__ = f.__doc__
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return f

    return register
