"""Where plans are registered: a name, a DataFrame builder and, where SQL can say it, the SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tallyguard.plans.domain import Domain

PLANS: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def plan(name: str, sql: str | None = None):
    """Register ``build(domain) -> DataFrame``."""
    def register(build: Callable[[Domain], DataFrame]):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            spark.conf.set("spark.sql.session.timeZone", "UTC")
            return build(Domain(spark, sf_dir))

        if name in PLANS:
            raise ValueError(f"{name} is registered twice")
        run.__name__, run.__doc__ = name, build.__doc__
        PLANS[name] = run
        if sql:
            SQL[name] = sql
        return build
    return register
