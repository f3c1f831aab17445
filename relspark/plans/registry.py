"""Where plans register: a name, a function of ``(spark, sf_dir)``, and the DuckDB SQL that states the same rows."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Plan = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Plan] = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Plan], Plan]:
    """Register the decorated plan under its own name; without ``sql`` the query has no SQL form."""

    def register(plan: Plan) -> Plan:
        QUERIES[plan.__name__] = plan
        if sql is not None:
            ORACLE_SQL[plan.__name__] = sql
        return plan

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One Parquet table of a scale-factor folder."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stated(spark: SparkSession, sf_dir: str, sql: str, *names: str) -> DataFrame:
    """A SELECT over tables of a scale-factor folder, named after FROM and JOIN; no view is left in the session."""
    text = re.sub(rf"\b(FROM|JOIN) ({'|'.join(names)})\b", r"\1 {\2}", sql)
    return spark.sql(text, **{n: table(spark, sf_dir, n) for n in names})
