"""Registry that ties a query key to its Spark plan and its SQL twin."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Plan = Callable[[SparkSession, str], DataFrame]

PLANS: dict[str, Plan] = {}
TWINS: dict[str, str] = {}


def query(key: str, sql: str | None = None) -> Callable[[Plan], Plan]:
    def add(fn: Plan) -> Plan:
        if key in PLANS:
            raise ValueError(f"query {key} registered twice")
        PLANS[key] = fn
        if sql:
            TWINS[key] = sql.strip()
        return fn

    return add
