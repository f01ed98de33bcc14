"""Query and check-SQL registration."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Plan = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Plan] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None) -> Callable[[Plan], Plan]:
    """Registers a plan under ``name`` with the SQL that must give the same rows."""

    def add(plan: Plan) -> Plan:
        if name in QUERIES:
            raise ValueError(f"query {name} registered twice")
        QUERIES[name] = plan
        if oracle is not None:
            ORACLES[name] = oracle
        return plan

    return add
