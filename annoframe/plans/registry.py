"""The list of runnable queries and their DuckDB twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from annoframe.plans.tables import Tables
from annoframe.session import prepare

Plan = Callable[[Tables], DataFrame]

PLANS: dict[str, Plan] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None) -> Callable[[Plan], Plan]:
    """Register a plan over the derived tables, with the SQL that must give the same rows."""

    def keep(plan: Plan) -> Plan:
        if name in PLANS:
            raise ValueError(f"query {name} is registered twice")
        PLANS[name] = plan
        if oracle is not None:
            ORACLES[name] = oracle
        return plan

    return keep


def runnable(name: str) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return PLANS[name](Tables(prepare(spark), sf_dir))

    return run
