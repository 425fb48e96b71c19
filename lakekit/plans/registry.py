"""Register of named queries, each with the SQL an independent engine can check it against."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from lakekit.session import Tables


@dataclass(frozen=True)
class Plan:
    name: str
    build: Callable[[Tables], DataFrame]
    oracle: str | None


PLANS: dict[str, Plan] = {}


def plan(oracle: str | None = None):
    """Register the decorated function under its own name."""

    def register(build: Callable[[Tables], DataFrame]):
        name = build.__name__
        if name in PLANS:
            raise ValueError(f"query {name} is registered twice")
        PLANS[name] = Plan(name, build, oracle)
        return build

    return register


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def runner(build):
        return lambda spark, path: build(Tables(spark, path))

    return {name: runner(p.build) for name, p in PLANS.items()}


def oracle_sql() -> dict[str, str]:
    return {name: p.oracle for name, p in PLANS.items() if p.oracle}
