"""Register of jobs: name, Spark form, SQL text for the independent check."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from millrace.plans.roles import Roles, with_roles
from millrace.session import configure


@dataclass(frozen=True)
class Job:
    name: str
    build: Callable[[Roles], DataFrame]
    sql: str | None

    def run(self, spark: SparkSession, folder: str) -> DataFrame:
        return self.build(Roles(configure(spark), folder))


JOBS: dict[str, Job] = {}


def job(sql: str | None = None, name: str | None = None):
    """Register a function of the role tables under its own or the given name."""

    def add(build: Callable[[Roles], DataFrame]) -> Callable[[Roles], DataFrame]:
        key = name or build.__name__
        if key in JOBS:
            raise ValueError(f"job {key} registered twice")
        JOBS[key] = Job(key, build, with_roles(sql) if sql else None)
        return build

    return add
