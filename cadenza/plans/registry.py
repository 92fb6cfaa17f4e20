"""Registered queries: operator + parameters + an independent oracle.

Every entry runs one operator over the whole mapped catalog of a test-data
directory. Its oracle is the reference-shaped SQL (join first, aggregate
after) that DuckDB runs over the same mapping, which makes the check
independent of the pre-aggregated plans the operators build.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from ..catalog import Catalog
from ..schemas import TABLES
from ..sources.testdata import from_testdata, with_clause

AVG_SQL = (
    "CAST(CAST((200*SUM({x}) + COUNT({x})) // NULLIF(2*COUNT({x}), 0) AS DECIMAL(18,0))"
    " * CAST(0.01 AS DECIMAL(3,2)) AS DECIMAL(10,2))"
)
"""Exact half-up average of integers at scale 2, in DuckDB integer arithmetic."""


def avg_sql(x: str) -> str:
    return AVG_SQL.format(x=x)


@dataclass(frozen=True)
class RegisteredQuery:
    name: str
    build: Callable[[Catalog], DataFrame]
    oracle: str | None  # body after the WITH list; None = not SQL-expressible

    def run(self, spark: SparkSession, sf_dir: str) -> DataFrame:
        return self.build(from_testdata(spark, sf_dir))

    def oracle_sql(self) -> str | None:
        if self.oracle is None:
            return None
        body = self.oracle.strip()
        used = [t for t in TABLES if re.search(rf"\b{t}\b", body)]
        if body[:15].upper() == "WITH RECURSIVE ":
            return with_clause(used).replace("WITH", "WITH RECURSIVE", 1) + ",\n" + body[15:]
        if body[:5].upper() == "WITH ":
            return with_clause(used) + ",\n" + body[5:]
        return with_clause(used) + "\n" + body


_REGISTRY: dict[str, RegisteredQuery] = {}


def register(name: str, oracle: str | None):
    def deco(fn: Callable[[Catalog], DataFrame]) -> Callable[[Catalog], DataFrame]:
        if name in _REGISTRY:
            raise ValueError(f"duplicate query {name}")
        _REGISTRY[name] = RegisteredQuery(name, fn, oracle)
        return fn

    return deco


def registry() -> dict[str, RegisteredQuery]:
    # Importing the modules fills the registry.
    from . import catalog_queries, stored_queries  # noqa: F401

    return dict(_REGISTRY)
