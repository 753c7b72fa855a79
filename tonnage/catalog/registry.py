"""Registered queries, each with the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

QueryFunction = Callable[["Tables"], DataFrame]

FUNCTIONS: dict[str, QueryFunction] = {}
SQL: dict[str, str] = {}


@dataclass(frozen=True)
class Tables:
    """The tables of one folder; a file's schema is read once, when it is first asked for."""

    spark: SparkSession
    folder: str
    opened: dict[str, DataFrame] = field(default_factory=dict)

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        if name not in self.opened:
            self.opened[name] = self.spark.read.parquet(f"{self.folder}/{name}.parquet")
        return self.opened[name]


def query(sql: str, name: str | None = None) -> Callable[[QueryFunction], QueryFunction]:
    """Register a function under a name, by default its own."""

    def register(function: QueryFunction) -> QueryFunction:
        key = name or function.__name__
        if key in FUNCTIONS:
            raise ValueError(f"{key} is registered twice")
        FUNCTIONS[key] = function
        SQL[key] = sql
        return function

    return register
