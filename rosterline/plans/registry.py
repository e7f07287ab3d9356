"""Query registry: name -> (Spark callable, oracle SQL or None)."""

from __future__ import annotations

import importlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import fixtures

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

MODULES = ["names", "screening", "master", "snapshots", "history", "ledgers", "monitoring", "addresses", "sources"]


class Inputs:
    """Lazily built input frames of one run."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    def view(self, name: str) -> DataFrame:
        return fixtures.frame(self.spark, self.sf_dir, name)


def query(name: str, oracle: str | None = None, views: str = ""):
    """Register a query.  ``oracle`` is DuckDB SQL over the ``views`` it names (as CTEs) and the raw tables."""

    def register(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(Inputs(spark, sf_dir))

        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        if oracle is not None:
            ORACLES[name] = fixtures.oracle(views.split(), oracle)
        return fn

    return register


def load() -> None:
    for module in MODULES:
        importlib.import_module(f"{__package__}.{module}")
