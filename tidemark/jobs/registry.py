"""Table access and registration shared by the job modules."""

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


class Tables:
    """The test tables of one scale factor: ``t.orders``, ``t.events``, ..."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self._dir = str(sf_dir).rstrip("/")

    def path(self, name: str) -> str:
        return f"{self._dir}/{name}.parquet"

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        return self.spark.read.parquet(self.path(name))


def registrar(queries: dict, oracles: dict) -> Callable:
    """``@job(sql)`` registers a ``Tables -> DataFrame`` function under its own name.

    ``name`` replaces that name where an imported operator already has it.
    """

    def job(sql: str | None, name: str | None = None) -> Callable:
        def register(fn: Callable[[Tables], DataFrame]) -> Callable:
            key = name or fn.__name__
            queries[key] = lambda spark, sf_dir: fn(Tables(spark, sf_dir))
            if sql is not None:
                oracles[key] = sql
            return fn

        return register

    return job


def rows_counted(name: str = "num_rows") -> Column:
    return F.count(F.lit(1)).alias(name)


def exact_sum(column: str, name: str) -> Column:
    """A sum of two-digit amounts that does not depend on the order of addition."""
    return F.sum(F.col(column).cast("decimal(18,2)")).cast("double").alias(name)
