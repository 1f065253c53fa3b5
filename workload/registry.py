"""Query registration: a Spark function and, where SQL can say it, the SQL for the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None, also: str | None = None) -> Callable[[Query], Query]:
    """Register a query; ``also`` is an earlier name that stays valid for it."""

    def register(function: Query) -> Query:
        for known in (name, also) if also else (name,):
            QUERIES[known] = function
            if sql is not None:
                ORACLES[known] = sql.strip()
        return function

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """Narrow rows dealt out before heavy work on each: their file may be one row group, which is one task at any number of cores."""
    return df.repartition(*keys)


#: Rows that a task of ``dealt`` gets, more or less.
TASK_ROWS = 250_000


def dealt(df: DataFrame, *keys: str) -> DataFrame:
    """Rows dealt out by key to tasks whose number grows with the rows, so that what one task sorts or holds does not; joins and groups by the keys stay in them."""
    tasks = -(-df.count() // TASK_ROWS)
    return df.repartition(tasks, *keys) if tasks > int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")) else df.repartition(*keys)
