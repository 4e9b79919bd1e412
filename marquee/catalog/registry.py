"""Registry of queries over the shared tables and the SQL each is checked against."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
    "embeddings", "pages", "benchmark", "labels", "conversations",
]


class Tables:
    """Lazy access to the tables of one folder: ``t.events`` reads ``events.parquet``."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")

    def __getattr__(self, name: str) -> DataFrame:
        if name not in TABLES:
            raise AttributeError(name)
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    def sql(self, text: str) -> DataFrame:
        """Run a projection over ``{table}`` placeholders; used for derived inputs only."""
        used = {n: getattr(self, n) for n in TABLES if "{" + n + "}" in text}
        return self.spark.sql(text, **used)


def plain(text: str) -> str:
    """The same derived input as SQL over the registered views."""
    return text.format(**{n: n for n in TABLES})


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register ``f(tables) -> DataFrame`` under a name, with its check SQL if there is one."""
    def wrap(f: Callable[[Tables], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = lambda spark, folder: f(Tables(spark, folder))
        if sql:
            SQL[name] = sql
        return f
    return wrap
