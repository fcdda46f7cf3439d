"""Relational sources and targets over JDBC."""

from __future__ import annotations

import os
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class JdbcConnection:
    """Where a database is; credentials come from the environment, never from code."""

    host: str
    database: str
    port: int = 3306
    product: str = "mysql"
    driver: str = "com.mysql.cj.jdbc.Driver"
    user_variable: str = "CATALOG_DB_USER"
    password_variable: str = "CATALOG_DB_PASSWORD"

    @property
    def url(self) -> str:
        return f"jdbc:{self.product}://{self.host}:{self.port}/{self.database}"

    def options(self) -> dict[str, str]:
        options = {"url": self.url, "driver": self.driver}
        for name, variable in (("user", self.user_variable), ("password", self.password_variable)):
            if value := os.environ.get(variable):
                options[name] = value
        return options


@dataclass(frozen=True)
class Split:
    """Split of a table scan into parallel range queries on a numeric or date column."""

    column: str
    lower: int | str
    upper: int | str
    partitions: int

    def options(self) -> dict[str, str]:
        return {
            "partitionColumn": self.column,
            "lowerBound": str(self.lower),
            "upperBound": str(self.upper),
            "numPartitions": str(self.partitions),
        }


def table_options(
    connection: JdbcConnection, table: str, split: Split | None = None, fetch_size: int = 10_000
) -> dict[str, str]:
    """Reader options for a whole table; filters and columns are pushed into its query."""
    options = {**connection.options(), "dbtable": table, "fetchsize": str(fetch_size)}
    return {**options, **split.options()} if split else options


def query_options(connection: JdbcConnection, query: str, fetch_size: int = 10_000) -> dict[str, str]:
    return {**connection.options(), "query": query.rstrip().rstrip(";"), "fetchsize": str(fetch_size)}


def read_table(
    spark: SparkSession, connection: JdbcConnection, table: str, split: Split | None = None
) -> DataFrame:
    return spark.read.format("jdbc").options(**table_options(connection, table, split)).load()


def read_query(spark: SparkSession, connection: JdbcConnection, query: str) -> DataFrame:
    return spark.read.format("jdbc").options(**query_options(connection, query)).load()
