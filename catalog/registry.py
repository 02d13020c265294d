"""Query registry: a DataFrame builder and, where SQL can express it, the same result in SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catalog.binding import with_bindings
from stratalake.session import configure

Builder = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Builder] = {}
ORACLES: dict[str, str] = {}


def present(df: DataFrame) -> DataFrame:
    """Result types both engines share: double for decimals, timestamps without a zone."""
    columns = []
    for name, kind in df.dtypes:
        if kind.startswith("decimal"):
            columns.append(F.col(name).cast("double").alias(name))
        elif kind == "timestamp":
            columns.append(F.col(name).cast("timestamp_ntz").alias(name))
        else:
            columns.append(F.col(name))
    return df.select(columns)


def query(name: str, sql: str | None = None) -> Callable[[Builder], Builder]:
    """Register ``name``; SQL may use the bindings by name."""

    def register(build: Builder) -> Builder:
        def run(spark: SparkSession, folder: str) -> DataFrame:
            return present(build(configure(spark), folder))

        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = with_bindings(sql)
        return build

    return register
