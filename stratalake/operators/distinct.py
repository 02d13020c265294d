"""Distinct counts: exact ones in two levels, and mergeable sketches that are stored per slot."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from math import sqrt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LG_K = 14  # a sketch has up to 2^14 registers


def distinct_counts(df: DataFrame, keys: Sequence[str], columns: Mapping[str, str]) -> DataFrame:
    """Exact distinct non-NULL values per key; ``columns`` maps a new column to the counted one.

    Each column is first reduced to one row per key and value, combined before the shuffle, so a
    hot key spreads over its values. Several counts in one aggregate would copy every row once for
    each of them instead.
    """
    key = F.struct(*[F.col(k) for k in keys]) if keys else F.lit(True)
    parts = []
    for new, source in columns.items():
        values = df.select(key.alias("_key"), F.col(source).alias("_value")).distinct()
        parts.append(values.groupBy("_key").agg(F.lit(new).alias("_name"), F.count("_value").alias("_n")))
    counted = reduce(DataFrame.unionByName, parts).groupBy("_key")
    rows = counted.agg(*[F.max(F.when(F.col("_name") == new, F.col("_n"))).alias(new) for new in columns])
    return rows.select(*[F.col("_key")[k].alias(k) for k in keys], *columns)


def sketches(df: DataFrame, keys: Sequence[str], columns: Mapping[str, str], lg_k: int = LG_K) -> DataFrame:
    """One sketch per key and counted column, to be stored; sketches of any keys can be united later."""
    return df.groupBy(*keys).agg(*[F.hll_sketch_agg(source, lg_k).alias(new) for new, source in columns.items()])


def united(stored: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """``<column>_estimate`` per key over all stored sketches of the key."""
    return stored.groupBy(*keys).agg(*[F.hll_sketch_estimate(F.hll_union_agg(c)).alias(f"{c}_estimate") for c in columns])


def rolling(stored: DataFrame, keys: Sequence[str], month: str, months: int, columns: Sequence[str]) -> DataFrame:
    """Estimates over the last ``months`` at every stored month.

    A sketch is copied to the months that look back on it; events are not read again.
    """
    ahead = F.explode(F.array(*[F.add_months(month, k) for k in range(months)]))
    spread = stored.withColumn("_at", ahead).drop(month).withColumnRenamed("_at", month)
    shown = stored.select(*keys, month)
    return united(spread.join(shown, [*keys, month], "left_semi"), [*keys, month], columns)


def rolling_counts(df: DataFrame, keys: Sequence[str], month: str, months: int, value: str, new: str) -> DataFrame:
    """Exact distinct non-NULL values per key over the last ``months``, at every month they reach.

    A value's months at a key are gathered first, combined before the shuffle, and each month they
    reach is counted once there. So no copies of rows are shuffled or held to be made distinct, and
    what is left is counted where it is. Rows without a month count nowhere.
    """
    seen = df.groupBy(*keys, value).agg(F.collect_set(month).alias("_months"))
    ahead = F.transform("_months", lambda m: F.array(*[F.add_months(m, k) for k in range(months)]))
    reached = seen.withColumn(month, F.explode(F.array_distinct(F.flatten(ahead))))
    return reached.groupBy(*keys, month).agg(F.count(value).alias(new))


def error(lg_k: int = LG_K) -> float:
    """Stated relative error of a united sketch: four standard errors."""
    return 4 * 1.04 / sqrt(2**lg_k)
