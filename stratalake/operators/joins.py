"""Joins of the dimensional layer.

Dimension sides carry no broadcast hint unless their size was checked: Catalyst and
AQE broadcast a side that is really small and split a hot key otherwise.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratalake.session import pin


def broadcast_checked(df: DataFrame, max_rows: int = 100_000) -> DataFrame:
    """Hint a broadcast only after seeing that ``df`` has at most ``max_rows`` rows."""
    seen = df.limit(max_rows + 1).count()
    return F.broadcast(df) if seen <= max_rows else df


def denormalize(
    base: DataFrame, lookups: Sequence[tuple[DataFrame, Mapping[str, str], Mapping[str, str]]]
) -> DataFrame:
    """Left-join several lookups onto ``base``.

    Each lookup is ``(frame, {base column: lookup column}, {new column: lookup column})``.
    Only the named lookup columns travel. ``base`` rows are never lost, nor repeated as long
    as a lookup holds a key once.
    """
    result = base
    for number, (frame, on, take) in enumerate(lookups):
        keys = {right: f"_k{number}_{right}" for right in on.values()}
        side = frame.select(
            *[F.col(right).alias(alias) for right, alias in keys.items()],
            *[F.col(src).alias(new) for new, src in take.items()],
        )
        test = F.lit(True)
        for left, right in on.items():
            test = test & (F.col(left) == F.col(keys[right]))
        result = result.join(side, test, "left").drop(*keys.values())
    return result


def join_aggregate(base: DataFrame, aggregate: DataFrame, key: str, zero: Sequence[str] = ()) -> DataFrame:
    """Left-join a per-key aggregate; the ``zero`` measures are 0 where the key has no rows."""
    joined = base.join(aggregate, key, "left")
    kinds = dict(aggregate.dtypes)
    return joined.withColumns({c: F.coalesce(F.col(c), F.lit(0).cast(kinds[c])) for c in zero})


def left_join_detail(base: DataFrame, detail: DataFrame, key: str, take: Mapping[str, Column]) -> DataFrame:
    """One row per matching detail, and one row per base without any (``take`` on NULLs).

    A left join cannot split a hot key on its detail side. The matched rows come from
    an inner join, which can, and the rest from an anti join against the detail keys
    reduced to one each.
    """
    details = detail.select(F.col(key), *[F.col(c).alias(f"_d_{c}") for c in detail.columns if c != key])
    matched = base.join(details, key, "inner")
    lonely = base.join(detail.select(key).distinct(), key, "left_anti")
    kinds = dict(details.dtypes)
    lonely = lonely.withColumns(
        {c: F.lit(None).cast(kinds[c]) for c in details.columns if c != key}
    )
    rows = matched.unionByName(lonely)
    return rows.select(*base.columns, *[expr.alias(name) for name, expr in take.items()])


def lookup_keys(
    fact: DataFrame, lookups: Sequence[tuple[DataFrame, str, str, str]], unknown: str = "-1"
) -> DataFrame:
    """Replace natural ids by surrogate keys, with ``unknown`` for ids the dimension lacks.

    Each lookup is ``(dimension, fact id column, dimension id column, dimension key column)``;
    the new column is named after the dimension key column.
    """
    joined = denormalize(fact, [(dim, {fact_id: dim_id}, {key: key}) for dim, fact_id, dim_id, key in lookups])
    return joined.withColumns({key: F.coalesce(F.col(key), F.lit(unknown)) for _, _, _, key in lookups})


def irregular_keys(
    fact: DataFrame, lookups: Sequence[tuple[DataFrame, str, str, str, Column]], unknown: str = "-1"
) -> DataFrame:
    """The lookups of :func:`lookup_keys` for keys that are derived from the id, without moving ``fact``.

    Each lookup ends with the key that is expected for an id, as a column over the fact id column.
    Only ids travel: those whose rows in the dimension are not exactly one with the expected key are
    written to a table, mostly a small one, and joined. The new column is NULL where the key is the
    expected one; :func:`derived_keys` fills it in, best where rows no longer move.
    """
    result = fact
    for number, (dim, fact_id, dim_id, key, expected) in enumerate(lookups):
        ids = fact.select(fact_id).where(F.col(fact_id).isNotNull()).distinct()
        known = dim.select(F.col(dim_id).alias("_known"), F.col(key).alias("_key"))
        found = ids.join(known, F.col(fact_id) == F.col("_known"), "left").withColumn("_as_expected", F.col("_key").eqNullSafe(expected))
        odd = found.groupBy(fact_id).agg(F.count(F.lit(1)).alias("_n"), F.min("_as_expected").alias("_all"))
        odd = odd.where("_n > 1 OR NOT _all").select(fact_id)
        rows = found.join(odd, fact_id, "left_semi").select(
            F.col(fact_id).alias(f"_i{number}"), F.coalesce("_key", F.lit(unknown)).alias(f"_k{number}")
        )
        side = broadcast_checked(pin(rows, "irregular"))
        result = result.join(side, F.col(fact_id) == F.col(f"_i{number}"), "left")
        missing = F.when(F.col(fact_id).isNull(), F.lit(unknown))
        result = result.withColumn(key, F.coalesce(f"_k{number}", missing)).drop(f"_i{number}", f"_k{number}")
    return result


def derived_keys(rows: DataFrame, keys: Mapping[str, Column]) -> DataFrame:
    """Fill the keys that :func:`irregular_keys` left open; ``keys`` holds the expected ones."""
    return rows.withColumns({name: F.coalesce(F.col(name), expected) for name, expected in keys.items()})


def missing_rows(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Rows of ``left`` whose key ``right`` lacks."""
    return left.join(right.select(key).distinct(), key, "left_anti")


def present_rows(left: DataFrame, right: DataFrame, left_key: str, right_key: str) -> DataFrame:
    """Rows of ``left`` whose key ``right`` holds."""
    keys = right.select(F.col(right_key).alias(left_key))
    return left.join(keys, left_key, "left_semi")


def orphan_report(child: DataFrame, parents: Sequence[tuple[str, DataFrame, str]]) -> DataFrame:
    """Per foreign key: referencing rows, rows without a parent and distinct orphan values.

    The child is reduced to one row per referenced value before the join, so a value
    that very many rows share costs one row.
    """
    report = None
    for column, parent, parent_key in parents:
        values = child.where(F.col(column).isNotNull()).groupBy(F.col(column).alias("_ref")).agg(
            F.count(F.lit(1)).alias("_n")
        )
        known = parent.select(F.col(parent_key).alias("_ref")).distinct().withColumn("_known", F.lit(True))
        lost = F.col("_known").isNull()
        line = values.join(known, "_ref", "left").agg(
            F.lit(column).alias("foreign_key"),
            F.coalesce(F.sum("_n"), F.lit(0)).alias("checked_rows"),
            F.coalesce(F.sum(F.when(lost, F.col("_n"))), F.lit(0)).alias("orphan_rows"),
            F.count_if(lost).alias("orphan_values"),
        )
        report = line if report is None else report.unionByName(line)
    return report
