"""Reference tables: merge, sync and soft delete.

Every function returns the complete new snapshot of the table.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _paired(current: DataFrame, new: DataFrame, key: str, values: Sequence[str]) -> DataFrame:
    old = current.select(key, F.struct(*[c for c in current.columns if c != key]).alias("_old"))
    fresh = new.select(key, F.struct(*values).alias("_new"))
    return old.join(fresh, key, "full")


def _differs(values: Sequence[str]) -> Column:
    test = F.lit(False)
    for name in values:
        test = test | ~F.col(f"_old.{name}").eqNullSafe(F.col(f"_new.{name}"))
    return test


def merge_reference(
    current: DataFrame,
    new: DataFrame,
    key: str,
    compare: Sequence[str],
    at: Column,
    on_missing: str = "deactivate",
    inactivated: str = "inactivated_date",
    changed: str = "systime",
) -> DataFrame:
    """Update rows whose ``compare`` columns differ, insert new keys and treat missing ones.

    ``on_missing`` is ``deactivate`` (stamp ``inactivated`` once, keeping an earlier
    date), ``delete`` or ``keep``. Unchanged rows keep their change time.
    """
    if on_missing not in ("deactivate", "delete", "keep"):
        raise ValueError(f"unknown on_missing: {on_missing}")
    # An inserted row takes every column that the new record has.
    given = [c for c in current.columns if c in new.columns and c != key]
    paired = _paired(current, new, key, list(dict.fromkeys([*compare, *given])))
    has_old, has_new = F.col("_old").isNotNull(), F.col("_new").isNotNull()
    if on_missing == "delete":
        paired = paired.where(has_new)
    update = has_old & has_new & _differs(compare)
    columns = []
    kinds = dict(current.dtypes)
    for name in current.columns:
        if name == key:
            value = F.col(key)
        elif name in compare:
            value = F.when(has_new, F.col(f"_new.{name}")).otherwise(F.col(f"_old.{name}"))
        elif name == changed:
            value = F.when(update | ~has_old, at).otherwise(F.col(f"_old.{name}"))
        elif name in given:
            value = F.when(has_old, F.col(f"_old.{name}")).otherwise(F.col(f"_new.{name}"))
        else:
            value = F.col(f"_old.{name}")
        if name == inactivated and name not in compare and on_missing == "deactivate":
            value = F.when(~has_new, F.coalesce(value, at)).otherwise(value)
        elif name == inactivated and on_missing == "deactivate":
            value = F.when(~has_new, F.coalesce(F.col(f"_old.{name}"), at)).otherwise(value)
        columns.append(value.cast(kinds[name]).alias(name))
    return paired.select(*columns)


def sync_reference(
    current: DataFrame,
    new: DataFrame,
    key: str,
    at: Column,
    strict: bool = True,
    inactivated: str = "inactivated_date",
    changed: str = "systime",
) -> DataFrame:
    """Upsert the active rows of ``new``; ``strict`` also removes keys that are not among them.

    Every upserted row is stamped with ``at``, changed or not.
    """
    active = new.where(F.col(inactivated).isNull()) if inactivated in new.columns else new
    values = [c for c in active.columns if c not in (key, changed)]
    paired = _paired(current, active, key, values)
    has_new = F.col("_new").isNotNull()
    if strict:
        paired = paired.where(has_new)
    kinds = dict(current.dtypes)
    columns = [F.col(key)]
    for name in current.columns:
        if name == key:
            continue
        if name == changed:
            value = F.when(has_new, at).otherwise(F.col(f"_old.{name}"))
        elif name in values:
            value = F.when(has_new, F.col(f"_new.{name}")).otherwise(F.col(f"_old.{name}"))
        else:
            value = F.col(f"_old.{name}")
        columns.append(value.cast(kinds[name]).alias(name))
    return paired.select(*columns)


def deactivate(df: DataFrame, which: Column, at: Column, inactivated: str = "inactivated_date") -> DataFrame:
    """Soft delete: stamp rows that are still active."""
    return df.withColumn(inactivated, F.when(which, F.coalesce(F.col(inactivated), at)).otherwise(F.col(inactivated)))


def reactivate(df: DataFrame, which: Column, inactivated: str = "inactivated_date") -> DataFrame:
    """Clear the stamp of soft-deleted rows."""
    return df.withColumn(inactivated, F.when(~F.coalesce(which, F.lit(False)), F.col(inactivated)))


def active_only(df: DataFrame, inactivated: str = "inactivated_date") -> DataFrame:
    return df.where(F.col(inactivated).isNull())
