"""Deterministic hashes and keys: the same row gets the same value on every run."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def record_hash(columns: list[str], compat: bool = False) -> Column:
    """MD5 over the text of ``columns``.

    ``compat=True`` joins the values with ``|`` and skips NULLs, so different rows
    can share a hash. The default writes a marker for NULL and the length before
    each value, which keeps ``(a, NULL, b)``, ``(a, b, NULL)`` and values that
    contain the separator apart.
    """
    if compat:
        return F.md5(F.concat_ws("|", *[F.col(c).cast("string") for c in columns]))
    parts = []
    for name in columns:
        text = F.col(name).cast("string")
        parts.append(F.coalesce(F.concat(F.length(text).cast("string"), F.lit(":"), text), F.lit("-")))
    return F.md5(F.concat_ws("|", *parts))


def surrogate_key(entity: str, *natural_key: str | Column) -> Column:
    """A UUID-shaped key derived from the entity name and its natural key.

    Values are marked as in ``record_hash``, so separators inside them and NULLs make no two
    different keys equal.
    """
    cols = [(F.col(c) if isinstance(c, str) else c).cast("string") for c in natural_key]
    parts = [F.coalesce(F.concat(F.length(c).cast("string"), F.lit(":"), c), F.lit("-")) for c in cols]
    digest = F.md5(F.concat_ws("|", F.lit(entity), *parts))
    # Hyphens go in from the right, so the digest is named, and computed, once.
    for place in (21, 17, 13, 9):
        digest = F.overlay(digest, F.lit("-"), place, 0)
    return digest


def fold_keys(df: DataFrame, expected: Mapping[str, Column]) -> DataFrame:
    """NULL instead of each key that is the expected one, so that it takes no room in a shuffle.

    Other values are marked, NULL too; :func:`unfold_keys` gives all of them back.
    """
    marked = {n: F.coalesce(F.concat(F.lit("="), F.col(n)), F.lit("-")) for n in expected}
    return df.withColumns({n: F.when(~F.col(n).eqNullSafe(key), marked[n]) for n, key in expected.items()})


def unfold_keys(df: DataFrame, expected: Mapping[str, Column]) -> DataFrame:
    """The keys that :func:`fold_keys` took out, and the others as they were."""
    kept = {n: F.when(F.col(n) != "-", F.substr(n, F.lit(2))) for n in expected}
    return df.withColumns({n: F.when(F.col(n).isNull(), key).otherwise(kept[n]) for n, key in expected.items()})
