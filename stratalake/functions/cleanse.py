"""Column rules that turn lenient text into typed, standardised values."""

from __future__ import annotations

import operator
from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

_COMPARE = {"<": operator.lt, "<=": operator.le, ">": operator.gt, ">=": operator.ge, "=": operator.eq}


def blank_to_null(col: Column) -> Column:
    """Trimmed text, NULL when nothing is left."""
    return F.nullif(F.trim(col), F.lit(""))


def parse_flag(col: Column, default: bool = True) -> Column:
    """``true``/``false`` in any case; anything else, NULL included, is ``default``."""
    opposite = "false" if default else "true"
    return F.when(F.lower(F.trim(col)) == opposite, F.lit(not default)).otherwise(F.lit(default))


def typed_null(type_name: str) -> Column:
    """A NULL that carries a type, so that a written schema never has a void column."""
    return F.lit(None).cast(type_name)


def typed(value, type_name: str) -> Column:
    return F.lit(value).cast(type_name)


def bucket(col: Column, steps: Sequence[tuple[str, object, object]], default) -> Column:
    """First label whose ``(comparison, bound)`` holds, else ``default`` (also for NULL)."""
    branches = F
    for sign, bound, label in steps:
        branches = branches.when(_COMPARE[sign](col, F.lit(bound)), F.lit(label))
    return branches.otherwise(F.lit(default))


def recode(col: Column, labels: Mapping[str, str], default: str) -> Column:
    """Look up ``col`` in a small literal map."""
    pairs = [F.lit(part) for item in labels.items() for part in item]
    return F.coalesce(F.element_at(F.create_map(*pairs), col), F.lit(default))


def at_least(col: Column, bound) -> Column:
    """Flag ``col >= bound``; NULL counts as false."""
    return F.coalesce(col >= F.lit(bound), F.lit(False))


def list_items(col: Column) -> Column:
    """Trimmed entries of a comma-separated list, empty array for blank text."""
    entries = F.transform(F.split(F.coalesce(col, F.lit("")), ","), lambda x: F.trim(x))
    return F.filter(entries, lambda x: x != "")


CASTS = {
    "int": lambda c: c.try_cast("int"),
    "long": lambda c: c.try_cast("bigint"),
    "date": lambda c: c.try_cast("date"),
    "timestamp": lambda c: c.try_cast("timestamp"),
    "text": F.trim,
    "text_or_null": blank_to_null,
    "lower": lambda c: F.lower(blank_to_null(c)),
    "upper": lambda c: F.trim(F.upper(c)),
    "flag": parse_flag,
}


def apply_rule(col: Column, rule: str) -> Column:
    """Column ``col`` under a named rule, or a tolerant cast to ``decimal(p,s)``."""
    if rule.startswith("decimal"):
        return col.try_cast(rule)
    return CASTS[rule](col)
