"""Versioned tables: type-2 history, bitemporal history, as-of reads and integrity checks.

Versions cover ``[sys_start, sys_end)``; the current one ends at :data:`OPEN_END`.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratalake.operators.ordered import carry_forward, neighbours, running_max

OPEN_END = "9999-12-31 00:00:00"


def open_end() -> Column:
    return F.lit(OPEN_END).cast("timestamp")


def current_state(hist: DataFrame) -> DataFrame:
    """Versions that are still open."""
    return hist.where(F.col("sys_end") == open_end())


def as_of(hist: DataFrame, at: Column) -> DataFrame:
    """Versions valid at one instant."""
    return hist.where((F.col("sys_start") <= at) & (at < F.col("sys_end")))


def changed_since(hist: DataFrame, since: Column) -> DataFrame:
    """Versions that began at or after ``since``."""
    return hist.where(F.col("sys_start") >= since)


def version_history(hist: DataFrame, key: str, value=None) -> DataFrame:
    """Versions in order, of one key or of all."""
    rows = hist if value is None else hist.where(F.col(key) == value)
    return rows.orderBy(key, "sys_start")


def systime_start(effective: Column, now: Column, tolerance_seconds: float = 0.01) -> Column:
    """Start of the system period: the effective time if it is (almost) now, else now."""
    gap = F.abs(F.unix_micros(now) - F.unix_micros(effective))
    return F.when(gap < int(tolerance_seconds * 1_000_000), effective).otherwise(now)


def _changed(left: str, right: str, columns: Sequence[str]) -> Column:
    test = F.lit(False)
    for name in columns:
        test = test | ~F.col(f"{left}.{name}").eqNullSafe(F.col(f"{right}.{name}"))
    return test


def scd2_merge(
    hist: DataFrame,
    source: DataFrame,
    key: str,
    columns: Sequence[str],
    at: Column,
    close_missing: bool = False,
    exclude: Sequence[str] = (),
) -> DataFrame:
    """Apply a source snapshot to a type-2 history and return the new history.

    A changed key closes its current version at ``at`` and opens a new one, a new key
    opens one, and with ``close_missing`` a key absent from the source is closed.
    Columns in ``exclude`` are refreshed in place without opening a version. Only open
    versions take part in the join; closed ones pass through untouched. A version that began
    at ``at`` is replaced in place, or dropped if its key is closed; one that began later
    stops the merge, as the history already knows more than the snapshot.
    """
    tracked = [c for c in columns if c not in exclude]
    is_open = F.col("sys_end") == open_end()
    payload = F.struct(*columns)
    old = hist.where(is_open).select(key, payload.alias("_old"), "sys_start")
    new = source.select(key, payload.alias("_new"))
    pair = old.join(new, key, "full")

    def version(data: str, start: Column, end: Column) -> Column:
        return F.struct(F.col(data).alias("data"), start.alias("sys_start"), end.alias("sys_end"))

    has_old, has_new = F.col("_old").isNotNull(), F.col("_new").isNotNull()
    kept = version("_old", F.col("sys_start"), open_end())
    refreshed = version("_new", F.col("sys_start"), open_end())
    closed = version("_old", F.col("sys_start"), at)
    opened = version("_new", at, open_end())
    changed = has_old & has_new & _changed("_old", "_new", tracked)
    missing = ~has_new & F.lit(close_missing)
    late = F.raise_error(F.lit("an open version began after the time of the merge"))
    versions = (
        F.when((changed | missing) & (F.col("sys_start") > at), late)
        .when(changed & (F.col("sys_start") == at), F.array(refreshed))
        .when(changed, F.array(closed, opened))
        .when(has_old & has_new, F.array(refreshed))
        .when(has_new, F.array(opened))
        .when(missing, F.filter(F.array(closed), lambda v: v["sys_start"] < v["sys_end"]))
        .otherwise(F.array(kept))
    )
    touched = pair.select(key, F.explode(versions).alias("_v")).select(
        key, *[F.col(f"_v.data.{c}").alias(c) for c in columns], "_v.sys_start", "_v.sys_end"
    )
    settled = hist.where(~is_open).select(key, *columns, "sys_start", "sys_end")
    return settled.unionByName(touched)


def scd2_from_log(
    log: DataFrame, key: str, order: str, at: str, columns: Sequence[str], exclude: Sequence[str] = ()
) -> DataFrame:
    """Versions of each key from its change log.

    ``I`` and ``U`` open a version, the next change of the key closes it, and ``D`` only
    closes. With ``exclude``, an update that alters nothing but excluded columns opens
    no version. Versions closed in the instant they opened are left out.
    """
    rows = log.select(key, order, "op", at, *columns)
    if exclude:
        tracked = [c for c in columns if c not in exclude]
        rows = rows.withColumn("_now", F.struct(*tracked))
        rows = neighbours(rows, [key], [order], previous={"_was": "_now", "_was_op": "op"})
        silent = (
            (F.col("op") != "D")
            & F.col("_was_op").isNotNull()
            & (F.col("_was_op") != "D")
            & ~_changed("_now", "_was", tracked)
        )
        rows = rows.where(~silent).drop("_now", "_was", "_was_op")
    linked = neighbours(rows, [key], [order], following={"_next": at})
    versions = linked.where(F.col("op") != "D").select(
        key, *columns, F.col(at).alias("sys_start"), F.coalesce("_next", open_end()).alias("sys_end")
    )
    return versions.where(F.col("sys_start") < F.col("sys_end"))


def apply_log(hist: DataFrame, log: DataFrame, key: str, order: str, at: str, columns: Sequence[str]) -> DataFrame:
    """Extend a type-2 history by a batch of later log entries.

    The first entry of a key in the batch closes its open version, the batch then adds its
    own versions. Applying a log batch by batch gives the history of the whole log.
    """
    firsts = log.groupBy(key).agg(F.min_by(at, order).alias("_first"))
    is_open = F.col("sys_end") == open_end()
    touched = hist.where(is_open).join(firsts, key, "left")
    touched = touched.withColumn("sys_end", F.coalesce("_first", "sys_end")).drop("_first")
    touched = touched.where(F.col("sys_start") < F.col("sys_end"))
    added = scd2_from_log(log, key, order, at, columns)
    names = [key, *columns, "sys_start", "sys_end"]
    return hist.where(~is_open).select(names).unionByName(touched.select(names)).unionByName(added.select(names))


def bitemporal_history(
    log: DataFrame, key: str, order: str, effective: str, now: str, columns: Sequence[str]
) -> DataFrame:
    """Two time axes per change: when it held, and when the system believed it.

    An insert opens both axes at its effective time; an update closes the previous row
    (business axis at the new effective time, system axis at the new system start) and
    opens the next; a delete closes both axes at its system time. ``operation_type`` is
    1 for an insert, 0 for an update and NULL once a delete closed the row.
    ``is_valid_range`` is false where out-of-order effective times leave an empty range.
    """
    eff, sys = F.col(effective), F.col(now)
    start = F.when(F.col("op") == "I", eff).when(F.col("op") == "U", systime_start(eff, sys)).otherwise(sys)
    rows = log.select(
        key,
        order,
        "op",
        *columns,
        F.when(F.col("op") == "D", sys).otherwise(eff).alias("effective_from"),
        start.alias("system_from"),
    )
    linked = neighbours(
        rows,
        [key],
        [order],
        following={"_next_op": "op", "effective_to": "effective_from", "system_to": "system_from"},
    )
    kind = F.when(F.col("_next_op") == "D", F.lit(None)).when(F.col("op") == "I", 1).otherwise(0).cast("int")
    kept = linked.where(F.col("op") != "D").select(
        key,
        order,
        *columns,
        "effective_from",
        F.coalesce("effective_to", open_end()).alias("effective_to"),
        "system_from",
        F.coalesce("system_to", open_end()).alias("system_to"),
        kind.alias("operation_type"),
    )
    valid = (F.col("effective_from") < F.col("effective_to")) & (F.col("system_from") < F.col("system_to"))
    return kept.withColumn("is_valid_range", valid)


def as_of_join(
    facts: DataFrame, hist: DataFrame, key: str, at: str, fact_id: str, columns: Sequence[str]
) -> DataFrame:
    """Attach to each fact the version of its key that was valid at the fact's time.

    Facts and version starts are merged into one ordered stream per key and the latest
    start is carried forward, which is linear; an equi-join with a range test would
    build every fact-version pair of a key. Facts outside every version get NULLs.
    """
    payload = F.struct(*columns, "sys_end")
    starts = hist.select(
        F.col(key),
        F.col("sys_start").alias("_at"),
        F.lit(0).alias("_kind"),
        F.lit(None).cast("string").alias("_id"),
        payload.alias("_version"),
    )
    kind = starts.schema["_version"].dataType
    others = [c for c in facts.columns if c != key]
    points = facts.select(
        F.col(key),
        F.col(at).alias("_at"),
        F.lit(1).alias("_kind"),
        F.col(fact_id).cast("string").alias("_id"),
        F.lit(None).cast(kind).alias("_version"),
        F.struct(*others).alias("_fact"),
    )
    stream = starts.unionByName(points, allowMissingColumns=True)
    # At equal times a version start sorts before the facts, so the start is inclusive.
    filled = carry_forward(stream, [key], ["_at", "_kind", "_id"], "_version").where("_kind = 1")
    valid = F.col("_at") < F.col("_version.sys_end")
    return filled.select(
        key,
        *[F.col(f"_fact.{c}").alias(c) for c in others],
        *[F.when(valid, F.col(f"_version.{c}")).alias(c) for c in columns],
    )


def interval_violations(hist: DataFrame, key: str) -> DataFrame:
    """Per key: overlaps, gaps, empty ranges and the number of open versions, where anything is wrong.

    A version overlaps if it begins before the latest end of all earlier ones, and leaves a gap
    if it begins after it.
    """
    rows = hist.select(key, "sys_start", "sys_end").withColumn("_open", F.col("sys_end") == open_end())
    # Equal starts overlap too; the end breaks the tie so that every row has its place.
    linked = running_max(rows, [key], ["sys_start", "sys_end"], "sys_end", "_reach")
    report = linked.groupBy(key).agg(
        F.count_if(F.col("_reach") > F.col("sys_start")).alias("overlaps"),
        F.count_if(F.col("_reach") < F.col("sys_start")).alias("gaps"),
        F.count_if(F.col("sys_start") >= F.col("sys_end")).alias("empty_ranges"),
        F.count_if("_open").alias("open_versions"),
    )
    return report.where("overlaps > 0 or gaps > 0 or empty_ranges > 0 or open_versions <> 1")
