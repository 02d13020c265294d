"""Ordered computations that hold when one key owns a large share of the rows.

A plain window over a key (or over no key) puts that key into one task. Here the rows
are range-partitioned on key *and* order, so a hot key spreads over many chunks; each
row learns its chunk and its place in it, and a summary of one row per chunk carries
the state over the chunk borders. Both numbers are written out before use, because a
recomputed range shuffle may draw other borders. There are at most as many chunks as
shuffle partitions, which bounds every summary that is broadcast here.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stratalake.session import pin

CHUNK, ROW = "_chunk", "_row"
# The lower 33 bits of the generated id count the rows of a partition.
_ROW_BITS = (1 << 33) - 1


def range_chunks(df: DataFrame, order: Sequence[str], chunks: int | None = None) -> DataFrame:
    """``df`` with ``_chunk``, contiguous ranges of ``order``, and ``_row``, the place inside.

    Without ``chunks`` their number follows the data: adaptive execution merges small ones.
    """
    columns = [F.col(c) for c in order]
    parts = df.repartitionByRange(chunks, *columns) if chunks else df.repartitionByRange(*columns)
    place = F.monotonically_increasing_id().bitwiseAND(F.lit(_ROW_BITS))
    placed = parts.sortWithinPartitions(*columns).withColumns({CHUNK: F.spark_partition_id(), ROW: place})
    return pin(placed, "chunks")


def _inside() -> Window:
    return Window.partitionBy(CHUNK).orderBy(ROW)


def _over_chunks() -> Window:
    # One row per chunk reaches this window.
    return Window.orderBy(CHUNK)


def _sizes(chunked: DataFrame) -> DataFrame:
    return chunked.groupBy(CHUNK).agg(F.max(ROW).alias("_end"))


def _offsets(chunked: DataFrame) -> DataFrame:
    """Per chunk: rows before it, its last place, and all rows."""
    every = _over_chunks().rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    before = _over_chunks().rowsBetween(Window.unboundedPreceding, -1)
    return _sizes(chunked).select(
        CHUNK,
        "_end",
        F.coalesce(F.sum(F.col("_end") + 1).over(before), F.lit(0)).alias("_offset"),
        F.sum(F.col("_end") + 1).over(every).alias("_total"),
    )


def _of_same_key(other: Column, keys: Sequence[str]) -> Column:
    """Whether the row held in ``other`` exists and has the key of this row."""
    test = other.isNotNull()
    for key in keys:
        test = test & other[key].eqNullSafe(F.col(key))
    return test


def neighbours(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    previous: Mapping[str, str] | None = None,
    following: Mapping[str, str] | None = None,
    chunks: int | None = None,
) -> DataFrame:
    """Add values of the previous and following row of the same key.

    ``previous`` and ``following`` map a new column to the column it is taken from.
    ``keys + order`` must identify a row.
    """
    chunked = range_chunks(df, [*keys, *order], chunks)
    added: dict[str, Column] = {}
    inside: dict[str, Column] = {}
    borders = _sizes(chunked)
    for side, wanted, look in (("_before", previous, F.lag), ("_after", following, F.lead)):
        if wanted:
            row = F.struct(*[F.col(c) for c in dict.fromkeys([*keys, *wanted.values()])])
            # The row before a chunk is the last of the chunk before, the row after it the first of the next.
            edge = F.col(ROW) == (F.col("_end") if side == "_before" else F.lit(0))
            edges = chunked.join(F.broadcast(_sizes(chunked)), CHUNK).where(edge).select(CHUNK, row.alias("_edge"))
            edges = edges.select(CHUNK, look("_edge").over(_over_chunks()).alias(side))
            borders = borders.join(F.broadcast(edges), CHUNK)
            inside[f"{side}_here"] = look(row).over(_inside())
            other = F.coalesce(f"{side}_here", side)
            added |= {new: F.when(_of_same_key(other, keys), other[src]) for new, src in wanted.items()}
    marked = chunked.withColumns(inside).join(F.broadcast(borders.drop("_end")), CHUNK)
    return marked.select(*df.columns, *[value.alias(new) for new, value in added.items()])


def carry_forward(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], value: str, chunks: int | None = None
) -> DataFrame:
    """Replace NULLs of ``value`` by the latest earlier non-NULL value of the same key."""
    chunked = range_chunks(df, [*keys, *order], chunks)
    given = F.col(value).isNotNull()
    held = F.when(given, F.struct(*[F.col(c) for c in keys], F.col(value).alias("_value")))
    latest_place = chunked.groupBy(CHUNK).agg(F.max(F.when(given, F.col(ROW))).alias("_at"))
    # A chunk without any value still needs its row, to receive what came before it.
    carried = latest_place.join(
        chunked.select(CHUNK, F.col(ROW).alias("_at"), held.alias("_held")).join(
            F.broadcast(latest_place), [CHUNK, "_at"], "left_semi"
        ),
        [CHUNK, "_at"],
        "left",
    )
    before = _over_chunks().rowsBetween(Window.unboundedPreceding, -1)
    borders = carried.select(CHUNK, F.last("_held", ignorenulls=True).over(before).alias("_before"))
    upto = _inside().rowsBetween(Window.unboundedPreceding, Window.currentRow)
    here = chunked.withColumn("_here", F.last(held, ignorenulls=True).over(upto))
    latest = F.coalesce("_here", "_before")
    rest = [c for c in df.columns if c != value]
    return here.join(F.broadcast(borders), CHUNK).select(
        *rest, F.when(_of_same_key(latest, keys), latest["_value"]).alias(value)
    )


def running_max(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], value: str, name: str, chunks: int | None = None
) -> DataFrame:
    """Add the largest ``value`` of the earlier rows of the same key; NULL for the first of them."""
    chunked = range_chunks(df, [*keys, *order], chunks)
    key = F.struct(*[F.col(c) for c in keys])
    ends = chunked.join(F.broadcast(_sizes(chunked)), CHUNK).where(F.col(ROW) == F.col("_end"))
    ends = ends.select(CHUNK, key.alias("_key"))
    # Only the last key of a chunk goes on behind its border.
    tops = chunked.select(CHUNK, key.alias("_key"), value).join(F.broadcast(ends), [CHUNK, "_key"])
    tops = tops.groupBy(CHUNK, "_key").agg(F.max(value).alias("_top"))
    upto = Window.partitionBy("_key").orderBy(CHUNK).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    carried = tops.withColumn("_top", F.max("_top").over(upto)).select(CHUNK, F.struct("_key.*", "_top").alias("_held"))
    borders = carried.select(CHUNK, F.lag("_held").over(_over_chunks()).alias("_before"))
    earlier = Window.partitionBy(CHUNK, *keys).orderBy(ROW).rowsBetween(Window.unboundedPreceding, -1)
    marked = chunked.withColumn("_here", F.max(value).over(earlier)).join(F.broadcast(borders), CHUNK)
    before = F.when(_of_same_key(F.col("_before"), keys), F.col("_before")["_top"])
    return marked.select(*df.columns, F.greatest("_here", before).alias(name))


def number_rows(
    df: DataFrame, order: Sequence[str], name: str, start: int = 0, total: str | None = None, chunks: int | None = None
) -> DataFrame:
    """Dense numbers ``start + 1 ...`` in the global order of ``order`` (which must identify a row)."""
    chunked = range_chunks(df, order, chunks)
    placed = chunked.join(F.broadcast(_offsets(chunked)), CHUNK)
    position = F.col("_offset") + F.col(ROW) + F.lit(start + 1)
    extra = [F.col("_total").alias(total)] if total else []
    return placed.select(*df.columns, position.cast("bigint").alias(name), *extra)


def rank_rows(
    df: DataFrame, value: str, key: str, rank: str, total: str | None = None, chunks: int | None = None
) -> DataFrame:
    """Global rank by ascending ``value``: one plus the number of smaller values.

    ``key`` makes the rows distinct, so that a value shared by very many rows still
    spreads over chunks. Such a value can touch several chunks; it starts where the
    first of them says.
    """
    chunked = range_chunks(df, [value, key], chunks)
    offsets = F.broadcast(_offsets(chunked))
    highest = chunked.join(offsets, CHUNK).where(F.col(ROW) == F.col("_end"))
    highest = highest.select(CHUNK, F.col(value).alias("_edge"), "_offset")
    lowest = chunked.where(F.col(ROW) == 0).join(offsets, CHUNK)
    lowest = lowest.select(F.col(value).alias("_edge"), (F.col("_offset") + 1).alias("_at"))
    starts = (
        chunked.join(F.broadcast(highest), CHUNK)
        .where(F.col(value).eqNullSafe(F.col("_edge")))
        .groupBy("_edge", "_offset")
        .agg(F.min(ROW).alias("_first"))
        .select("_edge", (F.col("_offset") + F.col("_first") + 1).alias("_at"))
    )
    edges = lowest.unionByName(starts).groupBy("_edge").agg(F.min("_at").alias("_at"))
    inside = Window.partitionBy(CHUNK).orderBy(value)
    placed = chunked.withColumn("_rank", F.rank().over(inside)).join(offsets, CHUNK)
    extra = [F.col("_total").alias(total)] if total else []
    return placed.join(F.broadcast(edges), F.col(value).eqNullSafe(F.col("_edge")), "left").select(
        *df.columns, F.coalesce("_at", F.col("_offset") + F.col("_rank")).cast("bigint").alias(rank), *extra
    )


def tile(position: Column, total: Column, tiles: int) -> Column:
    """Tile number of a dense position, the larger tiles first as in ``ntile``."""
    small = F.floor(total / tiles)
    larger = total % tiles
    split = larger * (small + 1)
    return (
        F.when(position <= split, F.floor((position - 1) / (small + 1)) + 1)
        .otherwise(larger + F.floor(F.try_divide(position - 1 - split, small)) + 1)
        .cast("int")
    )
