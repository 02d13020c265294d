"""Mixing sources to target weights, with DataFrame functions only.

Sizes are summed per source, targets follow from the weights, and each document is taken
floor(rate) times plus once more with the probability of the fraction, drawn from a hash of
its id. Nothing is shuffled but one row per source and task; a source with a third of all
rows is no heavier than another.

Targets: the sources, by code point and NULL last, weigh ``weights`` in turn and share
``share`` of all sizes. No target passes ``most`` times the size of its source; the excess is
shared again by weight among the others until none is above.

Defined results: a NULL text has size 0; so has an empty one, and both are taken 0 words. All
rows without a source form one source. The draw uses the id, or the text where the id is NULL,
so repeated rows are drawn alike and reruns agree. An empty table gives an empty result. A
source of size 0 has target 0.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratalake.operators.ordered import number_rows
from stratalake.session import pin

# Fixed value: a word is a run of bytes other than the six ASCII spaces.
WORD = r"[^\x20\x09-\x0D]+"
_DIGITS = 13  # hexadecimal digits of a draw: 52 bits are exact in a double


def words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def draw(seed: str, key: Column, text: Column) -> Column:
    """A number in [0, 1) that depends on the seed and the row alone."""
    basis = F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.md5(text.cast("binary")), F.lit("")))
    digits = F.substring(F.md5(basis.cast("binary")), 1, _DIGITS)
    return F.conv(digits, 16, 10).cast("double") / F.lit(float(16**_DIGITS))


def source_targets(
    sizes: DataFrame, source: str, size: str, weights: Sequence[int], share: float, most: float
) -> DataFrame:
    """``sizes`` (one row per source) with ``target``.

    The level at which uncapped sources share is found by the sharing itself: every round sums
    what the capped sources hold and weighs the others; it ends when no further source passes
    its cap, after as many rounds as there are levels of excess. Only sums reach the driver.
    """
    ranked = number_rows(
        sizes.withColumn("_null", F.col(source).isNull()), ["_null", source], "_rank"
    ).drop("_null")
    weight = F.element_at(F.array(*map(F.lit, weights)), ((F.col("_rank") - 1) % len(weights) + 1).cast("int"))
    cap = (F.col(size) * F.lit(float(most))).alias("_cap")
    ranked = pin(ranked.select(source, size, weight.cast("double").alias("_weight"), cap), "sources")
    total = (sizes.agg(F.sum(size)).first()[0] or 0) * share
    level = 0.0
    while True:
        capped = F.col("_cap") <= F.col("_weight") * F.lit(level)
        held, open_weight = ranked.agg(
            F.sum(F.when(capped, F.col("_cap"))), F.sum(F.when(~capped, F.col("_weight")))
        ).first()
        if not open_weight:
            break
        higher = (total - (held or 0.0)) / open_weight
        if higher <= level:
            break
        level = higher
    return ranked.select(source, size, F.least("_cap", F.col("_weight") * F.lit(level)).alias("target"))


def mix(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    source: str = "source",
    weights: Sequence[int] = (5, 2, 1),
    share: float = 1.5,
    most: float = 2.0,
    seed: str = "mix",
) -> DataFrame:
    """All columns of ``docs`` and a struct ``_mix`` of size, source_size, target and copies.

    ``copies`` says how often the mix takes the document.
    """
    # The row travels as one struct, so that no column of it can clash.
    rows = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_doc"),
        F.col(source).alias("_source"),
        words(F.col(text)).alias("_words"),
        draw(seed, F.col(key), F.col(text)).alias("_draw"),
    )
    sizes = rows.groupBy("_source").agg(F.sum("_words").alias("_source_size"))
    # Written, so that the size of this small table is known when the join is planned.
    targets = pin(source_targets(sizes, "_source", "_source_size", weights, share, most), "targets")
    targets = targets.withColumnRenamed("_source", "_of")
    joined = rows.join(targets, F.col("_source").eqNullSafe(F.col("_of")), "left")
    rate = F.coalesce(F.try_divide(F.col("target"), F.col("_source_size")), F.lit(0.0))
    copies = F.floor(rate) + (F.col("_draw") < rate - F.floor(rate)).cast("bigint")
    made = F.struct(
        F.col("_words").alias("size"),
        F.col("_source_size").alias("source_size"),
        F.col("target"),
        F.when(F.col("_words") > 0, copies).otherwise(F.lit(0)).cast("bigint").alias("copies"),
    )
    return joined.select("_doc.*", made.alias("_mix"))


def emit(mixed: DataFrame) -> DataFrame:
    """Each document as often as the mix takes it, without the ``_mix`` column."""
    times = F.col("_mix.copies").cast("int")
    repeated = mixed.where(times > 0).withColumn("_copy", F.explode(F.array_repeat(F.lit(1), times)))
    return repeated.drop("_mix", "_copy")
