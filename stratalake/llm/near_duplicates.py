"""Near duplicates of texts by SetSketch registers.

A text is the set of its distinct five-word shingles. Its sketch holds one register per hash
function: the exponentially spaced, truncated minimum of exponentially distributed hash values.
Registers of a union are the larger registers of its parts, and two texts agree in a register
about as often as they share shingles. So:

1. texts with the same word sequence form a class, found by a digest; one sketch per class;
2. registers are cut into bands; classes that agree in all registers of a band share a bucket,
   and only the few buckets with several classes are kept;
3. in each bucket every class is paired with the smallest one (a star, linear in the bucket);
   a pair goes on if sizes allow the similarity and if its maximum-likelihood estimate, from
   how many registers are larger, smaller and equal and from both set sizes, is not far below
   the threshold; survivors are compared on their full sets;
4. a bucket whose classes are one component by now is done. In the others each class outside
   the bucket's largest component is paired with all classes of other components, estimated and
   verified as before: by a join in small buckets, in large ones block by block inside tasks,
   from which only links come out.

With 51 bands of 5 registers a pair at the threshold of 0.75 misses all buckets with a
probability of 1e-6, and the estimate drops it with 3e-5. Links are only reported after both
full sets were compared.

Defined results: texts without words, and NULL, have an empty set and link with nothing. A
text of fewer than five words is one shingle, its whole sequence. Rows that share an id are
one document. Rows without an id take no part: their component is NULL and they are kept.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, DoubleType, LongType

from stratalake.llm.components import components, joined_by_id, named_by_id, same_by_id
from stratalake.llm.workers import give_up_idle
from stratalake.session import fresh_path, pin, scratch, unpin

WORDS = 5
REGISTERS, BAND = 256, 5
BANDS = REGISTERS // BAND
BASE, RATE, TOP = 1.001, 20.0, (1 << 16) - 2  # register = floor(1 - log_BASE(minimum / RATE)) in 0 .. TOP + 1
SLACK = 0.11  # four standard deviations of the estimate at 0.75
SMALL_BUCKET = 64  # pairs of a bucket up to this size come from a join
BLOCK = 512  # classes of a block in larger buckets

_random = np.random.Generator(np.random.PCG64(20240607))
_SHINGLE = _random.integers(0, 1 << 63, WORDS, np.uint64) * np.uint64(2) + np.uint64(1)
_TIMES = (_random.integers(0, 1 << 31, REGISTERS, np.uint64) * np.uint64(2) + np.uint64(1)).astype(np.uint32)
_PLUS = _random.integers(0, 1 << 32, REGISTERS, np.uint64).astype(np.uint32)
_BANDING = _random.integers(0, 1 << 63, (BANDS, BAND), np.uint64) * np.uint64(2) + np.uint64(1)


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    return h ^ (h >> np.uint64(29))


def word_list(text: str | None) -> list[bytes]:
    """Words of a text, A-Z lower-cased; ``bytes`` knows the six ASCII spaces and letters only."""
    return (text or "").encode("utf-8", "replace").lower().split()


def shingles(words: list[bytes]) -> np.ndarray:
    """Sorted 64-bit hashes of the distinct shingles."""
    if not words:
        return np.array([], np.uint64)
    if len(words) < WORDS:
        return np.array([xxhash.xxh64_intdigest(b"\x20".join(words), len(words))], np.uint64)
    hashed = np.array(list(map(xxhash.xxh64_intdigest, words)), np.uint64)
    n = len(words) - WORDS + 1
    total = np.zeros(n, np.uint64)
    for i in range(WORDS):
        total += hashed[i : i + n] * _SHINGLE[i]
    ordered = np.sort(_mixed(total))
    return ordered[np.concatenate(([True], ordered[1:] != ordered[:-1]))]


def registers(items: np.ndarray) -> np.ndarray:
    """The sketch of a non-empty set of hashes."""
    small = (items ^ (items >> np.uint64(32))).astype(np.uint32)
    least = np.full(REGISTERS, np.iinfo(np.uint32).max, np.uint32)
    for i in range(0, len(small), 512):
        values = small[i : i + 512, None] * _TIMES
        values += _PLUS
        np.minimum(least, values.min(axis=0), out=least)
    value = -np.log1p(-(least + 0.5) / 2.0**32)  # an exponential variate per hash function
    level = np.floor(1.0 - np.log(value / RATE) / np.log(BASE))
    return np.clip(level, 0, TOP + 1).astype(np.uint16)


def band_keys(sketches: np.ndarray) -> np.ndarray:
    """One 64-bit key per band, rows of sketches in, rows of keys out."""
    parts = sketches[:, : BANDS * BAND].reshape(-1, BANDS, BAND).astype(np.uint64)
    return _mixed((_mixed(parts + np.uint64(1)) * _BANDING).sum(axis=2, dtype=np.uint64))


def likely_similarity(one: np.ndarray, other: np.ndarray, n_one: np.ndarray, n_other: np.ndarray) -> np.ndarray:
    """Maximum-likelihood Jaccard similarity of sketches (rows) whose set sizes are known.

    The likelihood of the larger, smaller and equal registers is concave in the similarity.
    """
    larger = (one > other).sum(axis=-1)
    smaller = (one < other).sum(axis=-1)
    equal = REGISTERS - larger - smaller
    u = n_one / (n_one + n_other)
    v = 1.0 - u

    def chance(x: np.ndarray) -> np.ndarray:
        return -np.log1p(-np.clip(x, 1e-12, 1) * (BASE - 1) / BASE) / np.log(BASE)

    def likelihood(j: np.ndarray) -> np.ndarray:
        up, down = chance(u - v * j), chance(v - u * j)
        return larger * np.log(up) + smaller * np.log(down) + equal * np.log(np.maximum(1 - up - down, 1e-12))

    low, high = np.zeros_like(u), np.minimum(u / v, v / u)
    for _ in range(24):
        left, right = low + (high - low) / 3, high - (high - low) / 3
        better = likelihood(left) < likelihood(right)
        low, high = np.where(better, left, low), np.where(better, high, right)
    return (low + high) / 2


def _rows(column: pa.Array) -> np.ndarray:
    """Sketches of a non-NULL binary column as a matrix."""
    return np.frombuffer(b"".join(column.to_pylist()), np.uint16).reshape(len(column), REGISTERS)


def _digest(words: list[bytes]) -> bytes | None:
    return hashlib.blake2b(b" ".join(words), digest_size=16).digest() if words else None


def sketches(df: DataFrame, key: str, text: str) -> DataFrame:
    """``id, n_shingles, digest, sketch``; the digest of a word sequence and its sketch are NULL if empty."""
    schema = pa.schema([("id", pa.int64()), ("n_shingles", pa.int64()), ("digest", pa.binary()), ("sketch", pa.binary())])

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            give_up_idle()
            sizes, digests, made = [], [], []
            for whole in batch.column(1).to_pylist():
                words = word_list(whole)
                items = shingles(words)
                sizes.append(len(items))
                digests.append(_digest(words))
                made.append(registers(items).tobytes() if words else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes, pa.int64()), pa.array(digests, pa.binary()), pa.array(made, pa.binary())],
                schema=schema,
            )

    narrow = df.select(F.col(key).cast("bigint").alias("id"), F.col(text).cast("string").alias("text"))
    return narrow.mapInArrow(sketch, "id bigint, n_shingles bigint, digest binary, sketch binary")


@F.arrow_udf(ArrayType(LongType()))
def _keys(column: pa.Array) -> pa.Array:
    give_up_idle()
    keys = band_keys(_rows(column)).view(np.int64)
    return pa.ListArray.from_arrays(pa.array(np.arange(len(keys) + 1) * BANDS, pa.int32()), pa.array(keys.ravel()))


@F.arrow_udf(DoubleType())
def _estimate(one: pa.Array, other: pa.Array, n_one: pa.Array, n_other: pa.Array) -> pa.Array:
    if not len(one):
        return pa.array([], pa.float64())
    return pa.array(likely_similarity(_rows(one), _rows(other), *(n.to_numpy().astype(float) for n in (n_one, n_other))))


@F.arrow_udf(ArrayType(LongType()))
def _shingle_sets(texts: pa.Array) -> pa.Array:
    give_up_idle()
    return pa.array([shingles(word_list(t)).view(np.int64) for t in texts.to_pylist()], pa.list_(pa.int64()))


@F.arrow_udf(BinaryType())
def _digests(texts: pa.Array) -> pa.Array:
    return pa.array([_digest(word_list(t)) for t in texts.to_pylist()], pa.binary())


def _sizes_allow(n: Column, m: Column, percent: int) -> Column:
    return F.least(n, m) * 100 >= F.greatest(n, m) * percent


def _plausible(pairs: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """Distinct pairs ``a, b`` whose sizes and sketches do not speak against a link."""
    side = lambda x: classes.select(F.col("id").alias(x), F.col("n").alias(f"n_{x}"), F.col("sketch").alias(f"s_{x}"))
    both = pairs.select("a", "b").distinct().join(side("a"), "a").join(side("b"), "b")
    fits = both.where(_sizes_allow(F.col("n_a"), F.col("n_b"), percent))
    return fits.where(_estimate("s_a", "s_b", "n_a", "n_b") >= percent / 100 - SLACK).select("a", "b")


def verified(pairs: DataFrame, texts: DataFrame, percent: int) -> DataFrame:
    """Pairs ``a, b`` whose full shingle sets reach the similarity; ``texts`` is ``id, text``."""
    wanted = pairs.select(F.explode(F.array("a", "b")).alias("id")).distinct()
    # Only texts of a pair are cut into shingles again; keeping all sets would double the corpus.
    sets = texts.join(wanted, "id", "left_semi").select("id", _shingle_sets("text").alias("items"))
    sets = pin(sets, "shingles")
    side = lambda x: sets.select(F.col("id").alias(x), F.col("items").alias(f"i_{x}"))
    common = F.size(F.array_intersect("i_a", "i_b"))
    joined = pairs.join(side("a"), "a").join(side("b"), "b")
    enough = common * 100 >= (F.size("i_a") + F.size("i_b") - common) * percent
    linked = pin(joined.where(enough).select("a", "b"), "verified")
    unpin(sets)
    return linked


def _shared_buckets(classes: DataFrame) -> DataFrame:
    """``id, bucket`` of the buckets that several classes share, from one shuffle of narrow rows.

    A class has one row in each band, so that even a bucket with most of the classes is a small
    share of the rows.
    """
    keyed = classes.select("id", F.explode(_keys("sketch")).alias("bucket")).repartition("bucket")
    shared = keyed.groupBy("bucket").agg(F.count("*").alias("_n")).where("_n > 1").select("bucket")
    return pin(keyed.join(shared.hint("shuffle_hash"), "bucket", "left_semi"), "buckets")


def _stars(buckets: DataFrame) -> DataFrame:
    """Each class of a bucket with the smallest one."""
    heads = buckets.groupBy("bucket").agg(F.min("id").alias("a"), F.max("id").alias("_most"))
    heads = heads.where(F.col("a") < F.col("_most")).drop("_most")
    return buckets.join(heads, "bucket").where(F.col("id") > F.col("a")).select("a", F.col("id").alias("b"))


def _open_buckets(buckets: DataFrame, found: DataFrame) -> DataFrame:
    """Rows of buckets with several components: ``bucket, id, component, minor, n_all, n_minor``.

    ``minor`` marks classes outside the largest component of the bucket.
    """
    labelled = buckets.join(found.withColumnRenamed("node", "id"), "id", "left").select(
        "bucket", "id", F.coalesce("component", "id").alias("component")
    )
    sizes = labelled.groupBy("bucket", "component").agg(F.count("*").alias("n"))
    per = sizes.groupBy("bucket").agg(
        F.sum("n").alias("n_all"), F.max(F.struct("n", "component")).alias("_largest"), F.count("*").alias("_parts")
    )
    per = per.where("_parts > 1").select(
        "bucket", "n_all", F.col("_largest.component").alias("_main"), (F.col("n_all") - F.col("_largest.n")).alias("n_minor")
    )
    return labelled.join(per, "bucket").select(
        "bucket", "id", "component", (F.col("component") != F.col("_main")).alias("minor"), "n_all", "n_minor"
    )


def _cross_small(rows: DataFrame) -> DataFrame:
    some = rows.where("n_all <= %d" % SMALL_BUCKET)
    left = some.where("minor").select("bucket", F.col("id").alias("x"), F.col("component").alias("cx"))
    right = some.select("bucket", F.col("id").alias("y"), F.col("component").alias("cy"))
    met = left.join(right, "bucket").where("cx != cy")
    return met.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"))


class _Block:
    """Components, set sizes and sketches of one block's classes."""

    def __init__(self, rows: pa.Table):
        self.ids, self.parts, self.sizes = (rows.column(c).to_numpy() for c in ("id", "component", "n"))
        self.sketches = _rows(rows.column("sketch"))
        bucket = np.array(rows.column("bucket")[0].as_py(), np.int64)
        self.band = int((band_keys(self.sketches[:1]).view(np.int64)[0] == bucket).argmax())

    def plausible(self, x: dict, percent: int) -> np.ndarray:
        """Places of the classes that may link with the row ``x`` of another component.

        A pair that shares several buckets is left to the one of its first common band; as its
        classes are of two components, that bucket is open and compares it too.
        """
        least = percent / 100 - SLACK
        fits = np.minimum(self.sizes, x["n"]) * 100 >= np.maximum(self.sizes, x["n"]) * percent
        at = np.flatnonzero(fits & (self.parts != x["component"]))
        mine, theirs = np.frombuffer(x["sketch"], np.uint16), self.sketches[at]
        # Far fewer equal registers than the estimate needs: no likelihood has to be worked out.
        equal = theirs == mine
        near = np.flatnonzero(equal.sum(axis=1) >= (least - 0.1) * REGISTERS)
        bands = equal[near, : BANDS * BAND].reshape(-1, BANDS, BAND).all(axis=2)
        near = near[bands.argmax(axis=1) == self.band] if len(near) else near
        at, theirs = at[near], theirs[near]
        if not len(at):
            return at
        mine = np.broadcast_to(mine, theirs.shape)
        sizes = self.sizes[at].astype(float)
        return at[likely_similarity(mine, theirs, np.full(len(at), float(x["n"])), sizes) >= least]


def _block_pairs(rows: DataFrame, extra: list[str]):
    """Minor classes of each bucket against all of its classes, in pairs of bounded blocks."""
    across = F.ceil(F.col("n_all") / BLOCK)
    down = F.ceil(F.col("n_minor") / BLOCK)
    own = lambda parts: F.pmod(F.xxhash64("id"), parts).cast("int")
    every = lambda parts: F.explode(F.sequence(F.lit(0), (parts - 1).cast("int")))
    kept = ["bucket", "id", "component", "n", "sketch", *extra]
    left = rows.where("minor").select(*kept, own(down).alias("_row"), every(across).alias("_col"))
    right = rows.select(*[F.col(c).alias(c) for c in kept], every(down).alias("_row"), own(across).alias("_col"))
    by = ["bucket", "_row", "_col"]
    return left.groupBy(*by).cogroup(right.groupBy(*by))


def _cross_large(rows: DataFrame, classes: DataFrame, texts: DataFrame, percent: int) -> DataFrame:
    """Links between components inside large buckets, one per class and component that it links with.

    A first pass over registers finds the classes that have a plausible partner; their full sets
    then go to the blocks, where plausible pairs are verified. No pairs leave a block but links.
    """
    many = rows.where("n_all > %d" % SMALL_BUCKET).join(classes.select("id", "n", "sketch"), "id")

    def suspects(one: pa.Table, other: pa.Table) -> pa.Table:
        found: set[int] = set()
        if other.num_rows:
            block = _Block(other)
            for x in one.to_pylist():
                at = block.plausible(x, percent)
                if len(at):
                    found.add(x["id"])
                    found.update(block.ids[at].tolist())
        return pa.table({"id": pa.array(sorted(found), pa.int64())})

    named = pin(_block_pairs(many, []).applyInArrow(suspects, "id bigint").distinct(), "suspects")
    sets = texts.join(named, "id", "left_semi").select("id", _shingle_sets("text").alias("items"))
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def compare(one: pa.Table, other: pa.Table) -> pa.Table:
        found: list[tuple[int, int]] = []
        if one.num_rows and other.num_rows:
            block = _Block(other)
            items = other.column("items").combine_chunks()
            known, code = np.unique(items.flatten().to_numpy(), return_inverse=True)
            owner = np.repeat(np.arange(len(items)), np.diff(items.offsets.to_numpy()))
            # Sets stay packed; only the small columns become Python values.
            sets = one.column("items").combine_chunks()
            every, ends = sets.flatten().to_numpy(), sets.offsets.to_numpy() - sets.offsets[0].as_py()
            for k, x in enumerate(one.drop_columns("items").to_pylist()):
                at = block.plausible(x, percent)
                if not len(at):
                    continue
                own = every[ends[k] : ends[k + 1]]
                inside = np.zeros(len(known), bool)
                place = np.minimum(np.searchsorted(known, own), len(known) - 1)
                inside[place[known[place] == own]] = True
                common = np.bincount(owner[inside[code]], minlength=len(items))[at]
                linked = at[common * 100 >= (block.sizes[at] + x["n"] - common) * percent]
                for i in linked[np.unique(block.parts[linked], return_index=True)[1]]:
                    found.append((min(x["id"], int(block.ids[i])), max(x["id"], int(block.ids[i]))))
        pairs = np.array(found, np.int64).reshape(-1, 2)
        return pa.Table.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], schema=schema)

    full = many.join(pin(sets, "shingles"), "id")
    return _block_pairs(full, ["items"]).applyInArrow(compare, "a bigint, b bigint").distinct()


def links(made: DataFrame, texts: DataFrame, percent: int) -> tuple[DataFrame, DataFrame, DataFrame | None]:
    """``(classes, components of their nodes, repeated ids or None)`` for pinned ``sketches`` and ``id, text``.

    The node of a class is its smallest id, or a hash of its digest if several rows have that
    id, whose texts may differ. The classes of one id are of one component.
    """
    named = made.where(F.col("id").isNotNull())
    some = named.where(F.col("digest").isNotNull())
    repeated = pin(named.groupBy("id").agg(F.count("*").alias("n")).where("n > 1").select("id"), "repeated")
    classes = some.groupBy("digest").agg(F.min("id").alias("head"))
    if repeated.isEmpty():
        repeated = None
        classes = classes.withColumn("node", F.col("head"))
    else:
        again = repeated.select(F.col("id").alias("head"), F.lit(True).alias("_again"))
        node = F.when(F.col("_again"), F.xxhash64("digest")).otherwise(F.col("head"))
        classes = pin(classes.join(again, "head", "left").select("digest", "head", node.alias("node")), "heads")
    heads = classes.select(F.col("head").alias("id"), "digest", "node")
    if repeated is not None:
        # One text per class, under the node; the rows of a repeated id match no node.
        own = texts.join(repeated, "id", "left_semi").withColumn("digest", _digests("text"))
        own = own.join(heads, ["id", "digest"]).select(F.col("node").alias("id"), "text").dropDuplicates(["id"])
        texts = texts.unionByName(pin(own, "again"))
    unique = some.join(heads, ["id", "digest"]).select(F.col("node").alias("id"), F.col("n_shingles").alias("n"), "sketch")
    unique = pin(unique.dropDuplicates(["id"]), "classes")
    buckets = _shared_buckets(unique)
    stars = pin(_plausible(_stars(buckets), unique, percent), "stars")
    found = components(verified(stars, texts, percent))
    rows = _open_buckets(buckets, found).where("n_all <= %d" % SMALL_BUCKET)
    small = pin(_plausible(_cross_small(rows), unique, percent), "crossing")
    found = components(verified(small, texts, percent), found)
    rows = pin(_open_buckets(buckets, found).where("n_all > %d" % SMALL_BUCKET), "open")
    for read in (stars, small, buckets):
        unpin(read)
    found = components(pin(_cross_large(rows, unique, texts, percent), "crossing"), found)
    if repeated is not None:
        of = some.join(repeated, "id", "left_semi").join(classes.select("digest", "node"), "digest").select("id", "node")
        found = joined_by_id(of, found)
    return classes, found, repeated


def near_duplicates(df: DataFrame, key: str = "doc_id", text: str = "text", percent: int = 75) -> DataFrame:
    """``key, n_shingles, component_id, kept`` of every row of ``df``.

    ``component_id`` is the smallest id reachable over links of at least ``percent`` per cent
    Jaccard similarity, ``kept`` marks the document whose id that is.
    """
    spark = df.sparkSession
    path = fresh_path(spark, "near-duplicates")
    with scratch(spark):
        found = _labelled(df, key, text, percent)
        found.write.parquet(path)
    return spark.read.schema(found.schema).parquet(path)


def _labelled(df: DataFrame, key: str, text: str, percent: int) -> DataFrame:
    made = pin(sketches(df, key, text), "sketches")
    texts = df.select(F.col(key).cast("bigint").alias("id"), F.col(text).cast("string").alias("text")).where("id IS NOT NULL")
    classes, linked, repeated = links(made, texts, percent)
    head = classes.join(linked, "node", "left").select("digest", "head", F.coalesce("component", "node").alias("component"))
    if repeated is not None:
        head = named_by_id(head, "digest")
    labelled = made.select("id", "n_shingles", "digest").join(head.select("digest", "component"), "digest", "left")
    if repeated is not None:
        labelled = same_by_id(labelled, repeated)
    component = F.when(F.col("id").isNotNull(), F.coalesce("component", "id"))
    return labelled.select(
        F.col("id").alias(key),
        "n_shingles",
        component.alias("component_id"),
        F.coalesce(F.col("id") == component, F.lit(True)).alias("kept"),
    )
