"""Near duplicates of vectors by a forest of random-projection trees.

Vectors are compared within equal labels only. Equal vectors of a label form one class first,
so that a vector with very many copies is one row. The vectors of a label (and length) are one
leaf if they are few. Otherwise ``TREES`` trees are fitted to a bounded sample of the vectors: the
samples of a node are projected on a random direction and cut at the median, until the node has
``LEAF`` vectors by estimate or fewer than ``FEW`` samples. Vectors nearer to the cut than
``SPILL`` standard deviations of what two vectors at the threshold differ by go to both sides, so
such a pair is parted only if it lies on both sides of the overlap, and then all trees would have
to part it. A node whose projections are so narrow that most vectors would go both ways (a group
of near copies) is not split. The cuts are broadcast, every vector goes through all levels of all
trees in one pass and is shuffled once, with the list of its leaves. A leaf may have any size:
larger ones are compared in blocks.

Inside leaves all pairs are compared by exact cosines. A pair that meets in several leaves is
counted in the first of them. Out of a leaf come a count per vector and links to the smallest
vector of each linked group, never the pairs.

Defined results: rows without an id or label, and vectors that are NULL, empty, all zero or
hold NULL or non-finite components link with nothing; so do vectors of unequal length. Repeated
rows are vectors of their own and count as links of each other; rows that share an id are of one
component. Rows without an id get no component and are kept.
"""

from __future__ import annotations

import math
import struct

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType

from stratalake.llm.components import components, joined_by_id, named_by_id, same_by_id
from stratalake.llm.vectors import matrix, usable
from stratalake.session import pin

TREES = 3
LEAF = 2048  # vectors of a leaf that is not split, nor compared in blocks
BLOCK = 1024  # vectors of a block of a larger leaf
SAMPLE, FEW = 1 << 17, 32  # vectors that trees are fitted to, over all labels; samples of a node
SPILL = 1.25
NARROW = 1.5  # a node whose projections deviate by less than so many overlaps is not split
LEVELS = 40


def _child(node: int, side: int) -> int:
    return xxhash.xxh64_intdigest(struct.pack("<qq", node, side)) - (1 << 63)


def _projected(node: int, seed: int, rows: np.ndarray) -> np.ndarray:
    """Unit vectors on the random direction of their node."""
    direction = np.random.default_rng([node & 0xFFFFFFFFFFFFFFFF, seed]).standard_normal(rows.shape[1])
    return rows @ (direction / np.linalg.norm(direction))


class Tree:
    """The cuts of one set of vectors by node; a node without a cut is a leaf."""

    def __init__(self, root: int, overlap: float, seed: int):
        self.root, self.overlap, self.seed = root, overlap, seed
        self.cuts: dict[int, float] = {}

    def fit(self, rows: np.ndarray, each: float) -> None:
        """``each`` sample stands for so many vectors."""
        growing = [(self.root, np.arange(len(rows)), 0)]
        while growing:
            node, at, level = growing.pop()
            if len(at) * each <= LEAF or len(at) < FEW or level == LEVELS:
                continue
            p = _projected(node, self.seed, rows[at])
            if p.std() < self.overlap * NARROW:
                continue
            self.cuts[node] = float(np.median(p))
            growing += [(child, at[inside], level + 1) for child, inside in self._sides(node, p)]

    def _sides(self, node: int, p: np.ndarray) -> list[tuple[int, np.ndarray]]:
        cut = self.cuts[node]
        return [(_child(node, 0), p <= cut + self.overlap), (_child(node, 1), p > cut - self.overlap)]

    def route(self, rows: np.ndarray, found: list[list[int]], place: np.ndarray) -> None:
        """Add the leaves of unit vectors to the lists of their places."""
        going = [(self.root, np.arange(len(rows)))]
        while going:
            node, at = going.pop()
            if node not in self.cuts:
                for i in place[at].tolist():
                    found[i].append(node)
                continue
            p = _projected(node, self.seed, rows[at])
            going += [(child, at[inside]) for child, inside in self._sides(node, p) if inside.any()]


def _units(vectors: pa.Array) -> np.ndarray:
    rows = matrix(vectors, np.float64)
    return rows / np.linalg.norm(rows, axis=1)[:, None]


def _fitted(classes: DataFrame, threshold: float, trees: int, seed: int) -> dict[tuple[str, int], list[Tree]]:
    """Trees of every label and length with more than ``LEAF`` vectors."""
    by = [F.col("label"), F.size("vector").alias("dims")]
    sizes = classes.groupBy(*by).agg(F.count("*").alias("n")).where(F.col("n") > LEAF)
    large = pin(sizes, "sizes")
    total = large.agg(F.sum("n")).first()[0]
    if total is None:
        return {}
    # By a hash of the vector's id, so that a repeated run draws the same; the limit is the bound.
    share = min(1.0, 1.1 * SAMPLE / total)
    drawn = F.pmod(F.xxhash64("id", F.lit(seed)), F.lit(1 << 30)) < F.lit(int(share * (1 << 30)))
    some = classes.where(drawn).select(*by, "vector", "id").join(large, ["label", "dims"])
    rows = some.orderBy(F.xxhash64("id", F.lit(seed)), "id").limit(SAMPLE).select("label", "dims", "n", "vector").toArrow()
    found: dict[tuple[str, int], list[Tree]] = {}
    names = list(zip(rows.column("label").to_pylist(), rows.column("dims").to_pylist(), strict=True))
    members: dict[tuple[str, int], list[int]] = {}
    for i, name in enumerate(names):
        members.setdefault(name, []).append(i)
    vectors, counts = rows.column("vector").combine_chunks(), rows.column("n").to_numpy()
    for (label, dims), at in members.items():
        units = _units(vectors.take(pa.array(at)))
        overlap = SPILL * math.sqrt(max(0.0, 2 - 2 * threshold) / dims)
        found[label, dims] = []
        for n in range(trees):
            tree = Tree(_root(label, dims, n), overlap, seed)
            tree.fit(units, counts[at[0]] / len(at))
            found[label, dims].append(tree)
    return found


def _root(label: str, dims: int, n: int) -> int:
    return xxhash.xxh64_intdigest(f"{dims} {n} {label}".encode("utf-8", "surrogatepass")) - (1 << 63)


def forest(classes: DataFrame, threshold: float, trees: int = TREES, seed: int = 9) -> DataFrame:
    """Classes ``id, label, copies, vector`` with ``leaves``, the ascending list of a vector's leaves."""
    fitted = _fitted(classes, threshold, trees, seed)
    # At most SAMPLE / FEW cuts or so for each tree.
    sent = classes.sparkSession.sparkContext.broadcast(fitted)

    @F.arrow_udf(ArrayType(LongType()))
    def route(labels: pa.Array, vectors: pa.Array) -> pa.Array:
        known = sent.value
        found: list[list[int]] = [[] for _ in range(len(labels))]
        names = list(zip(labels.to_pylist(), np.diff(vectors.offsets.to_numpy()).tolist(), strict=True))
        members: dict[tuple[str, int], list[int]] = {}
        for i, name in enumerate(names):
            if name in known:
                members.setdefault(name, []).append(i)
            else:
                found[i].append(_root(*name, 0))
        for name, at in members.items():
            units, place = _units(vectors.take(pa.array(at))), np.array(at)
            for tree in known[name]:
                tree.route(units, found, place)
        return pa.array([sorted(f) for f in found], pa.list_(pa.int64()))

    return classes.select("id", "copies", "vector", route("label", "vector").alias("leaves"))


def _first_meeting(node: int, one: list[list[int]], other: list[list[int]]) -> np.ndarray:
    """For each pair whether ``node`` is the smallest leaf that both are in."""
    earlier = sorted({x for leaves in (*one, *other) for x in leaves if x < node})
    place = {x: i for i, x in enumerate(earlier)}

    def members(rows: list[list[int]]) -> np.ndarray:
        inside = np.zeros((len(rows), len(earlier)), np.float32)
        for i, leaves in enumerate(rows):
            inside[i, [place[x] for x in leaves if x < node]] = 1
        return inside

    return members(one) @ members(other).T == 0


def _smallest_linked(link: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """Per vector the smallest id that it reaches inside the block."""
    label = ids.copy()
    top = np.iinfo(np.int64).max
    while True:
        lower = np.minimum(label, np.where(link, label[None, :], top).min(axis=1, initial=top))
        if (lower == label).all():
            return label
        label = lower


def compare_block(rows: pa.Table, threshold: float) -> pa.Table:
    """``id, other, n`` of one pair of blocks of a leaf.

    Rows have ``node, id, vector, copies, leaves, block`` and the pair ``_low, _high``. A row
    with ``other`` links two vectors, a row without it adds ``n`` to the links of ``id``.
    """
    ids = rows.column("id").to_numpy()
    order = np.argsort(ids)  # floating-point results do not depend on the order of arrival
    rows, ids = rows.take(pa.array(order)), ids[order]
    raw = matrix(rows.column("vector"), np.float64)
    length = np.linalg.norm(raw, axis=1)
    link = (raw @ raw.T) / np.outer(length, length) >= threshold
    np.fill_diagonal(link, False)
    low, high = rows.column("_low")[0].as_py(), rows.column("_high")[0].as_py()
    block = rows.column("block").to_numpy()
    if low != high:  # pairs inside one block belong to the group of that block
        link &= block[:, None] != block[None, :]
    at = np.flatnonzero(link.any(axis=1))
    ids, link = ids[at], link[np.ix_(at, at)]
    if not len(at):
        return pa.Table.from_arrays([pa.array([], f.type) for f in _FOUND], schema=_FOUND)
    leaves = rows.column("leaves").take(pa.array(at)).to_pylist()
    copies = rows.column("copies").to_numpy()[at]
    counted = link & _first_meeting(rows.column("node")[0].as_py(), leaves, leaves)
    label = _smallest_linked(link, ids)
    below = np.flatnonzero(label != ids)
    n = (counted.astype(np.float64) @ copies.astype(np.float64)).astype(np.int64)  # exact below 2^53
    return pa.Table.from_arrays(
        [
            pa.array(np.concatenate([ids, ids[below]])),
            pa.array([None] * len(ids) + label[below].tolist(), pa.int64()),
            pa.array(np.concatenate([n, np.zeros(len(below), np.int64)])),
        ],
        schema=_FOUND,
    )


_FOUND = pa.schema([("id", pa.int64()), ("other", pa.int64()), ("n", pa.int64())])


def _links(classes: DataFrame, threshold: float, trees: int) -> DataFrame:
    routed = pin(forest(classes, threshold, trees), "routed")
    sizes = routed.select(F.explode("leaves").alias("node")).groupBy("node").agg(F.count("*").alias("_n")).where("_n > 1")
    blocks = F.when(F.col("_n") > LEAF, F.ceil(F.col("_n") / BLOCK)).otherwise(1).cast("int")
    sizes = sizes.select("node", blocks.alias("_blocks"))
    rows = routed.withColumn("node", F.explode("leaves")).join(sizes, "node")
    rows = rows.withColumn("block", F.pmod(F.xxhash64("id"), F.col("_blocks")).cast("int"))
    rows = rows.withColumn("_with", F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1)))
    rows = rows.withColumns({"_low": F.least("block", "_with"), "_high": F.greatest("block", "_with")})
    return rows.groupBy("node", "_low", "_high").applyInArrow(
        lambda group: compare_block(group, threshold), "id bigint, other bigint, n bigint"
    )


def vector_duplicates(
    df: DataFrame,
    key: str = "vec_id",
    vector: str = "embedding",
    label: str = "label",
    threshold: float = 0.93,
    trees: int = TREES,
) -> DataFrame:
    """``key, n_links, component_id, kept`` of every row of ``df``."""
    rows = df.select(
        F.col(key).cast("bigint").alias("id"), F.col(label).cast("string").alias("label"), F.col(vector).alias("vector")
    )
    nonzero = F.exists("vector", lambda x: x != 0)
    takes_part = F.col("id").isNotNull() & F.col("label").isNotNull() & usable(F.col("vector")) & F.coalesce(nonzero, F.lit(False))
    rows = rows.select("id", "label", F.when(takes_part, F.col("vector")).alias("vector"))
    repeated = pin(rows.where("id IS NOT NULL").groupBy("id").agg(F.count("*").alias("n")).where("n > 1").select("id"), "repeated")
    several = not repeated.isEmpty()
    classes = rows.where(F.col("vector").isNotNull()).groupBy("label", "vector")
    classes = classes.agg(F.min("id").alias("head"), F.count("*").alias("copies"))
    if several:
        # An id of several rows may stand for several vectors, so it cannot name a class.
        again = repeated.select(F.col("id").alias("head"), F.lit(True).alias("_again"))
        node = F.when(F.col("_again"), F.xxhash64("label", "vector")).otherwise(F.col("head"))
        classes = classes.join(again, "head", "left").select("label", "vector", "head", node.alias("id"), "copies")
    else:
        classes = classes.withColumn("id", F.col("head"))
    classes = pin(classes, "classes")
    found = pin(_links(classes.drop("head"), threshold, trees), "found")
    linked = components(found.where("other IS NOT NULL").select(F.col("id").alias("a"), F.col("other").alias("b")))
    if several:
        some = rows.where(F.col("vector").isNotNull()).join(repeated, "id", "left_semi")
        of = some.join(classes.select("label", "vector", F.col("id").alias("node")), ["label", "vector"])
        linked = joined_by_id(of, linked)
    counts = found.groupBy("id").agg(F.sum("n").alias("n"))
    known = (
        classes.join(counts, "id", "left")
        .join(linked.withColumnRenamed("node", "id"), "id", "left")
        .select(
            "label",
            "vector",
            "head",
            (F.col("copies") - 1 + F.coalesce("n", F.lit(0))).alias("n_links"),
            F.coalesce("component", "id").alias("component"),
        )
    )
    if several:
        known = named_by_id(known, "label", "vector", "n_links")
    out = rows.join(known, ["label", "vector"], "left")
    if several:
        out = same_by_id(out, repeated)
    component = F.coalesce("component", "id")
    return out.select(
        F.col("id").alias(key),
        F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"),
        component.alias("component_id"),
        F.coalesce(F.col("id") == component, F.lit(True)).alias("kept"),
    )
