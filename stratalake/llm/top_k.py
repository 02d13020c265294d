"""Exact top-k search by inner product: every query against every row, in blocks.

Vectors are sparse rows of integer weights per term (component). Candidates form blocks of
bounded size, queries too, and each pair of blocks is one group of one task. There the
candidates become posting lists, one per term; a block of queries goes through them term by
term and scatters its weight times the posted weights into a dense array of scores. The k
best of each query are selected by partition, and the selections of all blocks are merged.

The work is queries times rows, as any exhaustive search; moved are each row once per block of
queries and each query once per block of rows.

Defined results: vectors that are NULL, empty or hold NULL or non-finite components, and rows
without an id, take no part. Rows with the id of the query are the query's own. Equal scores
rank by the smaller id; repeated candidate rows rank one after the other, a repeated query row
is answered once. Vectors of unequal length are compared over their common components. Scores
beyond the range of a long are held at its limits. Fewer than k candidates give fewer rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stratalake.llm.vectors import usable

ROWS = 8192  # candidates of a block
QUERIES = 1024  # queries of a block
_LIMIT = float(1 << 62)


def scaled(vector: Column, scale: int = 1024) -> Column:
    """Whole numbers floor(scale * x) of the components, as doubles that hold them exactly."""
    return F.transform(vector, lambda x: F.floor(x.cast("double") * F.lit(float(scale))).cast("double"))


def score_block(queries: list[list[float]], rows: list[list[float]]) -> np.ndarray:
    """Scores of all queries (rows of the result) and candidates, term at a time."""
    terms = max(map(len, [*queries, *rows]), default=0)
    weights = np.zeros((len(queries), terms))
    posted = np.zeros((len(rows), terms))
    for target, source in ((weights, queries), (posted, rows)):
        for i, vector in enumerate(source):
            target[i, : len(vector)] = vector
    bound = np.abs(weights).max(initial=0) * np.abs(posted).max(initial=0) * max(terms, 1)
    exact = np.int64 if bound < _LIMIT else object  # Python's integers where a long could overflow
    whole = np.vectorize(int, otypes=[object]) if exact is object else lambda m: m.astype(np.int64)
    weights, posted = whole(weights) if weights.size else weights, whole(posted) if posted.size else posted
    scores = np.zeros((len(queries), len(rows)), exact)
    for term in range(terms):
        posting = np.flatnonzero(posted[:, term])
        asking = np.flatnonzero(weights[:, term])
        if len(posting) == len(rows) and len(asking) == len(queries):
            scores += np.multiply.outer(weights[:, term], posted[:, term])
        elif len(posting) and len(asking):
            scores[np.ix_(asking, posting)] += np.multiply.outer(weights[asking, term], posted[posting, term])
    if exact is object:
        scores = np.clip(scores, -(1 << 63), (1 << 63) - 1).astype(np.int64)
    return scores


def best(scores: np.ndarray, ids: np.ndarray, own: int, k: int) -> np.ndarray:
    """Places of the k highest scores among other ids, equal scores by the smaller id."""
    at = np.flatnonzero(ids != own)
    if len(at) > k:
        least = np.partition(scores[at], len(at) - k)[len(at) - k]
        at = at[scores[at] >= least]  # all ties of the last place
    return at[np.lexsort((ids[at], -scores[at].astype(object) if len(at) and scores[at].min() == -(1 << 63) else -scores[at]))][:k]


def top_k(queries: DataFrame, rows: DataFrame, k: int = 10, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """``query_id, rank, <key>, score`` for each usable query over all usable ``rows``."""

    def narrow(df: DataFrame) -> DataFrame:
        some = df.where(F.col(key).isNotNull() & usable(F.col(vector)))
        return some.select(F.col(key).cast("bigint").alias("id"), scaled(F.col(vector)).alias("vector"))

    asked, given = narrow(queries).distinct(), narrow(rows)
    across = max(1, -(-given.count() // ROWS))
    down = max(1, -(-asked.count() // QUERIES))
    # Salted by the row's place in its partition too, so that repeated rows spread over blocks.
    place = F.pmod(F.xxhash64("id", F.monotonically_increasing_id()), F.lit(across)).cast("int")
    given = given.withColumn("_col", place).select(
        "id", "vector", "_col", F.explode(F.sequence(F.lit(0), F.lit(down - 1))).alias("_row")
    )
    asked = asked.select(
        F.col("id").alias("query_id"),
        F.col("vector").alias("weights"),
        F.pmod(F.xxhash64("id"), F.lit(down)).cast("int").alias("_row"),
        F.explode(F.sequence(F.lit(0), F.lit(across - 1))).alias("_col"),
    )
    schema = pa.schema([("query_id", pa.int64()), ("copy", pa.int32()), ("id", pa.int64()), ("score", pa.int64())])

    def search(one: pa.Table, other: pa.Table) -> pa.Table:
        found: list[np.ndarray] = []
        ids = other.column("id").to_numpy()
        asking = one.column("query_id").to_numpy()
        if len(ids) and len(asking):
            scores = score_block(one.column("weights").to_pylist(), other.column("vector").to_pylist())
            for i, own in enumerate(asking):
                at = best(scores[i], ids, own, k)
                found.append(np.stack([np.full(len(at), own), np.arange(len(at)), ids[at], scores[i][at]]))
        made = np.concatenate(found, axis=1) if found else np.empty((4, 0), np.int64)
        return pa.Table.from_arrays([pa.array(c).cast(f.type) for c, f in zip(made, schema, strict=True)], schema=schema)

    by = ["_row", "_col"]
    blocks = asked.groupBy(*by).cogroup(given.groupBy(*by))
    found = blocks.applyInArrow(search, "query_id bigint, copy int, id bigint, score bigint")
    # "copy" keeps repeated candidates of one block in a fixed order.
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "id", "copy")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", F.col("rank").cast("int"), F.col("id").alias(key), "score")
