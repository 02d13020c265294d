"""Toxicity scores by FTRL-proximal logistic regression over hashed n-grams of words.

A text is the set of its words, their stems (first four to seven letters, so that inflected words
count together), word pairs and skip-grams (pairs with one or two words between), hashed to 2^20
slots. Weights are learned by follow-the-regularised-leader: every slot has a rate
of its own, which falls with the gradients it has met, and an L1 penalty keeps a slot at exactly
zero until its gradients agree often enough. What is left is a short list of slots and weights,
which is broadcast; its size is bounded by the slots, not by the table.

Learning reads a bounded sample: of each label the ``TRAIN`` texts with the smallest hashes, and
of these as many, in that order, as have ``TRAIN_FEATURES`` features together (at least one). No
text is too long for it, and a text counts once per label however often it is repeated. Scoring
reads every text whole, so that one insult in 20,000 words counts as much as in ten.

Both labels weigh alike in learning: a score is the chance of label 1 if both were as frequent.

Defined results: NULL and texts without words have no features; their score is that of the bias.
Without labels of both kinds there is nothing to learn and every score is 0. Labels that are NULL,
labels of absent documents and documents without an id teach nothing; a text with both labels
teaches both. Rows are mapped one by one: repeated rows get equal scores, an empty table gives an
empty one, and only the named columns are read, whatever the others are called.
"""

from __future__ import annotations

import re
from functools import cached_property

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType

from stratalake.llm.workers import per_worker

SLOT_BITS = 20
GAPS = (1, 2, 3)  # the second word of a pair is so many words behind the first
STEMS = (4, 5, 6, 7)  # so many first letters of a word count as a word of their own
TRAIN, TRAIN_FEATURES = 4000, 4_000_000  # per label
STEPS, EPOCHS = 40_000, (6, 20)  # few texts are passed over more often
ALPHA, BETA, L1 = 1.5, 1.0, 10.0
THRESHOLD = 0.7

_WORD = re.compile(r"[^\W\d_]+(?:'[^\W\d_]+)*")
_KEPT_WORDS = 1 << 18
_FACTOR = np.random.Generator(np.random.PCG64(11)).integers(0, 1 << 63, 1 + len(GAPS) + len(STEMS), np.uint64) * np.uint64(2) + np.uint64(1)


class _Hashes(dict):
    """Packed hashes of the words a worker met and of their stems; a full table starts anew."""

    def __missing__(self, word: str) -> bytes:
        if len(self) >= _KEPT_WORDS:
            self.clear()
        cut = [word, *[word[:n] for n in STEMS]]
        value = np.array([xxhash.xxh64_intdigest(w.encode("utf-8", "surrogatepass")) for w in cut], np.uint64).tobytes()
        if len(word) <= 64:
            self[word] = value
        return value


def features(text: str | None) -> np.ndarray:
    """The distinct slots of a text, ascending."""
    known = per_worker("word hashes", _Hashes)
    found = _WORD.findall((text or "").lower())
    if not found:
        return np.array([], np.int32)
    own = np.frombuffer(b"".join(map(known.__getitem__, found)), np.uint64).reshape(len(found), -1)
    words = own[:, 0]
    parts = [(own * _FACTOR[: own.shape[1]]).ravel()]
    pair = _FACTOR[own.shape[1] :]
    parts += [(words[:-gap] ^ (words[gap:] >> np.uint64(1))) * times for gap, times in zip(GAPS, pair) if gap < len(words)]
    hashed = np.concatenate(parts)
    hashed = (hashed ^ (hashed >> np.uint64(32))) * _FACTOR[0]
    slots = np.sort((hashed >> np.uint64(64 - SLOT_BITS)).astype(np.int32))
    return slots[np.concatenate(([True], slots[1:] != slots[:-1]))]


class Model:
    """Ascending ``slots`` with non-zero ``weights`` and the bias."""

    def __init__(self, slots: np.ndarray, weights: np.ndarray, bias: float | None):
        self.slots, self.weights, self.bias = slots, weights, bias

    @cached_property
    def dense(self) -> np.ndarray:
        table = np.zeros(1 << SLOT_BITS, np.float32)
        table[self.slots] = self.weights
        return table


def fit(sets: list[np.ndarray], labels: list[int]) -> Model:
    """FTRL-proximal over feature sets in the given order; both labels weigh alike."""
    n_one = sum(labels)
    if not n_one or n_one == len(labels):
        return Model(np.array([], np.int32), np.array([], np.float32), None)
    size = (1 << SLOT_BITS) + 1  # the last coordinate is the bias, without a penalty
    z, n = np.zeros(size), np.zeros(size)
    penalty = np.full(size, L1)
    penalty[-1] = 0.0
    weight = (len(labels) / (2 * (len(labels) - n_one)), len(labels) / (2 * n_one))

    def weights(at: np.ndarray | slice) -> np.ndarray:
        shrunk = np.sign(z[at]) * np.maximum(np.abs(z[at]) - penalty[at], 0)
        return -shrunk * ALPHA / (BETA + np.sqrt(n[at]))

    bias = np.array([size - 1], np.int32)
    sets = [np.concatenate((s, bias)) for s in sets]
    for _ in range(min(max(STEPS // len(sets), EPOCHS[0]), EPOCHS[1])):
        for at, label in zip(sets, labels, strict=True):
            w = weights(at)
            error = weight[label] * (1 / (1 + np.exp(-np.clip(w.sum(), -35, 35))) - label)
            rate = (np.sqrt(n[at] + error * error) - np.sqrt(n[at])) / ALPHA
            z[at] += error - rate * w
            n[at] += error * error
    found = weights(slice(None))
    slots = np.flatnonzero(found[:-1]).astype(np.int32)
    return Model(slots, found[slots].astype(np.float32), float(found[-1]))


@F.arrow_udf(ArrayType(IntegerType()))
def _features(texts: pa.Array) -> pa.Array:
    return pa.array([features(t) for t in texts.to_pylist()], pa.list_(pa.int32()))


def held_out(key: Column, folds: int = 3, fold: int = 1) -> Column:
    """Rows that learning may not see, by the crc32 of the id as text; FALSE without an id."""
    return F.coalesce(F.pmod(F.crc32(key.cast("string").cast("binary")), F.lit(folds)) == fold, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "toxic") -> Model:
    """A model of the labelled rows that are not held out."""
    named = labels.select(F.col(key).alias("_key"), F.col(label).cast("int").alias("_label"))
    named = named.where(F.col("_key").isNotNull() & ~held_out(F.col("_key")) & F.col("_label").isin(0, 1))
    # At most two rows per id, however often a label is repeated.
    named = named.distinct()
    texts = docs.select(F.col(key).alias("_key"), F.col(text).cast("string").alias("_text")).where("_text IS NOT NULL")
    digest = F.xxhash64("_text", F.lit(11)).alias("_digest")
    # One row per label and text: copies must not fill the sample.
    once = texts.select("_key", digest).join(named, "_key").groupBy("_label", "_digest").agg(F.min("_key").alias("_key"))
    first = F.row_number().over(Window.partitionBy("_label").orderBy("_digest"))
    chosen = once.withColumn("_n", first).where(F.col("_n") <= TRAIN)
    rows = texts.withColumn("_digest", digest).join(F.broadcast(chosen), ["_key", "_digest"])
    sets = rows.dropDuplicates(["_label", "_n"]).select("_label", "_n", _features("_text").alias("_set"))
    # Features before the running total, so that no texts are sorted; a set has 2^20 slots at most.
    before = Window.partitionBy("_label").orderBy("_n").rowsBetween(Window.unboundedPreceding, -1)
    total = F.coalesce(F.sum(F.size("_set")).over(before), F.lit(0))
    bounded = sets.withColumn("_before", total).where(F.col("_before") < TRAIN_FEATURES)
    # Some ten million numbers at most, which stay packed. Labels take turns.
    learned = bounded.select("_n", "_label", "_set").toArrow().sort_by([("_n", "ascending"), ("_label", "ascending")])
    column = learned.column("_set").combine_chunks()
    slots = np.split(column.flatten().to_numpy(), np.cumsum(column.value_lengths().to_numpy())[:-1])
    return fit(slots[: learned.num_rows], learned.column("_label").to_pylist())


def predict(df: DataFrame, model: Model, text: str = "text") -> Column:
    """Column of scores from 0 to 1 for ``text`` alone."""
    # At most 2^20 slots and weights, mostly a few thousand.
    sent = df.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf("double")
    def score(texts: pa.Array) -> pa.Array:
        model = sent.value
        if model.bias is None:
            return pa.array(np.zeros(len(texts)))
        table = model.dense
        sums = np.array([table[features(t)].sum(dtype=np.float64) for t in texts.to_pylist()], np.float64)
        return pa.array(1 / (1 + np.exp(-np.clip(sums + model.bias, -700, 700))))

    return score(F.col(text).cast("string"))


def detect(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "toxic") -> DataFrame:
    """``key, held_out, score, predicted`` of every row of ``docs``, by a model of the labelled rows."""
    model = train(docs, labels, key, text, label)
    rows = docs.select(F.col(key), held_out(F.col(key)).alias("held_out"), predict(docs, model, text).alias("score"))
    return rows.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))
