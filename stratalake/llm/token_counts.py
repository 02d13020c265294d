"""Token counts of whole texts by a two-tier lookup inside the map task.

First a pass over all texts finds frequent pre-tokens of at most ``LONGEST`` characters: each
task keeps a summary that is bounded in entries and bytes, the summaries are merged in a tree, and the token counts of the most frequent pre-tokens are
broadcast as a compact table (at most ``FREQUENT`` entries, whatever the data). The counting
pass looks every pre-token up in that table; a miss is encoded by the library and kept in the
worker's cache. Only the summaries are shuffled, at most ``FREQUENT`` pre-tokens each. What the table holds changes the speed only.

Defined results: a NULL text counts as empty, with 0 bytes and 0 tokens. Rows are mapped one
by one, so ties, repeated rows and empty tables need no rule; an empty table gives an empty
result. Only the named columns are read, others may have any name.
"""

from __future__ import annotations

import heapq
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stratalake.llm.pretokens import PreTokenizer, to_byte_chars
from stratalake.llm.workers import file_bytes, per_worker

FREQUENT = 1 << 16  # entries of the broadcast table
SUMMARY = 1 << 18  # counters a task keeps; beyond them the rarer half is let go
CACHE_ENTRIES = 1 << 18  # misses a worker keeps; a full cache is emptied
LONGEST = 64  # characters of a pre-token that is worth keeping


_SUMMARY = pa.schema([("words", pa.list_(pa.string())), ("counts", pa.list_(pa.int64()))])


def _most(counts: Counter, n: int) -> dict[str, int]:
    if len(counts) <= n:
        return dict(counts)
    return dict(heapq.nlargest(n, counts.items(), key=lambda e: (e[1], e[0])))


def _merge(one: dict[str, int], other: dict[str, int]) -> dict[str, int]:
    return _most(Counter(one) + Counter(other), FREQUENT)


def frequent_lengths(spark: SparkSession, df: DataFrame, path: str, text: str = "text") -> tuple[str, bytes]:
    """The compact table: pre-tokens joined by line feeds, and one byte each with their token count."""
    source = file_bytes(spark, path)

    def summary(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pre = per_worker(("pre", len(source.value), path), lambda: PreTokenizer(source.value))
        counts: Counter = Counter()
        for batch in batches:
            for whole in batch.column(0).to_pylist():
                for _, words in pre.pieces(whole or ""):
                    counts.update([w for w in words if len(w) <= LONGEST])
                if len(counts) > SUMMARY:
                    counts = Counter(_most(counts, SUMMARY // 2))
        kept = _most(counts, FREQUENT)
        yield pa.RecordBatch.from_pydict({"words": [list(kept)], "counts": [list(kept.values())]}, schema=_SUMMARY)

    summaries = df.select(F.col(text)).mapInArrow(summary, "words array<string>, counts array<bigint>")
    merged = summaries.rdd.treeAggregate({}, lambda m, row: _merge(m, dict(zip(*row, strict=True))), _merge, depth=3)
    pre = PreTokenizer(source.value)
    words, lengths = [], bytearray()
    for word in sorted(merged):
        n = len(pre.library.model.tokenize(to_byte_chars(word)))
        if n < 256:
            words.append(word)
            lengths.append(n)
    return "\n".join(words), bytes(lengths)


class Lengths(dict):
    """Token count by pre-token: the broadcast tier, then what this worker has encoded."""

    def __init__(self, source: bytes, table: tuple[str, bytes]):
        super().__init__()
        self.pre = PreTokenizer(source)
        self.table = table
        self.refill()

    def refill(self) -> None:
        self.clear()
        words, lengths = self.table
        self.update(zip(words.split("\n") if words else [], lengths, strict=True))

    def __missing__(self, word: str) -> int:
        n = len(self.pre.library.model.tokenize(to_byte_chars(word)))
        if len(word) <= LONGEST:
            self[word] = n
        return n

    def count(self, text: str | None) -> int:
        if len(self) > FREQUENT + CACHE_ENTRIES:
            self.refill()
        return sum(
            1 if special is not None else sum(map(self.__getitem__, words))
            for special, words in self.pre.pieces(text or "")
        )


def token_count(spark: SparkSession, df: DataFrame, path: str, text: str = "text") -> Column:
    """Column with the token count of ``text``; runs the pass for the frequent pre-tokens."""
    source = file_bytes(spark, path)
    table = spark.sparkContext.broadcast(frequent_lengths(spark, df, path, text))

    @F.arrow_udf("bigint")
    def count_texts(texts: pa.Array) -> pa.Array:
        lengths = per_worker(("lengths", table.value[0]), lambda: Lengths(source.value, table.value))
        return pa.array([lengths.count(t) for t in texts.to_pylist()], pa.int64())

    return count_texts(F.col(text))


def count_tokens(spark: SparkSession, df: DataFrame, path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key, n_bytes, n_tokens`` of every row of ``df``."""
    size = F.coalesce(F.octet_length(text), F.lit(0)).cast("bigint")
    return df.select(F.col(key), size.alias("n_bytes"), token_count(spark, df, path, text).alias("n_tokens"))
