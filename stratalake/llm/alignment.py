"""Alignment of two tokenizers over a corpus.

The texts are shuffled by their whole content, so that each distinct text is encoded by both
tokenizers and aligned once, with the number of its copies. Byte offsets where a token of A and a
token of B both end cut a text into groups; the two tokens that end there are linked. Inside a
task, texts are cut at certain borders into pieces that are aligned once per worker. The links
of a task's batches are counted, times the copies, before they are shuffled; counts and measures
then go back to the documents by the digest of their text.

The counts of the ``FREQUENT`` most frequent pairs are sent to every worker (a bounded table); the
links of other pairs meet their counts in a join. Results do not depend on where that bound is.

A is a byte-level BPE of the ``tokenizers`` library, which is given a space and the text; B is a
model of ``sentencepiece``, which adds the space itself. Strings of special tokens inside a text
are text to both.

Defined results: a text that is NULL or empty, or whose token bytes of A or B do not give back the
space and the text (normalised characters, for instance), has no tokens: all numbers are 0 and it
has no groups. Texts are read whole, whatever their length. Documents that repeat a row or an id,
or have no id, each get a row. An empty table gives an empty one. Other columns are not looked at.
"""

from __future__ import annotations

import hashlib
import itertools
import os
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StringType, StructField, StructType
from tokenizers import Tokenizer

from stratalake.llm.pretokens import BYTE_CHARS
from stratalake.llm.workers import file_bytes, per_worker
from stratalake.session import fresh_path, pin, scratch

FREQUENT = 1 << 18
AT_ONCE = 64  # texts aligned together
TOGETHER = 1024  # pieces encoded as one text
KNOWN = 1 << 17  # pieces of text a worker remembers, twice
_BITS = 32  # a pair is one number: the id of A, then that of B in so many bits


class Aligner:
    """Both tokenizers, the bytes of their tokens, and the pieces of text aligned so far.

    Neither tokenizer joins a character that is no white space with a space behind it: A cuts its
    pre-tokens there, and no entry of B has a space behind another character. A text can thus be
    cut before every space between two such characters, and its pieces, which repeat far more
    than texts, are aligned one by one.
    """

    def __init__(self, source_a: bytes, source_b: bytes):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        self.a = Tokenizer.from_str(source_a.decode())
        self.a.encode_special_tokens = True
        self.a.no_truncation()
        self.a.no_padding()
        self.b = sentencepiece.SentencePieceProcessor(model_proto=source_b)
        entries = self.a.get_vocab()
        self.bytes_a = [b""] * (max(entries.values()) + 1)
        added = self.a.get_added_tokens_decoder()
        for entry, i in entries.items():
            self.bytes_a[i] = entry.encode() if i in added else bytes(map(_BYTE_OF.__getitem__, entry))
        self.bytes_b = [self._entry(i) for i in range(self.b.get_piece_size())]
        if any(b" " in entry[1:].lstrip(b" ") for entry in self.bytes_b):
            raise ValueError("an entry of the second tokenizer has a space behind another character")
        self.sizes_a, self.sizes_b = (np.array(list(map(len, t)), np.int64) for t in (self.bytes_a, self.bytes_b))
        self.size = max(len(self.bytes_a), len(self.bytes_b))
        # An id and what follows it: more of its side, the other side, another group, another piece.
        self.numbers = [f"{i}{mark}" for mark in ",|;\n" for i in range(self.size)]
        self.known: dict[str, Piece] = {}
        self.old: dict[str, Piece] = {}

    def _entry(self, i: int) -> bytes:
        piece = self.b.id_to_piece(i)
        return bytes([int(piece[3:5], 16)]) if self.b.is_byte(i) else piece.replace("▁", " ").encode()

    def align(self, texts: list[str]) -> list[tuple[int, int, int, bytes, str]]:
        """Per text: numbers of tokens of A and B and of groups, packed links, groups."""
        cut = [pieces(t) if t else [] for t in texts]
        new = self._learn(set(itertools.chain.from_iterable(cut)))
        done = []
        for parts in cut:
            found = list(map(self.known.__getitem__, parts))
            n_a, n_b, n_groups, links, groups = zip(*found, strict=True) if found else [(0,)] * 5
            if 0 in n_a:  # no text, or one that a tokenizer does not give back
                done.append((0, 0, 0, b"", ""))
            else:
                done.append((sum(n_a), sum(n_b), sum(n_groups), b"".join(links), ";".join(groups)))
        for piece in new:
            if len(piece) > 64:
                del self.known[piece]
        return done

    def _learn(self, wanted: set[str]) -> list[str]:
        """Make every wanted piece known, and return those that were not; the known ones have two generations."""
        if len(self.known) >= KNOWN:
            self.known, self.old = {}, self.known
        missing = wanted.difference(self.known)
        again = missing.intersection(self.old)
        self.known.update((p, self.old[p]) for p in again)
        new = sorted(missing - again)
        # Pieces with plain ends can stand side by side in one text without changing each other.
        odd = [p for p in new if not _plain(p)]
        plain = sorted(set(new).difference(odd)) if odd else new
        runs = [plain[i : i + TOGETHER] for i in range(0, len(plain), TOGETHER)]
        for run in [*runs, *[[p] for p in odd]]:
            self.known.update(zip(run, self._run(run), strict=True))
        return new

    def _run(self, parts: list[str]) -> list[Piece]:
        """Pieces that were encoded as one text, parted again at their ends."""
        text = " ".join(parts)
        whole = b" " + text.encode()
        a = self.a.encode_batch_fast([f" {text}"], add_special_tokens=False)[0].ids
        b = self.b.encode(text, num_threads=1)
        right = b"".join(map(self.bytes_a.__getitem__, a)) == whole and b"".join(map(self.bytes_b.__getitem__, b)) == whole
        if not right and len(parts) == 1:
            return [_NOTHING]
        a, b = np.array(a, np.int64), np.array(b, np.int64)
        ends_a, ends_b = self.sizes_a[a].cumsum(), self.sizes_b[b].cumsum()
        bounds = np.cumsum([1 + len(p.encode()) for p in parts])
        if not right or not (np.isin(bounds, ends_a).all() and np.isin(bounds, ends_b).all()):
            half = len(parts) // 2
            return self._run(parts[:half]) + self._run(parts[half:])
        place = np.searchsorted(ends_b, ends_a)  # both end with the text, so there is always one
        met = ends_b[place] == ends_a
        cut_a, cut_b = np.flatnonzero(met) + 1, place[met] + 1
        links = ((a[cut_a - 1] << _BITS) | b[cut_b - 1]).tobytes()
        n_a, n_b, n_groups = (np.searchsorted(ends, bounds) + 1 for ends in (ends_a, ends_b, ends_a[cut_a - 1]))
        groups = self._groups(a, b, cut_a, cut_b, n_groups)
        counts = [np.diff(n, prepend=0).tolist() for n in (n_a, n_b, n_groups)]
        borders = itertools.pairwise([0, *(8 * n_groups).tolist()])
        return [(x, y, z, links[i:j], g) for x, y, z, (i, j), g in zip(*counts, borders, groups, strict=True)]

    def _groups(self, a: np.ndarray, b: np.ndarray, cut_a: np.ndarray, cut_b: np.ndarray, ends: np.ndarray) -> list[str]:
        """Groups as ``a1,a2|b1;a3|b2,b3``, one text per piece; ``ends`` counts the groups up to each."""
        per_a, per_b = np.diff(cut_a, prepend=0), np.diff(cut_b, prepend=0)
        at_a = np.arange(len(a)) + np.repeat(cut_b - per_b, per_a)
        at_b = np.arange(len(b)) + np.repeat(cut_a, per_b)
        code = np.empty(len(a) + len(b), np.int64)
        code[at_a], code[at_b] = a, b
        code[at_a[cut_a - 1]] += self.size
        last = at_b[cut_b - 1]
        code[last] += 2 * self.size
        code[last[ends - 1]] += self.size
        return "".join(map(self.numbers.__getitem__, code.tolist()))[:-1].split("\n")


# Numbers of tokens of A and B and of groups, packed links, groups as text.
Piece = tuple[int, int, int, bytes, str]
_NOTHING = (0, 0, 0, b"", "")
_BYTE_OF = {c: b for b, c in enumerate(BYTE_CHARS)}
# No white space by Unicode, but by some tables of other libraries; no cut is made beside them.
_DOUBTFUL = frozenset("\u180e\u200b\u2060\ufeff▁")
# A space without plain characters on both sides, or at an end of the text.
_BESIDE = f"\\s{''.join(sorted(_DOUBTFUL))}"
_ODD = re.compile(f" [{_BESIDE}]|[{_BESIDE}] |^[{_BESIDE}]|[{_BESIDE}]\\Z")


def _plain(part: str) -> bool:
    return bool(part) and not (part[0].isspace() or part[-1].isspace() or part[0] in _DOUBTFUL or part[-1] in _DOUBTFUL)


def pieces(text: str) -> list[str]:
    """``text`` cut before the spaces between two characters that are no white space, without those spaces."""
    parts = text.split(" ")
    if _ODD.search(text) is None:
        return parts
    made = [[parts[0]]]
    for before, part in itertools.pairwise(parts):
        edges = before[-1:] + part[:1]
        if before and part and not any([c.isspace() or c in _DOUBTFUL for c in edges]):
            made.append([part])
        else:
            made[-1].append(part)
    return [" ".join(p) for p in made]


def align(spark: SparkSession, df: DataFrame, path_a: str, path_b: str, text: str = "text") -> DataFrame:
    """``df`` with the alignment of its texts.

    ``n_a, n_b`` tokens, ``n_groups``, ``groups`` as ``a1,a2|b1;a3|b2,b3`` and ``links``, the pairs
    of tokens that end together, in text order, each as one number: the id of A, then that of B
    in 32 bits.
    """
    # Files of a few MB, whatever the data.
    sources = file_bytes(spark, path_a), file_bytes(spark, path_b)
    key = ("aligner", *[hashlib.blake2b(s.value).digest() for s in sources])
    added = [(c, LongType()) for c in ("n_a", "n_b", "n_groups")] + [("links", ArrayType(LongType())), ("groups", StringType())]

    def both(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = per_worker(key, lambda: Aligner(*(s.value for s in sources)))
        for batch in batches:
            # Batches are cut so that the results of long texts do not pile up.
            for start in range(0, batch.num_rows, AT_ONCE):
                part = batch.slice(start, AT_ONCE)
                *numbers, links, groups = zip(*aligner.align(part.column(text).to_pylist()), strict=True)
                ends = np.cumsum([0, *map(len, links)]) // 8
                lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.frombuffer(b"".join(links), np.int64)))
                columns = [*[pa.array(n, pa.int64()) for n in numbers], lists, pa.array(groups, pa.string())]
                yield pa.RecordBatch.from_arrays([*part.columns, *columns], names=[*part.schema.names, *[c for c, _ in added]])

    return df.mapInArrow(both, StructType([*df.schema.fields, *[StructField(c, kind) for c, kind in added]]))


def pair_counts(linked: DataFrame) -> DataFrame:
    """``pair, n, best`` of rows with ``copies, links``; ``best`` marks the pairs most frequent for their id of B."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("links")
            pairs, where = np.unique(lists.flatten().to_numpy(), return_inverse=True)
            times = np.repeat(batch.column("copies").to_numpy(), np.diff(lists.offsets.to_numpy()))
            total = np.bincount(where, times, len(pairs)).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(pairs, pa.int64()), pa.array(total)], names=["pair", "n"])

    rows = linked.select("copies", "links").mapInArrow(counted, "pair bigint, n bigint")
    counts = pin(rows.groupBy("pair").agg(F.sum("n").alias("n")), "pairs")
    b = F.col("pair").bitwiseAND(F.lit((1 << _BITS) - 1))
    most = counts.groupBy(b.alias("_b")).agg(F.max("n").alias("_most"))
    marked = counts.withColumn("_b", b).join(most, "_b")
    return marked.select("pair", "n", (F.col("n") == F.col("_most")).alias("best"))


def _looked_up(counts: DataFrame, links_of: Column) -> Column:
    """Struct ``n_best, count_sum, missed`` of lists of pairs; ``missed`` are those outside the sent table."""
    spark = counts.sparkSession
    top = counts.orderBy(F.desc("n"), "pair").limit(FREQUENT).toArrow().sort_by("pair")
    # At most FREQUENT rows, by this limit.
    sent = spark.sparkContext.broadcast(tuple(top.column(c).to_numpy() for c in ("pair", "n", "best")))

    @F.arrow_udf("struct<n_best: bigint, count_sum: bigint, missed: array<bigint>>")
    def look(lists: pa.Array) -> pa.Array:
        pairs, n, best = sent.value
        flat, ends = lists.flatten().to_numpy(), lists.offsets.to_numpy()
        ends = ends - ends[0]
        known = np.zeros(len(flat), bool)
        values = np.zeros((2, len(flat)), np.int64)
        if len(pairs):
            place = np.minimum(np.searchsorted(pairs, flat), len(pairs) - 1)
            known = pairs[place] == flat
            values[0] = known & best[place]
            values[1] = np.where(known, n[place], 0)
        sums = np.concatenate((np.zeros((2, 1), np.int64), values.cumsum(axis=1)), axis=1)
        told = [pa.array(s[ends[1:]] - s[ends[:-1]], pa.int64()) for s in sums]
        missed = np.concatenate(([0], (~known).cumsum()))[ends]
        told.append(pa.ListArray.from_arrays(pa.array(missed, pa.int32()), pa.array(flat[~known], pa.int64())))
        return pa.StructArray.from_arrays(told, ["n_best", "count_sum", "missed"])

    return look(links_of)


def _measured(linked: DataFrame, counts: DataFrame) -> DataFrame:
    """``linked`` without its links, with ``n_links, n_best, count_sum``."""
    rows = linked.withColumn("_found", _looked_up(counts, F.col("links"))).withColumn("n_links", F.size("links").cast("bigint"))
    kept = [c for c in rows.columns if c not in ("links", "copies", "_found")]
    if counts.limit(FREQUENT + 1).count() <= FREQUENT:
        return rows.select(*kept, "_found.n_best", "_found.count_sum")
    rows = pin(rows.drop("links"), "found")
    missed = rows.select("digest", F.explode("_found.missed").alias("pair")).groupBy("digest", "pair").agg(F.count("*").alias("_times"))
    more = missed.join(counts, "pair").groupBy("digest").agg(
        F.sum(F.col("_times") * F.col("best").cast("bigint")).alias("_best"), F.sum(F.col("_times") * F.col("n")).alias("_sum")
    )
    whole = rows.join(more, "digest", "left")
    return whole.select(
        *kept,
        (F.col("_found.n_best") + F.coalesce("_best", F.lit(0))).alias("n_best"),
        (F.col("_found.count_sum") + F.coalesce("_sum", F.lit(0))).alias("count_sum"),
    )


def measures(df: DataFrame, path_a: str, path_b: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256`` of every row of ``df``."""
    spark = df.sparkSession
    path = fresh_path(spark, "alignment")
    with scratch(spark):
        made = _by_document(spark, df.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text")), path_a, path_b)
        made.withColumnRenamed("key", key).write.parquet(path)
    return spark.read.parquet(path)


def _by_document(spark: SparkSession, docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    digest = F.unhex(F.sha2("text", 256)).alias("digest")
    some = docs.where("text IS NOT NULL AND text <> ''")
    classes = some.groupBy("text").agg(F.count("*").alias("copies"))
    aligned = align(spark, classes, path_a, path_b)
    found = F.when(F.col("groups") == "", "").otherwise(F.sha2("groups", 256)).alias("groups_sha256")
    linked = aligned.select(digest, "copies", "n_a", "n_b", "n_groups", "links", found)
    linked = pin(linked, "linked")
    per_text = _measured(linked, pin(pair_counts(linked), "counts"))
    # The documents' side is narrow; a text with very many copies is one row on the other.
    found = some.select("key", digest).join(per_text, "digest", "left").drop("digest")
    numbers = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum")
    empty = docs.where("text IS NULL OR text = ''").select(
        "key", *[F.lit(0).cast("bigint").alias(c) for c in numbers], F.lit("").alias("groups_sha256")
    )
    return found.select(empty.columns).unionByName(empty)
