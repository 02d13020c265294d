"""BPE encoding and decoding with forced boundaries.

Two neighbouring symbols that stand side by side inside no vocabulary entry can never end up
in one token, whatever the order of merges: every merge result is an entry. Such a pair is a
certain cut. A pre-token is cut there, its fragments are encoded independently (and once per
worker, as fragments repeat far more than words) and the ids are concatenated.

Results equal the ``tokenizers`` library for files of this kind: byte-level BPE with an
end-of-word mark, special strings inside texts taken as special tokens, nothing added.

Defined results: a NULL text is an empty text, and an empty text has no ids; the decoded text
of no ids is empty. Rows are mapped one by one, so ties, repeated rows and empty tables need
no rule. Other columns are not looked at.
"""

from __future__ import annotations

import itertools
import json

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from tokenizers.models import BPE

from stratalake.llm.pretokens import PreTokenizer, to_byte_chars
from stratalake.llm.workers import file_bytes, per_worker

# Entries of a worker's caches; results do not depend on them.
CACHE_ENTRIES = 1 << 17


class Codec:
    """Encoder and decoder of one tokenizer file."""

    def __init__(self, source: bytes):
        model = json.loads(source)["model"]
        self.pre = PreTokenizer(source)
        self.mark = model["end_of_word_suffix"] or ""
        vocab: dict[str, int] = model["vocab"]
        self.text_of = {i: t for t, i in vocab.items()} | {i: t for t, i in self.pre.special.items()}
        self.joined = {p for token in vocab for p in itertools.pairwise(self._symbols_of(token))}
        merges = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]]
        # A fragment inside a word has no end mark, the last one has it.
        self.inner = BPE(vocab=vocab, merges=merges)
        self.last = BPE(vocab=vocab, merges=merges, end_of_word_suffix=self.mark or None)
        self.fragments: dict[tuple[str, bool], tuple[int, ...]] = {}
        self.words = _Words(self)

    def _symbols_of(self, token: str) -> list[str]:
        """The bytes of a vocabulary entry, the last one with the end mark if it has it."""
        ends = bool(self.mark) and token.endswith(self.mark) and token != self.mark
        symbols = list(token[: -len(self.mark)] if ends else token)
        if ends:
            symbols[-1] += self.mark
        return symbols

    def fragments_of(self, word: str) -> list[tuple[str, bool]]:
        """A pre-token in byte characters, cut at every pair that no entry contains; is it the last."""
        mapped = to_byte_chars(word)
        symbols = [*mapped[:-1], mapped[-1] + self.mark]
        cuts = [i for i, pair in enumerate(itertools.pairwise(symbols), 1) if pair not in self.joined]
        return [(mapped[a:b], b == len(mapped)) for a, b in itertools.pairwise([0, *cuts, len(mapped)])]

    def merge(self, fragment: str, last: bool) -> tuple[int, ...]:
        """Ids of one fragment by itself."""
        return tuple([t.id for t in (self.last if last else self.inner).tokenize(fragment)])

    def encode_word(self, word: str) -> tuple[int, ...]:
        ids: list[int] = []
        for fragment in self.fragments_of(word):
            known = self.fragments.get(fragment)
            if known is None:
                if len(self.fragments) >= CACHE_ENTRIES:
                    self.fragments.clear()
                known = self.fragments[fragment] = self.merge(*fragment)
            ids.extend(known)
        return tuple(ids)

    def encode_packed(self, text: str | None) -> bytes:
        """Ids of a text as 32-bit integers, one after the other."""
        if not text:
            return b""
        self.words.turn()
        return b"".join(
            [
                np.int32(special).tobytes() if special is not None else b"".join(map(self.words.__getitem__, words))
                for special, words in self.pre.pieces(text)
            ]
        )

    def encode(self, text: str | None) -> list[int]:
        return np.frombuffer(self.encode_packed(text), np.int32).tolist()

    def decode(self, ids: list[int]) -> str:
        """Text of ids; without a decoder in the file the library joins tokens by one space.

        Ids that are NULL or not in the vocabulary are left out, as the library does.
        """
        try:
            return " ".join(map(self.text_of.__getitem__, ids))
        except KeyError:
            return " ".join([self.text_of[i] for i in ids if i in self.text_of])


class _Words(dict):
    """Packed ids by pre-token; long pre-tokens are encoded without being kept.

    A full cache becomes the old one, from which words that are met again come back.
    """

    def __init__(self, codec: Codec):
        super().__init__()
        self.codec = codec
        self.old: dict[str, bytes] = {}

    def turn(self) -> None:
        if len(self) >= CACHE_ENTRIES:
            self.old = dict(self)
            self.clear()

    def __missing__(self, word: str) -> bytes:
        ids = self.old.get(word)
        if ids is None:
            ids = np.array(self.codec.encode_word(word), np.int32).tobytes()
        if len(word) <= 64:
            self[word] = ids
        return ids


def encode(spark: SparkSession, path: str, text: Column) -> Column:
    """Column of ids (``array<int>``) of whole texts."""
    # A vocabulary file is a few MB, whatever the data.
    source = file_bytes(spark, path)

    @F.arrow_udf("array<int>")
    def encode_texts(texts: pa.Array) -> pa.Array:
        codec = per_worker(("codec", source.value[:64], len(source.value)), lambda: Codec(source.value))
        packed = [codec.encode_packed(t) for t in texts.to_pylist()]
        ends = np.cumsum([0, *map(len, packed)]) // 4
        flat = np.frombuffer(b"".join(packed), np.int32)
        return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat, pa.int32()))

    return encode_texts(text)


def decode(spark: SparkSession, path: str, ids: Column) -> Column:
    """Column of texts of an ``array<int>`` column; NULL stays NULL."""
    source = file_bytes(spark, path)

    @F.arrow_udf("string")
    def decode_ids(lists: pa.Array) -> pa.Array:
        codec = per_worker(("codec", source.value[:64], len(source.value)), lambda: Codec(source.value))
        ends = lists.offsets.to_numpy()
        ids = lists.values.to_numpy(zero_copy_only=False)  # NULL ids make the values floats, which decode skips
        ids = np.nan_to_num(ids, nan=-1).astype(np.int64) if ids.dtype.kind == "f" else ids
        texts = [codec.decode(ids[a:b].tolist()) for a, b in itertools.pairwise(ends)]
        return pa.array(texts, pa.string(), mask=lists.is_null().to_numpy(zero_copy_only=False))

    return decode_ids(ids)


def round_trip(spark: SparkSession, df: DataFrame, path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key, ids, decoded`` of every row of ``df``."""
    encoded = df.select(F.col(key), encode(spark, path, F.col(text)).alias("ids"))
    return encoded.select(F.col(key), "ids", decode(spark, path, F.col("ids")).alias("decoded"))
