"""Token counts and the BPE codec against the tokenizers library, mixing against its targets."""

import hashlib

import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from stratalake.llm import bpe, mixing, queries, token_counts

PATH = public_tokenizers.path("word_bpe_49k.json")
LIBRARY = Tokenizer.from_file(PATH)
CODEC = bpe.Codec(open(PATH, "rb").read())
TEXTS = [
    None,
    "",
    " \t\n",
    "It's THE 'LL don't 're 12 345",
    "a<|startoftext|>b <|endoftext|><|endoftext|>c<|endof",
    "İstanbul Ⱦ Ɣ ŉ ſ Å Σίσυφος ΣΑΣ",
    "日本語 テスト ٣٤ ½² 😀👍🏽 e\u0301 \u0307",
    "\x85a\xa0b\x1cc\x1d\x00d\u3000e",
    "a" * 20_000,
    "!?" * 5_000,
    "same text",
    "same text",
]


def expected(text):
    return LIBRARY.encode(text or "", add_special_tokens=False).ids


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.characters(exclude_categories=["Cs"]), max_size=40))
def test_codec_on_any_text(text):
    ids = CODEC.encode(text)
    assert ids == expected(text)
    assert CODEC.decode(ids) == LIBRARY.decode(ids, skip_special_tokens=False)


def test_cuts_are_certain():
    """No token of a whole word spans a forced cut."""
    for word in ["euxment", "thlyouble", "x9z", "straße"]:
        ids = CODEC.encode_word(word)
        assert list(ids) == expected(word) or not word.isalpha()
        assert "".join(f for f, _ in CODEC.fragments_of(word)) == bpe.to_byte_chars(word)


@pytest.fixture(scope="module")
def texts(spark):
    rows = [(i, t, "extra") for i, t in enumerate(TEXTS)] + [(None, "no id", None)]
    return spark.createDataFrame(rows, "doc_id long, text string, n_tokens string").repartition(3)


def test_counts_and_round_trip(spark, texts):
    want = {(i, len((t or "").encode()), len(expected(t))) for i, t in enumerate(TEXTS)} | {(None, 5, len(expected("no id")))}
    assert {tuple(r) for r in token_counts.count_tokens(spark, texts, PATH).collect()} == want
    for row in queries.round_trip_digests(spark, texts).collect():
        ids = expected("no id" if row.doc_id is None else TEXTS[row.doc_id])
        decoded = LIBRARY.decode(ids, skip_special_tokens=False)
        assert row.n_tokens == len(ids)
        assert row.ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert row.decoded_sha256 == hashlib.sha256(decoded.encode()).hexdigest()


def test_long_pre_tokens_take_no_room_in_summaries(spark, monkeypatch):
    monkeypatch.setattr(token_counts, "FREQUENT", 2)  # tasks get the value with their function
    rows = [(i, " ".join(chr(97 + n) * (token_counts.LONGEST + 1) for n in range(6)) + " cat" * (i % 2)) for i in range(8)]
    words, lengths = token_counts.frequent_lengths(spark, spark.createDataFrame(rows, "doc_id long, text string").coalesce(1), PATH)
    assert words == "cat" and list(lengths) == [1]


def test_empty_tables(spark, texts):
    none = texts.limit(0)
    assert token_counts.count_tokens(spark, none, PATH).count() == 0
    assert queries.round_trip_digests(spark, none).count() == 0
    assert mixing.mix(spark.createDataFrame([], "doc_id long, text string, source string")).count() == 0


def test_whole_table(spark, small):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{small}/documents.parquet").collect()}
    for row in queries.op1_token_counts(spark, small).collect():
        assert row.n_tokens == len(expected(docs[row.doc_id]))
        assert row.over_limit == (row.n_tokens > 2048)


def test_mix_targets_and_edges(spark):
    sizes = {"a": 1000, "b": 10, "c": 500, None: 300, "": 0}
    rows = [(f"{s}{i}", "w " * 10 if n else None, s, 7, "x") for s, n in sizes.items() for i in range(max(1, n // 10))]
    docs = spark.createDataFrame(rows + rows[:1], "doc_id string, text string, source string, size int, target string")
    mixed = mixing.mix(docs)
    assert mixed.columns == [*docs.columns, "_mix"]
    got = mixed.groupBy("source").agg(
        F.sum("_mix.size").alias("n"), F.max("_mix.target").alias("t"), F.sum(F.col("_mix.size") * F.col("_mix.copies")).alias("k")
    )
    got = {r.source: (r.n, r.t, r.k) for r in got.collect()}
    # Code points: "", a, b, c, NULL weigh 5, 2, 1, 5, 2; b is held at twice its size, the rest shares.
    whole = 1820
    level = (1.5 * whole - 20 - 1000 - 600) / 2  # "", b, c and NULL are capped
    assert got[""] == (0, 0.0, 0) and got["b"][1] == 20 and got["c"][1] == 1000 and got[None][1] == 600
    assert got["a"][1] == pytest.approx(min(2020, 2 * level))
    assert got["b"][2] == 20 and got["c"][2] == 1000 and abs(got["a"][2] - got["a"][1]) < 0.25 * got["a"][1]
    again = {(r.doc_id, r["_mix"].copies) for r in mixing.mix(docs.repartition(5)).collect()}
    assert again == {(r.doc_id, r["_mix"].copies) for r in mixed.collect()}
    assert mixing.emit(mixed).columns == docs.columns
    assert mixing.emit(mixed).count() == mixed.agg(F.sum("_mix.copies")).first()[0]
