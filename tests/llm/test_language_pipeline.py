"""Held-out accuracy of the language model, and the pipeline against its stages by hand."""

import random
import zlib

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from stratalake.llm import language, near_duplicates, queries
from tests.llm.test_duplicates import brute

ROWS = [
    (1, "the cat and the dog are here with the bird", "en"),
    (2, "der hund und die katze sind hier mit dem vogel", "de"),
    (None, "the house and the garden", "en"),
    (4, None, "en"),
    (5, "", None),
    (6, "123 !!", "de"),
    (7, "the cat and the dog are here with the bird", "en"),
    (7, "the cat and the dog are here with the bird", "en"),
]


@pytest.fixture(scope="module")
def docs(spark):
    words = {"en": "the and with house garden bird water light".split(), "de": "der und mit haus garten vogel wasser licht".split()}
    rows = list(ROWS)
    for i in range(100, 400):
        lang = ("en", "de")[i % 2]
        rows.append((i, " ".join(words[lang][(i * 7 + j * j) % 8] + str(i * j) for j in range(30)), lang))
    rows = [(*r, f"s{n % 4}" if n % 5 else None, n, "clash") for n, r in enumerate(rows)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, lang_pred string").repartition(3)


def test_held_out_accuracy(spark, middle):
    truth = {r.doc_id: r for r in spark.read.parquet(f"{middle}/documents.parquet").collect()}
    got = queries.op4_language_id(spark, middle).collect()
    assert len(got) == len(truth)
    hidden = [r for r in got if r.held_out]
    assert {r.doc_id for r in hidden} == {i for i in truth if zlib.crc32(str(i).encode()) % 4 == 2}
    assert sum(r.lang_pred == truth[r.doc_id].lang for r in hidden) >= 0.98 * len(hidden)
    assert all(0 <= r.score <= 1 for r in got)


def test_language_cases(spark, docs):
    got = [(r.doc_id, r.held_out, r.lang_pred, r.score) for r in language.identify(docs).collect()]
    told = {r[0]: r for r in got}
    assert told[4][2:] == told[5][2:] == told[6][2:] == ("und", 0.0)
    assert told[1][2] == told[None][2] == "en" and told[2][2] == "de" and told[None][1] is False
    unlabelled = docs.withColumn("lang", F.lit(None).cast("string"))
    assert {r.lang_pred for r in language.identify(unlabelled).collect()} == {"und"}
    assert language.identify(docs.limit(0)).count() == 0


def test_languages_in_long_texts_only(spark, docs):
    words = "il gatto e la casa con uccello acqua luce giardino".split()
    more = [(i, "1 " * 9000 + " ".join(words[(i * 7 + j * j) % 10] for j in range(4500)), "it") for i in range(1000, 1012)]
    more = spark.createDataFrame(more, "doc_id long, text string, lang string")
    assert more.where(F.length("text") <= language.TRAIN_CHARS).isEmpty()
    got = language.identify(docs.select("doc_id", "text", "lang").unionByName(more)).collect()
    assert all((r.lang_pred == "it") == (r.doc_id >= 1000) for r in got if r.doc_id is not None)
    alone = language.identify(more).collect()
    assert {r.lang_pred for r in alone} == {"it"} and all(r.score > 0.5 for r in alone)


def test_pipeline_stages(spark, docs):
    table = docs.collect()
    kept = corpus_pipeline.language_stage(spark, docs, "")
    assert kept.columns == docs.columns
    assert {r.doc_id for r in table} - {r.doc_id for r in kept.collect()} == {4, 5, 6}
    once = corpus_pipeline.near_duplicate_stage(spark, kept, "")
    assert once.columns == docs.columns
    _, component = brute([(r.doc_id, r.text) for r in kept.collect()])
    want = sorted({i for i, c in component.items() if i == c})
    assert sorted(r.doc_id for r in once.collect() if r.doc_id is not None) == want
    mixed = corpus_pipeline.mixing_stage(spark, once, "")
    assert mixed.columns == docs.columns
    told = corpus_pipeline.token_stage(spark, mixed, "")
    assert told.count() == mixed.count() > 0


def test_pipeline_keeps_one_of_repeated_rows(spark):
    rows = [(1, "a b c d e f"), (1, "a b c d e f"), (2, "a b c d e f"), (None, "x")]
    once = corpus_pipeline.near_duplicate_stage(spark, spark.createDataFrame(rows, "doc_id long, text string"), "")
    assert sorted(map(str, (r.doc_id for r in once.collect()))) == ["1", "None"]


def test_pipeline_keeps_a_fixed_row_of_repeated_ids(spark):
    rows = [(1, None, 0), (1, "f e d c b a", 3), (1, "a b c d e f", 2), (1, "a b c d e f", 1), (2, "x y z", 4)]
    for parts in (1, 3, 5):
        df = spark.createDataFrame(rows, "doc_id long, text string, n int").repartition(parts, "n")
        once = corpus_pipeline.near_duplicate_stage(spark, df, "")
        assert once.columns == df.columns and sorted(map(tuple, once.collect())) == [(1, "a b c d e f", 1), (2, "x y z", 4)]


def test_empty_table_passes(spark, docs):
    frame = docs.limit(0)
    for _, stage in corpus_pipeline.STAGES:
        frame = stage(spark, frame, "")
    assert frame.count() == 0 and near_duplicates.BANDS == 51


def test_run(spark, small):
    assert corpus_pipeline.run(spark, small).columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]


def test_repeated_rows_teach_once(spark):
    """One labelled row a thousand times, under its id and under others, changes no prediction."""
    rng = random.Random(8)
    syllables = {"x": ["ba", "bo", "bu"], "y": ["ke", "ki", "ko"], "z": ["sa", "tu", "lo"]}
    rows = [(i, " ".join("".join(rng.choices(syllables[lang], k=3)) for _ in range(30)), lang) for i in range(300) for lang in [rng.choice("xyz")]]
    first = next(r for r in rows if r[2] == "x" and zlib.crc32(str(r[0]).encode()) % 4 != 2)
    again = rows + [first] * 1500 + [(1000 + i, first[1], "x") for i in range(500)]

    def told(table):
        docs = spark.createDataFrame(table, "doc_id long, text string, lang string").repartition(4)
        return {(r.doc_id, r.lang_pred, round(r.score, 4)) for r in language.identify(docs).collect() if r.doc_id < 300}

    want = told(rows)
    assert {(i, lang) for i, lang, _ in want} == {(i, lang) for i, _, lang in rows}
    assert told(again) == want
