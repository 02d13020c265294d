"""A training-data pipeline over ``documents``: language, near duplicates, mixing, tokens.

Each stage takes (spark, docs, folder) and returns what it keeps with the columns of ``docs``;
the last one returns token digests. Extra columns are carried through whatever their names.
Each stage's result is written to the shared folder and read again by the next one.

Rows without an id are judged by their text in every stage but near-duplicate removal, which
keeps them. An empty table passes all stages and gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratalake.llm import language, mixing, near_duplicates
from stratalake.llm.queries import prepared, round_trip_digests
from stratalake.session import pin


def language_stage(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents with a letter; scores reject nothing, as ``und`` is only given to texts without one."""
    prepared(spark)
    model = language.train(docs)
    if not model.languages:  # nothing to learn from: only texts without a letter can be told
        return docs.where(F.col("text").rlike(r"\p{L}"))
    return docs.where(language.predict(docs, model)["lang"] != language.UNKNOWN)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """One document of each group of near duplicates, the one with the smallest id."""
    prepared(spark)
    judged = pin(near_duplicates.near_duplicates(docs), "judged").where("doc_id IS NOT NULL")
    # Narrow frames decide; texts move only to meet what goes, which is the smaller part.
    gone = judged.where(~F.col("kept")).select(F.col("doc_id").alias("_id")).distinct()
    # What goes grows with the table, so it is never broadcast, at any size.
    left = docs.join(gone.hint("merge"), docs["doc_id"] == gone["_id"], "left_anti")
    repeated = judged.where("kept").groupBy(F.col("doc_id").alias("_id")).agg(F.count("*").alias("_n")).where("_n > 1")
    repeated = pin(repeated.select("_id"), "repeated")
    if repeated.isEmpty():
        return left
    # Rows that share an id are one document: the row with the smallest text, then other columns.
    match = left["doc_id"] == repeated["_id"]
    plain = [c for c, kind in docs.dtypes if "map<" not in kind and "variant" not in kind]
    order = F.struct(F.col("text").isNull().alias("_none"), F.col("text").alias("_text"), *plain)
    row = F.struct(*docs.columns)
    once = left.join(repeated, match, "left_semi").groupBy("doc_id").agg(F.min_by(row, order).alias("_row")).select("_row.*")
    return left.join(repeated, match, "left_anti").unionByName(once)


def mixing_stage(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents as often as the mix of sources takes them."""
    prepared(spark)
    return mixing.emit(mixing.mix(docs))


def token_stage(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Token counts and digests of the encoded and decoded texts."""
    prepared(spark)
    return round_trip_digests(spark, docs)


STAGES = [
    ("language_id", language_stage),
    ("minhash_near_dedup", near_duplicate_stage),
    ("mix_sources", mixing_stage),
    ("bpe_round_trip", token_stage),
]

# SQL cannot express the language model and the tokenizer.
ORACLE_SQL = None


def run(spark: SparkSession, folder: str) -> DataFrame:
    """All stages over the ``documents`` of a folder."""
    docs = prepared(spark).read.parquet(f"{folder}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = pin(stage(spark, docs, folder), name)
    return STAGES[-1][1](spark, docs, folder)
