"""Language identification by string kernels.

The kernel of two texts is the number of n-grams (blended spectrum, n from 1 to ``LONGEST``)
present in both, divided by the geometric mean of how many each has. A sample of the labelled
texts, the landmarks, spans a Nyström approximation of it; one-versus-rest ridge regression is
fitted in that space. The score of a text is linear in its kernel values with the landmarks,
and these are linear in its n-gram presence, so both matrices are folded into one and batches
of presence rows are multiplied with it.

N-grams run over lower-cased letters, everything else counts as one space. They are hashed to
2^20 slots; a text has far fewer n-grams, so that few share a slot.

Learning reads a bounded sample: per language ``TRAIN`` divided by the number of languages
different labelled texts of any length, those of the smallest hashes, and of a text with more than
``TRAIN_CHARS`` characters that many, in ``PIECES`` pieces spread over its letters. Of more than
``TRAIN`` languages the ones with the most texts are learned. Prediction reads every text whole.

Defined results: a text that is NULL or has no letter is ``und`` with score 0. So is every text
when nothing labelled can be learned. Equal scores fall to the first language by code point.
Rows are mapped one by one; repeated rows get equal results, an empty table an empty one.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType

from stratalake.llm.workers import give_up_idle, per_worker
from stratalake.session import pin

LONGEST = 4
SLOTS = 1 << 20
TRAIN, TRAIN_CHARS, PIECES = 1200, 20_000, 8
LANDMARKS = 240
RIDGE = 0.01
BATCH = 64
UNKNOWN = "und"

_random = np.random.Generator(np.random.PCG64(4))
_FACTOR = _random.integers(0, 1 << 63, LONGEST, np.uint64) * np.uint64(2) + np.uint64(1)
_LATIN = re.compile("[A-Za-z]")


def has_letter(text: str | None) -> bool:
    return bool(text) and (_LATIN.search(text) is not None or any(map(str.isalpha, text)))


def _letters() -> np.ndarray:
    """Which code points are letters."""
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)


def ngram_slots(text: str) -> np.ndarray:
    """Sorted distinct slots of the n-grams of a text."""
    letters = per_worker("letters", _letters)
    codes = np.frombuffer(f" {text.lower()} ".encode("utf-32-le", "surrogatepass"), np.uint32)
    codes = np.where(letters[codes], codes, np.uint32(32))
    gap = codes == 32
    codes = codes[np.concatenate(([True], ~(gap[1:] & gap[:-1])))].astype(np.uint64)
    parts = []
    h = np.zeros(len(codes), np.uint64)
    for n in range(min(LONGEST, len(codes))):
        # The n-gram that begins at each place, grown by one character.
        h = (h[: len(codes) - n] ^ codes[n:]) * _FACTOR[n]
        parts.append(((h ^ (h >> np.uint64(31))) * _FACTOR[0] >> np.uint64(44)).astype(np.uint32))
    ordered = np.sort(np.concatenate(parts))
    return ordered[np.concatenate(([True], ordered[1:] != ordered[:-1]))]


class Model:
    """``place`` gives the row of ``weights`` of a slot, or -1; one column per language."""

    def __init__(self, languages: list[str], slots: np.ndarray, weights: np.ndarray):
        self.languages, self.weights = languages, weights
        self.place = np.full(SLOTS, -1, np.int32)
        self.place[slots] = np.arange(len(slots))

    def scores(self, texts: list[str]) -> np.ndarray:
        """One row per text: the regression's value per language."""
        presence = np.zeros((len(texts), len(self.weights)), np.float32)
        scale = np.ones(len(texts))
        for i, text in enumerate(texts):
            slots = ngram_slots(text)
            known = self.place[slots]
            presence[i, known[known >= 0]] = 1
            scale[i] = np.sqrt(len(slots))
        return (presence @ self.weights) / scale[:, None]

    def predict(self, texts: list[str | None]) -> tuple[list[str], list[float]]:
        names, values = [UNKNOWN] * len(texts), [0.0] * len(texts)
        usable = [i for i, t in enumerate(texts) if has_letter(t)] if self.languages else []
        for start in range(0, len(usable), BATCH):
            some = usable[start : start + BATCH]
            scores = self.scores([texts[i] for i in some])
            for i, row in zip(some, scores, strict=True):
                best = int(row.argmax())
                names[i] = self.languages[best]
                values[i] = float(min(1.0, max(0.0, (row[best] + 1) / 2)))
        return names, values


def fit(languages: list[str], labels: np.ndarray, sets: list[np.ndarray]) -> Model:
    """Nyström ridge regression from n-gram sets and their labels (places in ``languages``)."""
    if not sets:
        return Model([], np.array([], np.int64), np.zeros((0, 0), np.float32))
    # Landmarks alternate over the languages, so that each has its share.
    turn = np.lexsort((labels, [int((labels[:i] == labels[i]).sum()) for i in range(len(labels))]))
    marks = [sets[i] for i in turn[:LANDMARKS]]
    slots = np.unique(np.concatenate(marks))

    def presence(some: list[np.ndarray]) -> np.ndarray:
        rows = np.zeros((len(some), len(slots)), np.float32)
        for row, own in zip(rows, some, strict=True):
            at = np.searchsorted(slots, own)
            at = at[(at < len(slots)) & (slots[np.minimum(at, len(slots) - 1)] == own)]
            row[at] = 1
        return rows / np.sqrt([[len(s)] for s in some]).astype(np.float32)

    landmarks = presence(marks)
    values, vectors = np.linalg.eigh((landmarks @ landmarks.T).astype(np.float64))
    good = values > 1e-6 * values.max()
    whiten = vectors[:, good] / np.sqrt(values[good])
    mapped = np.concatenate([presence(sets[i : i + 64]) @ landmarks.T for i in range(0, len(sets), 64)]) @ whiten
    target = np.where(labels[:, None] == np.arange(len(languages)), 1.0, -1.0)
    # Rows weigh so that every language counts alike.
    weight = 1.0 / np.bincount(labels, minlength=len(languages))[labels][:, None]
    normal = mapped.T @ (mapped * weight) + RIDGE * np.eye(mapped.shape[1])
    regression = np.linalg.solve(normal, mapped.T @ (target * weight))
    return Model(languages, slots, (landmarks.T @ (whiten @ regression)).astype(np.float32))


def excerpt(text: str) -> str:
    """What learning reads of a text: short ones whole, of long ones pieces spread over the letters."""
    if len(text) <= TRAIN_CHARS:
        return text
    # As in n-grams, everything but letters counts as one space, so that every piece has letters.
    text = " ".join("".join([c if c.isalpha() else " " for c in text]).split())
    size = TRAIN_CHARS // PIECES
    if len(text) <= TRAIN_CHARS:
        return text
    starts = [(len(text) - size) * i // (PIECES - 1) for i in range(PIECES)]
    return " ".join([text[at : at + size] for at in starts])


@F.arrow_udf(ArrayType(IntegerType()))
def _slots(texts: pa.Array) -> pa.Array:
    give_up_idle()
    return pa.array([ngram_slots(excerpt(t)).astype(np.int32) for t in texts.to_pylist()], pa.list_(pa.int32()))


def held_out(key: Column, folds: int = 4, fold: int = 2) -> Column:
    """Rows that learning may not see, by the crc32 of the id as text; FALSE without an id."""
    return F.coalesce(F.pmod(F.crc32(key.cast("string").cast("binary")), F.lit(folds)) == fold, F.lit(False))


def train(df: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang") -> Model:
    """A model of the labelled rows of ``df`` that are not held out."""
    rows = df.select(F.col(key).alias("_key"), F.col(text).cast("string").alias("_text"), F.col(lang).cast("string").alias("_lang"))
    # A row without an id cannot be told to be held out.
    rows = rows.where(F.col("_key").isNotNull() & ~held_out(F.col("_key")) & F.col("_lang").isNotNull())
    rows = rows.where(F.col("_text").rlike(r"\p{L}"))
    # One row per language and text: copies, and repeated rows, must not fill the sample.
    digest = F.xxhash64("_text", F.lit(4)).alias("_digest")
    once = pin(rows.select("_lang", digest, "_key").groupBy("_lang", "_digest").agg(F.min("_key").alias("_key")), "texts")
    most = once.groupBy("_lang").count().orderBy(F.desc("count"), "_lang").limit(TRAIN)
    languages = sorted(r[0] for r in most.collect())
    each = max(1, TRAIN // max(1, len(languages)))
    known = F.broadcast(most.select("_lang"))  # TRAIN rows at most
    in_language = F.row_number().over(Window.partitionBy("_lang").orderBy("_digest"))
    # The chosen texts are at most TRAIN; they are only read for their slots.
    chosen = once.join(known, "_lang", "left_semi").withColumn("_n", in_language).where(F.col("_n") <= each)
    sample = rows.withColumn("_digest", digest).join(F.broadcast(pin(chosen, "sample")), ["_lang", "_digest", "_key"])
    sample = sample.dropDuplicates(["_lang", "_n"]).select("_lang", "_n", _slots("_text").alias("_slots"))
    learned = sorted(sample.collect(), key=lambda r: (r["_n"], r["_lang"]))
    place = {name: i for i, name in enumerate(languages)}
    labels = np.array([place[r["_lang"]] for r in learned], np.int64)
    return fit(languages, labels, [np.array(r["_slots"], np.int64) for r in learned])


def predict(df: DataFrame, model: Model, text: str = "text") -> Column:
    """Struct column ``lang, score`` for ``text`` alone."""
    # Its size is bounded by the landmarks, not by the table.
    sent = df.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf("struct<lang: string, score: double>")
    def tell(texts: pa.Array) -> pa.Array:
        give_up_idle()
        names, values = sent.value.predict(texts.to_pylist())
        return pa.StructArray.from_arrays([pa.array(names, pa.string()), pa.array(values, pa.float64())], ["lang", "score"])

    return tell(F.col(text).cast("string"))


def identify(df: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """``key, held_out, lang_pred, score`` of every row, by a model of the labelled rows."""
    model = train(df, key, text, lang)
    rows = df.select(F.col(key), held_out(F.col(key)).alias("held_out"), predict(df, model, text).alias("_told"))
    return rows.select(F.col(key), "held_out", F.col("_told.lang").alias("lang_pred"), F.col("_told.score").alias("score"))
