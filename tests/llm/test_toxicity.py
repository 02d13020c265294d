"""Toxicity: the learner against a plain one, held-out accuracy, repeated rows, long texts, edges."""

import math
import zlib

import numpy as np
import pytest

from stratalake.llm import queries, toxicity


def held_out(key):
    return zlib.crc32(str(key).encode()) % 3 == 1


def plain_ftrl(sets, labels):
    """Coordinate by coordinate, as the method is usually written down."""
    z, n, ones = {}, {}, sum(labels)
    weight = {0: len(labels) / (2 * (len(labels) - ones)), 1: len(labels) / (2 * ones)}

    def w(i):
        limit = 0 if i == "bias" else toxicity.L1
        value = z.get(i, 0.0)
        if abs(value) <= limit:
            return 0.0
        return -(value - math.copysign(limit, value)) / ((toxicity.BETA + math.sqrt(n.get(i, 0.0))) / toxicity.ALPHA)

    for _ in range(min(max(toxicity.STEPS // len(sets), toxicity.EPOCHS[0]), toxicity.EPOCHS[1])):
        for items, label in zip(sets, labels, strict=True):
            now = {i: w(i) for i in [*items, "bias"]}
            g = weight[label] * (1 / (1 + math.exp(-sum(now.values()))) - label)
            for i, value in now.items():
                sigma = (math.sqrt(n.get(i, 0.0) + g * g) - math.sqrt(n.get(i, 0.0))) / toxicity.ALPHA
                z[i] = z.get(i, 0.0) + g - sigma * value
                n[i] = n.get(i, 0.0) + g * g
    return {i: w(i) for i in z}


def test_learner_equals_the_plain_one():
    rng = np.random.default_rng(1)
    labels = [int(x) for x in rng.integers(0, 2, 60)]
    sets = [np.unique(np.concatenate((rng.integers(0, 50, 12), [50 + label]))) for label in labels]
    model, want = toxicity.fit(sets, labels), plain_ftrl([s.tolist() for s in sets], labels)
    assert model.bias == pytest.approx(want.pop("bias"), rel=1e-6, abs=1e-9)
    assert model.slots.tolist() == sorted(i for i, v in want.items() if v)
    assert np.allclose(model.weights, [want[i] for i in model.slots.tolist()], rtol=1e-5)
    assert {50, 51} <= set(model.slots.tolist())


def test_features_are_words_stems_and_skip_grams():
    own = lambda t: set(toxicity.features(t).tolist())
    assert own(None) == own("") == own(" 12 -- ") == set()
    assert own("Cat") == own("cat, 5") and len(own("cat")) == 1 + len(toxicity.STEMS)
    assert len(own("abcdefxx") & own("abcdefyy")) == sum(n <= 6 for n in toxicity.STEMS)
    assert own("aa bb") < own("aa bb cc") and own("aa bb") != own("bb aa")
    assert own("x aa y bb") >= own("aa") | own("bb")


def table(spark, texts):
    docs = spark.createDataFrame([(i, t, "src") for i, (t, _) in texts], "doc_id long, text string, toxic string")
    labels = [(i, y, 1) for i, (_, y) in texts if i is not None]
    return docs, spark.createDataFrame(labels, "doc_id long, toxic int, quality int")


def words(rng, n):
    return " ".join("".join(rng.choice(list("abcdefgh"), 5)) for _ in range(n))


@pytest.fixture(scope="module")
def texts():
    rng = np.random.default_rng(3)
    made = [(words(rng, 30) + (" you idiot " if i % 3 == 0 else " ") + words(rng, 30), int(i % 3 == 0)) for i in range(300)]
    return list(enumerate(made))


def judged(spark, texts):
    docs, labels = table(spark, texts)
    return {r.doc_id: r for r in toxicity.detect(docs.repartition(4), labels).collect()}


def test_found_in_long_texts_and_not_elsewhere(spark, texts):
    rng = np.random.default_rng(4)
    more = [(1000, (words(rng, 20_000) + " idiot " + words(rng, 20_000), None)), (1001, (words(rng, 40_000), None))]
    more += [(1002, (None, None)), (1003, ("", None)), (1004, ("!? 7", None)), (1004, ("!? 7", None))]
    found = judged(spark, texts + more)
    for i, (_, y) in texts:
        assert found[i].held_out == held_out(i)
        assert found[i].predicted == y, i
    assert found[1000].predicted == 1 and found[1001].predicted == 0
    assert found[1002].score == found[1003].score == found[1004].score < 0.5
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= toxicity.THRESHOLD) for r in found.values())


def test_repeated_rows_and_labels_teach_once(spark, texts):
    """One clean and one toxic text a thousand times, under one id and under many."""
    want = {i: r.score for i, r in judged(spark, texts).items()}
    seen = [p for p in texts if not held_out(p[0])]
    again = [seen[1]] * 1000 + [(5000 + 3 * n, seen[2][1]) for n in range(1000) if not held_out(5000 + 3 * n)]
    got = {i: r.score for i, r in judged(spark, texts + again).items()}
    assert all(got[i] == want[i] for i in want)


def test_bounds_of_the_sample_exclude_no_length(spark, texts, monkeypatch):
    monkeypatch.setattr(toxicity, "TRAIN_FEATURES", 100)  # the first text of each label alone is longer
    docs, labels = table(spark, texts)
    monkeypatch.setattr(toxicity, "L1", 0.0)
    model = toxicity.train(docs, labels)
    assert model.bias is not None and len(model.slots)


def test_nothing_to_learn_and_empty_tables(spark, texts):
    docs, labels = table(spark, texts[:20] + [(None, ("no id", 1))])
    for none in (labels.limit(0), labels.where("toxic = 1"), labels.selectExpr("doc_id", "CAST(NULL AS INT) AS toxic")):
        rows = toxicity.detect(docs, none).collect()
        assert len(rows) == 21 and {(r.score, r.predicted) for r in rows} == {(0.0, 0)}
        assert {r.held_out for r in rows if r.doc_id is None} == {False}
    assert toxicity.detect(docs.limit(0), labels).count() == 0
    clash = docs.withColumnsRenamed({"toxic": "score"}).selectExpr("*", "1 AS held_out", "2 AS _set", "3 AS _n", "4 AS `a.b`")
    assert toxicity.detect(clash, labels).columns == ["doc_id", "held_out", "score", "predicted"]


def test_held_out_accuracy(spark, middle):
    sf = middle.replace("0.01", "0.1")
    label = {r.doc_id: r.toxic for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    rows = queries.op11_toxicity(spark, sf).collect()
    assert len(rows) == 10_000
    told = [(r.predicted, label[r.doc_id]) for r in rows if r.held_out and r.doc_id in label]
    assert sum(p == y for p, y in told) / len(told) > 0.97
    assert sum(p for p, y in told if y == 0) / sum(y == 0 for _, y in told) < 0.01
