"""Near duplicates of texts and vectors, components and top-k against brute force."""

import random

import numpy as np
import pytest

from stratalake.llm import near_duplicates, top_k, vector_duplicates
from stratalake.llm.components import components


def union(pairs, nodes):
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in pairs:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def test_components(spark):
    rng = random.Random(1)
    pairs = [(rng.randrange(300), rng.randrange(300)) for _ in range(170)] + [(n, n + 1) for n in range(400, 440)]
    pairs += [(500, n) for n in range(501, 560)] + [(7, 7), (None, 3)]
    df = spark.createDataFrame(pairs, "a long, b long")
    real = [(a, b) for a, b in pairs if a is not None and a != b]
    want = union(real, {n for p in real for n in p})
    assert {r.node: r.component for r in components(df).collect()} == want
    assert components(df.limit(0)).count() == 0


def shingle_set(text):
    words = near_duplicates.word_list(text)
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def brute(rows):
    sets = {}
    for i, text in rows:
        if i is not None:
            sets[i] = shingle_set(text)
    ids = sorted(sets)
    pairs = []
    for n, a in enumerate(ids):
        for b in ids[n + 1 :]:
            common = len(sets[a] & sets[b])
            if common and 100 * common >= 75 * len(sets[a] | sets[b]):
                pairs.append((a, b))
    return sets, union(pairs, ids)


def varied(rng, words, share):
    return " ".join(rng.choice(["x", "y", "z"]) + str(rng.randrange(99)) if rng.random() < share else w for w in words)


@pytest.fixture(scope="module")
def texts():
    """Groups of near copies, a chain, a passage in many texts, and the defined cases."""
    rng = random.Random(5)
    new = lambda n: [f"w{rng.randrange(10**6)}" for _ in range(n)]
    out = [None, "", " \n\t", "One two", "one TWO", "one two three four five", "É é é é é", "é é é é é"]
    for size, share in ((150, 0.01), (120, 0.03), (40, 0.02), (6, 0.01), (60, 0.045)):
        base = new(120)
        out += [varied(rng, base, share) for _ in range(size)]
    chain = new(200)
    out += [" ".join(chain[i : i + 150]) for i in range(0, 50, 6)]
    passage = new(60)
    out += [" ".join(new(30) + passage + new(30)) for _ in range(100)]
    out += [" ".join(new(300)), " ".join(new(9) * 3000)] + [" ".join(new(50)).upper() for _ in range(100)]
    out += out[8:20]
    return list(enumerate(out)) + [(None, out[9]), (3, "One two")]


@pytest.mark.parametrize(("small", "block"), [(near_duplicates.SMALL_BUCKET, near_duplicates.BLOCK), (1, 8)])
def test_near_duplicates(spark, texts, small, block, monkeypatch):
    """Also with every shared bucket taken as a large one and cut in blocks."""
    monkeypatch.setattr(near_duplicates, "SMALL_BUCKET", small)
    monkeypatch.setattr(near_duplicates, "BLOCK", block)
    df = spark.createDataFrame([(i, t, 1, "k") for i, t in texts], "doc_id long, text string, n_shingles int, kept string")
    sets, component = brute(texts)
    got = near_duplicates.near_duplicates(df.repartition(4)).collect()
    assert len(got) == len(texts)
    for row in got:
        if row.doc_id is None:
            assert row.component_id is None and row.kept
        else:
            assert (row.n_shingles, row.component_id) == (len(sets[row.doc_id]), component[row.doc_id])
            assert row.kept == (row.component_id == row.doc_id)
    assert near_duplicates.near_duplicates(df.limit(0)).count() == 0


def test_repeated_ids_of_different_texts(spark):
    rng = random.Random(6)
    new = lambda: " ".join(f"w{rng.randrange(10**6)}" for _ in range(60))
    rows, want = [], {}
    for g in range(0, 400, 20):
        a, b, c = new(), new(), new()
        rows += [(g + 5, a), (g + 5, b), (g + 9, b), (g + 12, b + " end"), (g + 13, a + " end"), (g + 14, c), (g + 14, ""), (g + 2, c)]
        rows += [(g + 15, new()), (g + 15, c + " end")] * 3
        want |= {g + 5: g + 5, g + 9: g + 5, g + 12: g + 5, g + 13: g + 5, g + 14: g + 2, g + 2: g + 2, g + 15: g + 2}
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = near_duplicates.near_duplicates(df).collect()
    assert len(got) == len(rows)
    assert {(r.doc_id, r.component_id, r.kept) for r in got} == {(i, c, i == c) for i, c in want.items()}


def test_likelihood_estimate():
    rng = np.random.default_rng(3)
    for share in (0.2, 0.5, 0.75, 0.9):
        common = rng.integers(0, 1 << 63, int(2000 * share), np.uint64)
        one = np.unique(np.concatenate([common, rng.integers(0, 1 << 63, 2000 - len(common), np.uint64)]))
        other = np.unique(np.concatenate([common, rng.integers(0, 1 << 63, 2000 - len(common), np.uint64)]))
        true = len(common) / (len(one) + len(other) - len(common))
        a, b = (near_duplicates.registers(x)[None, :] for x in (one, other))
        told = near_duplicates.likely_similarity(a, b, np.array([float(len(one))]), np.array([float(len(other))]))[0]
        assert abs(told - true) < near_duplicates.SLACK
        whole = near_duplicates.registers(np.union1d(one, other))
        assert (whole == np.maximum(a, b)[0]).all()  # registers merge


@pytest.fixture(scope="module")
def vectors():
    rng = np.random.default_rng(2)
    rows = []
    for group in range(3):
        base = rng.standard_normal(16)
        rows += [(base + 0.15 * rng.standard_normal(16), group) for _ in range(250)]
    rows += [(rng.standard_normal(16), int(rng.integers(3))) for _ in range(400)]
    rows += [(rows[5][0], rows[5][1])] * 40
    return [(i, [float(np.float32(x)) for x in v], label) for i, (v, label) in enumerate(rows)]


ODD = [
    (2000, None, 1),
    (2001, [], 1),
    (2002, [0.0] * 16, 1),
    (2003, [None] + [1.0] * 15, 1),
    (2004, [float("nan")] * 16, 1),
    (2005, [float("inf")] * 16, 1),
    (2006, [1.0] * 16, None),
    (2007, [1.0] * 15, 1),
    (None, [1.0] * 16, 1),
]


def frame(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").repartition(3)


def test_vector_duplicates(spark, vectors, monkeypatch):
    for name, value in (("LEAF", 64), ("BLOCK", 16), ("FEW", 4)):  # several levels and blocks in a small table
        monkeypatch.setattr(vector_duplicates, name, value)
    x = np.array([v for _, v, _ in vectors])
    cosine = (x @ x.T) / np.outer(np.linalg.norm(x, axis=1), np.linalg.norm(x, axis=1))
    labels = np.array([label for *_, label in vectors])
    link = (cosine >= 0.93) & (labels[:, None] == labels[None, :])
    np.fill_diagonal(link, False)
    component = union(zip(*np.nonzero(link), strict=True), range(len(x)))
    want = {(i, int(link[i].sum()), component[i], component[i] == i) for i in range(len(x))}
    want |= {(i, 0, i, True) for i, *_ in ODD}
    got = {tuple(r) for r in vector_duplicates.vector_duplicates(frame(spark, vectors + ODD)).collect()}
    lost = {r[0]: r for r in want - got}
    assert len(lost) <= 0.02 * len(x)  # the forest may miss a pair at the threshold
    told = {r[0]: r for r in got}
    assert all(told[i][1] <= r[1] for i, r in lost.items())  # and never adds one
    assert vector_duplicates.vector_duplicates(frame(spark, vectors).limit(0)).count() == 0


def test_recall_near_the_threshold_with_trees_of_a_sample(spark, monkeypatch):
    """One label, 3,000 planted pairs at cosines from 0.931 to 0.95; the trees see a tenth of the vectors."""
    for name, value in (("LEAF", 256), ("BLOCK", 128), ("SAMPLE", 600), ("FEW", 8)):
        monkeypatch.setattr(vector_duplicates, name, value)
    rng = np.random.default_rng(2)
    one = rng.standard_normal((3000, 32))
    one /= np.linalg.norm(one, axis=1)[:, None]
    other = rng.standard_normal((3000, 32))
    other -= (other * one).sum(axis=1)[:, None] * one
    other /= np.linalg.norm(other, axis=1)[:, None]
    cosine = rng.uniform(0.931, 0.95, 3000)[:, None]
    other = cosine * one + np.sqrt(1 - cosine**2) * other
    rows = [(i, v.tolist(), 1) for i, v in enumerate(np.concatenate([one, other]))]
    got = {r.vec_id: r for r in vector_duplicates.vector_duplicates(frame(spark, rows)).collect()}
    found = sum(got[i].component_id == got[i + 3000].component_id for i in range(3000))
    assert found >= 0.98 * 3000
    assert all(r.n_links <= 1 for r in got.values())


def test_repeated_ids_of_different_vectors(spark):
    rng = np.random.default_rng(7)
    rows, want = [], set()
    for g in range(0, 400, 20):
        a, b = rng.standard_normal((2, 16))
        near = lambda v: [float(np.float32(x)) for x in v + 0.01 * rng.standard_normal(16)]
        one = near(b)
        rows += [(g + 5, near(a), g), (g + 5, one, g), (g + 5, None, g), (g + 9, one, g), (g + 12, near(b), g), (g + 13, near(a), g)]
        want |= {(g + 5, 1, g + 5), (g + 5, 2, g + 5), (g + 5, 0, g + 5), (g + 9, 2, g + 5), (g + 12, 2, g + 5), (g + 13, 1, g + 5)}
    got = vector_duplicates.vector_duplicates(frame(spark, rows)).collect()
    assert len(got) == len(rows) and {tuple(r) for r in got} == {(*w, w[0] == w[2]) for w in want}


def test_top_k(spark, vectors, monkeypatch):
    monkeypatch.setattr(top_k, "ROWS", 100)
    monkeypatch.setattr(top_k, "QUERIES", 4)
    rows = frame(spark, vectors + ODD)
    got = [tuple(r) for r in top_k.top_k(rows.where("vec_id % 100 = 0"), rows).collect()]
    usable = vectors + [(2006, [1.0] * 16, None), (2002, [0.0] * 16, 1), (2007, [1.0] * 15, 1)]
    whole = {i: np.floor(1024 * np.array(v)).astype(np.int64) for i, v, _ in usable}
    want = []
    for q in [i for i in whole if i % 100 == 0]:
        score = lambda i: int(whole[q][: len(whole[i])] @ whole[i])  # noqa: B023, E731
        best = sorted((i for i in whole if i != q), key=lambda i: (-score(i), i))[:10]  # noqa: B023
        want += [(q, n, i, score(i)) for n, i in enumerate(best, 1)]
    assert sorted(got) == sorted(want)


def test_top_k_edges(spark):
    few = frame(spark, [(0, [1.0, 3e30], 1), (1, [2.0, 3e30], 1), (2, [0.5, 0.0], 1), (100, [1.0, 0.0], 1)])
    got = {(r.query_id, r.rank): (r.vec_id, r.score) for r in top_k.top_k(few.where("vec_id % 100 = 0"), few).collect()}
    assert got[(0, 1)] == (1, (1 << 63) - 1) and got[(100, 1)] == (1, 2048 * 1024)
    assert len(got) == 6
    assert top_k.top_k(few.limit(0), few).count() == 0
