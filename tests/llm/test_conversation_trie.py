"""The conversation trie against a plain one: nested dictionaries, any chunking, hot groups, edges."""

import hashlib
import re
import zlib
from collections import defaultdict

import numpy as np
import pytest

from stratalake.llm import conversation_trie, queries

COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
SCHEMA = "conv_id long, turn long, role string, text string, n string, path string, `a.b` int"


def expected(rows):
    """The contract by the letter: every prefix as a tuple."""
    own = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            tie = hashlib.md5(f"{len(role)}:{role}{text}".encode()).digest()
            own[conv].append(((turn is not None, turn or 0), tie, (role, text)))
    turns = {c: [t[2] for t in sorted(all_turns)] for c, all_turns in own.items()}
    members, ends = defaultdict(list), defaultdict(list)
    for c, mine in turns.items():
        h = zlib.crc32(str(c).encode()) % 4
        base = c - (c % 20 if c >= 0 else -(-c % 20))
        whole = tuple(turns.get(base, [])[:h] + mine[h:])
        for d in range(len(whole) + 1):
            members[whole[:d]].append(c)
        ends[whole].append(c)
    children, leaves, saved = defaultdict(int), defaultdict(int), defaultdict(int)
    for p in members:
        if p:
            children[p[:-1]] += 1
    for p, convs in members.items():
        worth = (len(convs) - 1) * len(re.findall(r"[^\x20\x09-\x0D]+", p[-1][1])) if p else 0
        for d in range(len(p) + 1):
            leaves[p[:d]] += p not in children
            saved[p[:d]] += worth
    return sorted(
        (min(convs), len(p), min(members[p[:-1]]) if p else -1, len(convs), children.get(p, 0), leaves[p], saved[p],
         hashlib.sha256(",".join(map(str, sorted(ends.get(p, [])))).encode()).hexdigest())
        for p, convs in members.items()
    )


def got(frame):
    assert frame.columns == COLUMNS
    return sorted(tuple(-1 if v is None else v for v in r) for r in frame.collect())


def table(spark, rows):
    return spark.createDataFrame([(*r, "x", "y", 1) for r in rows], SCHEMA).repartition(5)


@pytest.fixture
def chunked(spark):
    """Every shuffle keeps its partitions, so that small tables have chunk borders."""
    name = "spark.sql.adaptive.coalescePartitions.enabled"
    before = spark.conf.get(name)
    spark.conf.set(name, "false")
    yield spark
    spark.conf.set(name, before)


def made(rng, convs, kinds=3, longest=7):
    rows = []
    for c in convs:
        for t in range(int(rng.integers(1, longest + 1))):
            k = int(rng.integers(0, kinds))
            rows.append((int(c), t, ("user", "assistant")[t % 2], "w " * (k + t)))
    return rows


EDGES = [
    (None, 0, "user", "no conversation"),
    (7, None, "user", "first, as it has no place"),
    (7, 0, None, "no role"),
    (7, 0, "", "no role"),
    (7, 1, "user", None),
    (7, 1, "user", ""),
    (27, 3, "user", "same row"),
    (27, 3, "user", "same row"),
    (-3, 0, "user", "below zero"),
    (-25, 1, "user", "its base is -20"),
    (400, 0, "user", "tab\tand\nline\x0bbreaks  \x1c"),
    (401, 0, "a", "bc"),
    (421, 0, "ab", "c"),
    (10**15 + 1, 0, "user", "word " * 60_000),
]


def test_random_tries_over_many_chunks(chunked, monkeypatch):
    monkeypatch.setattr(conversation_trie, "FAN", 2)
    monkeypatch.setattr(conversation_trie, "PIECE", 3)
    rows = made(np.random.default_rng(1), range(0, 260)) + EDGES
    frame = conversation_trie.conversation_trie(table(chunked, rows))
    assert got(frame) == expected(rows)


def test_hot_groups(chunked, monkeypatch):
    """A conversation with most of the turns, one that is its copy but for the end, copies by the hundred."""
    monkeypatch.setattr(conversation_trie, "FAN", 3)
    long = [(c, t, "user", f"t{t % 7}") for c in (40, 60) for t in range(700 - c % 7)]
    copies = [(c, t, "user", f"copy {t}") for c in range(1000, 1300) for t in range(4)]
    bare = [(c, 0, "user", "one turn") for c in range(2000, 2200)]
    rows = long + copies + bare
    assert got(conversation_trie.conversation_trie(table(chunked, rows))) == expected(rows)


def test_one_conversation_and_one_chain(spark):
    for rows in ([(20, 0, "user", "a b")], [(c, t, "user", f"{t} x") for c in (20, 40) for t in range(5)], EDGES):
        assert got(conversation_trie.conversation_trie(table(spark, rows))) == expected(rows)


def test_empty_tables(spark):
    for rows in ([], [(None, 0, "user", "x")]):
        assert got(conversation_trie.conversation_trie(table(spark, rows))) == []


def test_whole_table(spark, small):
    rows = [(r.conv_id, r.turn, r.role, r.text) for r in spark.read.parquet(f"{small}/conversations.parquet").collect()]
    assert got(queries.op12_conversation_trie(spark, small)) == expected(rows)


def items_of(sequences):
    """Components as the operator hands them over, one per distinct sequence."""
    items = []
    for conv, s in enumerate(sequences):
        items.append({"chunk": 0, "place": conv, "depth": len(s), "total": 10 * len(s), "conv": conv, "n": 1, "kids": 0, "leaves": 0, "saved": 0})
        common = next((i for i, (x, y) in enumerate(zip(s, sequences[conv - 1])) if x != y), min(len(s), len(sequences[conv - 1])))
        items[-1] |= {"left": common if conv else -1, "left_total": 10 * common if conv else 0, "right": -1, "right_total": 0}
        if conv:
            items[-2] |= {"right": common, "right_total": 10 * common}
    return items


@pytest.mark.parametrize("seed", range(40))
def test_any_cut_gives_the_same_forest(seed):
    rng = np.random.default_rng(seed)
    sequences = sorted({tuple(rng.integers(0, 2 + seed % 3, rng.integers(0, 9)).tolist()) for _ in range(60)})
    items = items_of(sequences)
    whole, left = conversation_trie.merge_forest(items)
    assert not left
    # A second, third ... round merges what the one before could not close.
    pieces, found = items, []
    for parts in (9, 4, 2, 1):
        cuts = sorted(rng.integers(0, len(pieces) + 1, parts - 1).tolist())
        rest = []
        for a, b in zip([0, *cuts], [*cuts, len(pieces)]):
            closed, more = conversation_trie.merge_forest(pieces[a:b])
            found += closed
            rest += more
        pieces = rest
    assert not pieces
    kept = lambda rows: sorted(tuple(r[c] for c in ("conv", "n", "depth", "total", "kids", "leaves", "saved")) for r in rows)
    assert kept(found) == kept(whole)


def test_contracted_lists_are_as_short_as_the_open_path():
    sequences = sorted({(0,) * (i % 5) + (1, i) for i in range(500)})
    items = items_of(sequences)
    _, left = conversation_trie.merge_forest(items[100:400])
    assert len(left) <= 12
