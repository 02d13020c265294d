"""Cross-tokenizer alignment against a plain version of its definition."""

import base64
import hashlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from stratalake.llm import alignment, queries

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
ONE = Tokenizer.from_file(A)
ONE.encode_special_tokens = True
with open(A, "rb") as one, open(B, "rb") as other:
    ALIGNER = alignment.Aligner(one.read(), other.read())
OTHER = sentencepiece.SentencePieceProcessor(model_file=B)
TEXTS = [
    None,
    "",
    " ",
    "Hello world  two",
    "a<|endoftext|>b <s> </s><unk>",
    "▁ is shown as a space",
    "café 日本語 😀 \x00 \t\n\r é ﬁ ½",
    "x" * 5_000,
    "word " * 30_000,
    "same text here",
    "same text here",
    "same text there",
]


def byte_strings():
    """Token bytes of A from the same vocabulary in another file."""
    with open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    assert tiktoken.Encoding("own", pat_str=r"\s+|\S+", mergeable_ranks=ranks, special_tokens={}).n_vocab
    return {i: token for token, i in ranks.items()}


BYTES = byte_strings()


def piece(i):
    text = OTHER.id_to_piece(i)
    return bytes([int(text[3:5], 16)]) if OTHER.is_byte(i) else text.replace("▁", " ").encode()


def tokens(text):
    """``(ids, ends)`` of both, empty if the bytes differ from the text's."""
    if not text:
        return [], [], [], []
    whole = (" " + text).encode()
    a, b = ONE.encode(" " + text, add_special_tokens=False).ids, OTHER.encode(text)
    if b"".join(BYTES[i] for i in a) != whole or b"".join(map(piece, b)) != whole:
        return [], [], [], []
    ends = []
    for sizes in ([len(BYTES[i]) for i in a], [len(piece(i)) for i in b]):
        at, own = 0, []
        for n in sizes:
            at += n
            own.append(at)
        ends.append(own)
    return a, b, *ends


def expected(rows):
    """The contract by the letter, text by text and pair by pair."""
    coded = [(key, *tokens(text)) for key, text in rows]
    found = []
    for key, a, b, ends_a, ends_b in coded:
        place = {e: i for e, i in zip(ends_b, b, strict=True)}
        pairs = [(i, place[e]) for e, i in zip(ends_a, a, strict=True) if e in place]
        groups, start = [], 0
        for cut in sorted(set(ends_a) & set(ends_b)):
            inside = [",".join(str(i) for i, e in zip(ids, ends, strict=True) if start < e <= cut) for ids, ends in ((a, ends_a), (b, ends_b))]
            groups.append("|".join(inside))
            start = cut
        found.append((key, len(a), len(b), groups, pairs))
    count = Counter(p for row in found for p in row[4])
    best = defaultdict(int)
    for (_, b), n in count.items():
        best[b] = max(best[b], n)
    return sorted(
        (
            (key, n_a, n_b, len(groups), len(pairs), sum(count[p] == best[p[1]] for p in pairs), sum(count[p] for p in pairs),
             hashlib.sha256(";".join(groups).encode()).hexdigest() if groups else "")
            for key, n_a, n_b, groups, pairs in found
        ),
        key=repr,
    )


def got(frame):
    assert frame.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    return sorted((tuple(r) for r in frame.collect()), key=repr)


def documents(spark, rows):
    return spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id long, text string, digest string").repartition(3)


@settings(max_examples=400, deadline=None)
@given(st.text(alphabet=st.one_of(st.sampled_from(" \n\t'.,ab▁é1\u200b\u3000\x1c"), st.characters(exclude_categories=["Cs"])), max_size=40))
def test_pieces_give_what_whole_texts_give(text):
    a, b, ends_a, ends_b = tokens(text)
    ((n_a, n_b, n_groups, links, _),) = ALIGNER.align([text])
    place = dict(zip(ends_b, b, strict=True))
    pairs = [(i << 32) | place[e] for e, i in zip(ends_a, a, strict=True) if e in place]
    assert (n_a, n_b, n_groups, links) == (len(a), len(b), len(pairs), np.array(pairs, np.int64).tobytes())


@pytest.mark.parametrize("frequent", [alignment.FREQUENT, 20, 0])
def test_any_text(spark, frequent, monkeypatch):
    """With all, some and none of the pairs in the table that is sent to the workers."""
    monkeypatch.setattr(alignment, "FREQUENT", frequent)
    rows = [*enumerate(t if t is None or len(t) < 6000 else t[:3000] for t in TEXTS), (None, "no id"), (3, "Hello world  two")]
    assert got(alignment.measures(documents(spark, rows), A, B)) == expected(rows)


def test_long_texts(spark):
    (row,) = got(alignment.measures(documents(spark, [(1, TEXTS[8])]), A, B))
    n = len(ONE.encode(" " + TEXTS[8], add_special_tokens=False).ids)
    assert row[1] == n and row[3] == row[4] and row[6] >= 29_000**2


def test_copies_weigh_and_are_aligned_once(spark):
    rows = [(i, "one two three") for i in range(400)] + [(1000 + i, f"one two {i}") for i in range(50)]
    docs = documents(spark, rows)
    assert got(alignment.measures(docs, A, B)) == expected(rows)


def test_empty_table_and_clashing_names(spark):
    docs = documents(spark, [(1, "a b c")]).selectExpr("*", "1 AS copies", "2 AS links", "3 AS `a.b`", "4 AS key")
    assert got(alignment.measures(docs.limit(0), A, B)) == []
    assert got(alignment.measures(docs, A, B)) == expected([(1, "a b c")])


def test_whole_table(spark, small):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{small}/documents.parquet").collect()]
    assert got(queries.op13_tokenizer_alignment(spark, small)) == expected(rows)
