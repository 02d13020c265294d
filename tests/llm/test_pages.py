"""WARC round trips, url rules and page texts against plain Python."""

import hashlib
import html
import random
import re
import time

import pytest

from stratalake.llm import dom, html_extract, queries, url_filter, warc
from stratalake.llm.dom import parse
from stratalake.session import fresh_path

PAGES = [
    (0, "http://a/", "x" * 99),
    (1, "http://b/", "x" * 99),
    (5, "http://c/", "y" * 100),
    (3, "http://d/\r\nWARC-Type: evil", "y" * 100),
    (9, None, "y" * 100),
    (7, "u", None),
    (8, "u", ""),
    (10, "u", "é€😀\r\n\r\nWARC/1.1\r\n\r\n" * 9000),
    (11, "u", "é€😀\r\n\r\nWARC/1.1\r\n\r\n" * 9000),
    (11, "u", "é€😀\r\n\r\nWARC/1.1\r\n\r\n" * 9000),
    (12, "u", "z" * (warc.SEGMENT * 2)),
    (12, "u", "other payload of the same id " * 9),
    (None, "u", "y" * 100),
    (None, "u", "alone " * 50),
]


def test_archives(spark):
    df = spark.createDataFrame([(*p, "r") for p in PAGES], "page_id long, url string, html string, record_type string")
    want = []
    for page, _, payload in PAGES:
        data = (payload or "").encode()
        same = [i for i, _, p in PAGES if (p or "").encode() == data and i is not None]
        first = min(same, default=None)
        revisit = len(data) >= 100 and first is not None and page != first
        want.append((page, len(data), hashlib.sha256(data).hexdigest(), "revisit" if revisit else "response", first if revisit else None))
    got = [tuple(r) for r in warc.archived_pages(df.repartition(2)).collect()]
    key = lambda r: tuple(map(str, r))
    assert sorted(got, key=key) == sorted(want, key=key)
    assert warc.archived_pages(df.limit(0)).count() == 0


def test_archive_texts_and_faults(spark):
    df = spark.createDataFrame(PAGES, "page_id long, url string, html string")
    folder = fresh_path(spark, "warc-test")
    warc.write_archives(df, folder)
    records = warc.read_archives(spark, folder).collect()
    assert all(r.fault is None for r in records)
    assert {bytes(r.payload).decode() for r in records if r.payload is not None} == {p or "" for *_, p in PAGES}
    segments = spark.createDataFrame(
        [("a", "response", None, 1, None, b"12"), ("b", "continuation", "a", 3, 6, b"56"), ("c", "response", None, 1, 4, b"12")],
        "record_id string, record_type string, origin_id string, segment int, total long, block binary",
    ).selectExpr("*", "CAST(NULL AS STRING) AS fault")
    assert {r.record_id for r in warc.reassemble(segments).collect() if r.fault} == {"a", "c"}


@pytest.mark.parametrize("block", [b"", b"HTTP/1.1 200 OK\r\n\r\nplain", b"H\r\nTransfer-Encoding: chunked\r\n\r\n5\r\nab"])
def test_dechunk(block):
    payload, fault = warc.dechunk(block)
    assert (payload is None) == (fault is not None) == (b"plain" not in block)


def brute_verdict(url, rules, default="allow"):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    host = re.match(r"[^/?#]*", rest)[0]
    path = re.match(r"[^?#]*", rest[len(host) :])[0]
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    fits = [
        (len(h) + len(p), len(h), h + p, v)
        for v, h, p in rules
        if (host == h or host.endswith("." + h)) and path.startswith(p)
    ]
    best = max(fits, default=(0, 0, None, default))
    return host, path, best[2], best[3]


def test_url_rules(spark):
    rng = random.Random(4)
    hosts = ["org", "example.org", "a.example.org", "example.com", "notexample.org", "orgx", "net", "É.org", "b..org", ""]
    paths = ["", "/", "/es/", "/es/x", "/en/1", "/en/12/3", "/fr/", "/de/a?b=/es/", "/e"]
    urls = [None, "no scheme", "://", "http://ORG/es/", "HTTP://A.EXAMPLE.ORG/es/#x", "a://b://org/", "x://org?/es/", "x://org"]
    urls += [f"http://{rng.choice(hosts)}{rng.choice(paths)}{rng.choice(['', '?q', '#f'])}" for _ in range(300)]
    urls += ["http://hot.example.org/es/1"] * 200
    more = [("block", rng.choice(hosts[:5]), rng.choice(paths[:8]).split("?")[0]) for _ in range(6)]
    df = spark.createDataFrame([(i, u, "v") for i, u in enumerate(urls)], "page_id long, url string, verdict string").repartition(4)
    for rules in (list(queries.URL_RULES), [*queries.URL_RULES, *more], [("block", "org", "")]):
        rules = list({(h, p): (v, h, p) for v, h, p in rules}.values())
        got = {r[0]: tuple(r)[1:] for r in url_filter.filter_urls(df, url_filter.rule_table(spark, rules)).collect()}
        assert got == {i: brute_verdict(u, rules) for i, u in enumerate(urls)}
    none = url_filter.filter_urls(df, url_filter.rule_table(spark, queries.URL_RULES).limit(0))
    assert {r.verdict for r in none.collect()} == {"allow"}
    assert url_filter.filter_urls(df.limit(0), url_filter.rule_table(spark, queries.URL_RULES)).count() == 0


def article_text(page):
    """The main text of the given pages, whose only mark-up of it is ``article``."""
    inner = re.search(r"<article>(.*?)</article>", page, re.S)[1]
    blocks = re.split(r"</?(?:p|h\d|div|li|ul)[^>]*>", inner.replace("<br>", " "))
    lines = (" ".join(html.unescape(re.sub(r"<[^>]*>", "", b)).split()) for b in blocks)
    return "\n".join(line for line in lines if line)


def test_pages_of_the_table(spark, middle):
    pages = {r.page_id: r.html for r in spark.read.parquet(f"{middle}/pages.parquet").collect()}
    for row in queries.op10_html_extraction(spark, middle).collect():
        assert row.text == article_text(pages[row.page_id])
        assert row.n_chars == len(row.text)


LONG = "This sentence belongs to the main text and is long enough to look like one, with commas and all. " * 3
MODEL = html_extract.prior()


@pytest.mark.parametrize(
    ("page", "text"),
    [
        (None, ""),
        ("", ""),
        ("<<>< &amp", ""),
        (f"<body><nav><a>Home</a></nav><article><h1>T &amp; U</h1><p>{LONG}<br>end.</article><footer>f</footer>", f"T & U\n{LONG.strip()} end."),
        (
            f"<main><p>{LONG}</p><aside>see also</aside><form><p>{LONG}</form><p>a<b>b</b> c&nbsp;\n d</p>"
            f"<section class='comments'><p>{LONG}</p><p>{LONG}</p></section></main>",
            f"{LONG.strip()}\nab c d",
        ),
        (
            f"<div id=header>Site</div><div class='cookie-banner'><p>{LONG}</div><div><h2>Title</h2><p>{LONG}</p><p>{LONG}</p></div>"
            "<div class=sidebar><ul><li><a href=/>x</a></ul></div><script>if (a<b) '</p>'</script>",
            f"Title\n{LONG.strip()}\n{LONG.strip()}",
        ),
        (f"<article><header><h1>Kept</h1></header><p title='a>b'>{LONG}<!-- <p>no --></p><style>p{{}}</style></article>", f"Kept\n{LONG.strip()}"),
    ],
)
def test_page_shapes(page, text):
    assert html_extract.main_text(page, MODEL) == text


TRAINED = html_extract.fit(
    [f"<body><nav><a>n</a></nav><div class='ad'>Buy this.</div><article><h1>T</h1><p>{LONG}</p><p>{LONG}</p></article></body>"] * 40
)


@pytest.mark.parametrize("model", [MODEL, TRAINED], ids=["prior", "trained"])
@pytest.mark.parametrize(
    ("page", "text"),
    [
        ("<div class='layout has-sidebar'><article><p>{0}</p></article><div class=sidebar><p>{0}</p></div></div>", "{0}"),
        ("<div id=content class=no-comments><h1>T</h1><p>{0}</p><p>{0}</p></div>", "T\n{0}\n{0}"),
        ("<div class=sidebar><article><p>{0}</p></article></div>", "{0}"),
        ("<div class=widget-area><div>" + "<p>{0}</p>" * 20 + "</div></div>", "\n".join(["{0}"] * 20)),
        ("<article><p>{0}</p><ol class=comment-list><li class=comment><article class=comment-body><p>{0}</p></article></ol></article>", "{0}"),
        ("<article><p>{0}</p><section id=discussion><h2>Discussion</h2><p>{0}</p></section></article>", "{0}\nDiscussion\n{0}"),
        ("<article><p>{0}</p><div class=related-work><p>{0}</p></div><p class=notice>{0}</p></article>", "{0}\n{0}\n{0}"),
        ("<article><h2 class=toc>Contents</h2><p>{0}</p></article>", "Contents\n{0}"),
        ("<article><p>{0}</p><div class=post-comments><p>{0}</p><p>{0}</p><p>{0}</p></div><p class=ad>Buy this.</p></article>", "{0}"),
        ("<div class=masthead>Site</div><article><div class=entry-header><h1>T</h1></div><p>{0}</p></article>", "T\n{0}"),
    ],
)
def test_names_do_not_cut_what_is_below(model, page, text):
    assert html_extract.main_text("<body>" + page.format(LONG), model) == text.format(LONG.strip())


def test_messages_against_enumeration():
    """Marginals of a small tree equal sums over all its states."""
    import itertools

    import numpy as np

    rng = np.random.default_rng(1)
    parents, own = [-1, 0, 0, 1, 1, 2], rng.normal(size=6).tolist()
    edge = np.log(html_extract._AGREE / html_extract._AGREE.sum(axis=1, keepdims=True))
    weight = np.zeros((6, 2))
    for state in itertools.product((0, 1), repeat=6):
        value = np.exp(sum(u * s for u, s in zip(own, state, strict=True)) + sum(edge[state[p], state[i]] for i, p in enumerate(parents) if p >= 0))
        for i, s in enumerate(state):
            weight[i, s] += value
    assert np.allclose(html_extract.marginals(parents, own, edge), np.log(weight[:, 1] / weight[:, 0]))


def test_long_and_deep_pages(spark):
    deep = "<div>" * 5000 + "<p>" + LONG + "</div>" * 9000
    assert len(parse(deep)) == 5002
    df = spark.createDataFrame([(1, "u", None, 5), (1, "u", f"<article><p>{LONG * 2000}</p></article>", 6)], "page_id long, url string, html string, text int")
    assert sorted(r.n_chars for r in html_extract.extract(df).collect()) == [0, len((LONG * 2000).strip())]
    assert html_extract.extract(df.limit(0)).count() == 0


@pytest.mark.parametrize(
    "page",
    ['<a "' * 250_000, '<a "x>' * 160_000 + "y", "<p><button>" + "<div>" * 200_000, "<b><div>x</b>" * 80_000, "<!--" * 250_000,
     "<a x='" * 160_000 + ">", "<li>" * 250_000, "<script>" * 120_000, "<td><p>" * 140_000],
)
def test_very_long_broken_pages_take_linear_time(page):
    begun = time.process_time()
    dom.parse(page)
    assert time.process_time() - begun < 4


def test_long_pages_teach_where_there_are_no_others(spark, monkeypatch):
    monkeypatch.setattr(html_extract, "SAMPLE_CHARS", 100)
    long = [(i, f"<html><body><article><p>{'word ' * (200 + i)}</p></article></body></html>") for i in range(5)]
    short = [(10 + i, f"<article><p>a {i} b</p></article>") for i in range(3)]
    made = lambda rows: html_extract.labelled_sample(spark.createDataFrame(rows * 3, "page_id long, html string"), "page_id", "html")
    assert sorted(made(long)) == sorted(p for _, p in long)
    assert sorted(made(long + short)[:3]) == sorted(p for _, p in short)
    assert made([(1, "<p>none</p>")]) == []
