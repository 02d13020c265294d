"""Main text of pages by a tree-structured graphical model.

Every block element of a page is a node that is content or not. Its features (tag, names, text,
share of links) give its own potential, a table shared by all edges says how parent and child
agree. Messages go up the tree and down again (sum-product), which on a tree gives the exact
marginal of each node; text of nodes that are content more likely than not is kept.

The weights are fitted on labelled pages: those whose markup names the main text (``article``,
``main``). In every second one the naming tags are hidden, so that pages without them are
learned too. Elements whose tag states another purpose (navigation, forms, scripts) are no
content, with everything below them, and are cut off the tree. Names (class, id, role) that
speak of such a purpose are features only. An element whose name states it is the root of a tree
of its own that is judged as a whole, so that enough text below outweighs the name; an
``article`` or ``main`` below is judged by itself.

Labelled pages are a sample of at most ``SAMPLE`` rows of at most ``SAMPLE_CHARS`` characters,
the smallest hashes of the id; every page is extracted whole.

Defined results: a NULL or empty page gives an empty text. ``br`` counts as white space. Rows
are mapped one by one, so ties and repeated rows need no rule; an empty table gives an empty
result, and without any labelled page the weights stay at their prior.
"""

from __future__ import annotations

import math
import re
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratalake.llm.dom import Node, parse

SAMPLE, SAMPLE_CHARS = 200, 60_000
ROUNDS, STEP, DECAY = 25, 0.5, 0.02

# Elements whose purpose is not the main text.
_NEVER = frozenset(
    """head script style title noscript template nav footer aside form button select option textarea iframe svg dialog
    menu canvas object video audio fieldset legend search""".split()
)
# Names of elements beside the text, and those that parts of a text have as well.
_ASIDE = frozenset(
    """nav navbar menu menubar sidebar sidenav footer footnav ad ads adv advert adverts advertisement banner sponsor
    sponsored promo cookie gdpr comment comments commentlist reply replies disqus sharing newsletter subscribe signup
    login popup modal overlay breadcrumb breadcrumbs pagination pager toolbar widget widgets complementary
    contentinfo""".split()
)
_MAYBE = frozenset(
    """navigation advertising promotion cookies consent notice notices alert respond discussion share social related
    recommended recommendations subscription search toc skip""".split()
)
_HEAD = frozenset({"header", "masthead", "topbar"})
# Words that only say what an element holds, and such that turn a name into a property of a layout.
_HOLDS = frozenset("area bar block body box container content holder inner list outer region section slot unit wrap wrapper".split())
_TURNS = frozenset("has have hide hidden is no non not show with without".split())
_TITLES = frozenset({"h1", "h2", "h3", "h4", "h5", "h6"})
_MAIN = frozenset({"article", "main"})
_MAIN_NAMES = frozenset({"article", "articlebody", "main", "content", "post", "entry", "story", "body", "text"})
_TAGS = ("article", "main", "section", "div", "p", "heading", "list", "li", "table", "cell", "quote", "body", "other")
_GROUP = (
    {"h1": "heading", "h2": "heading", "h3": "heading", "h4": "heading", "h5": "heading", "h6": "heading"}
    | {"ul": "list", "ol": "list", "dl": "list", "dt": "li", "dd": "li", "pre": "quote", "blockquote": "quote"}
    | {"td": "cell", "th": "cell", "tr": "table", "tbody": "table", "thead": "table", "html": "body"}
)
_TEXT = ("none", "short", "middle", "long", "very long")
_MORE = ("named main", "links", "many links", "ends a sentence", "named aside", "mentions aside")
FEATURES = (*_TAGS, *_TEXT, *_MORE)
# What holds before any page is seen.
_PRIOR = {"article": 4.0, "main": 4.0, "p": 1.0, "heading": 0.3, "quote": 0.5, "body": -4.0, "other": -0.5}
_PRIOR |= {"middle": 0.5, "long": 1.0, "very long": 2.0, "named main": 1.5, "links": -1.0, "many links": -3.0}
_PRIOR |= {"ends a sentence": 0.5, "none": -0.3, "short": -0.3, "named aside": -40.0, "mentions aside": -1.5}
_BOUND = 1e-20  # chance that something below such a name is content although the named element is not
_AGREE = np.array([[200.0, 4.0], [2.0, 400.0]])  # counts [parent][child] before any page is seen


class Model:
    """Weights of the node features and log potentials of an edge, ``edge[parent][child]``."""

    def __init__(self, weights: np.ndarray, edge: np.ndarray):
        self.weights, self.edge = weights, edge


def prior() -> Model:
    return Model(np.array([_PRIOR.get(f, 0.0) for f in FEATURES]), np.log(_AGREE / _AGREE.sum(axis=1, keepdims=True)))


def blocked(nodes: Sequence[Node]) -> list[bool]:
    """Whether a tag states a node to be no content, its own or that of an element around it."""
    out, inside_main = [], []
    for node in nodes:
        above = node.parent >= 0 and out[node.parent]
        main = (node.parent >= 0 and inside_main[node.parent]) or node.tag in _MAIN
        stated = node.tag in _NEVER or (node.tag == "header" and not main)
        out.append(above or stated)
        inside_main.append(main)
    return out


def aside(node: Node, inside_main: bool) -> int:
    """2 if a name says that the node is beside the text, 1 if one merely mentions such a thing.

    ``sidebar``, ``left-sidebar``, ``comments-area`` and ``cookie-notice`` say it; ``has-sidebar``,
    ``related-work`` and a lone ``discussion`` do not, nor does the name of a heading.
    """
    if not node.names or node.tag in ("html", "body"):
        return 0
    sure = _ASIDE if inside_main else _ASIDE | _HEAD
    found = 0
    for name in node.names.split():
        words = re.findall(r"[a-z]+", name)
        if not any(w in sure or w in _MAYBE for w in words):
            continue
        found = 1
        if node.tag in _TITLES or not _TURNS.isdisjoint(words):
            continue
        meant = [w for w in words if w not in _HOLDS]
        if meant[-1] in sure or (all(w in sure or w in _MAYBE for w in meant) and not sure.isdisjoint(meant)):
            return 2
    return found


def features(nodes: Sequence[Node], beside: Sequence[int], hide: bool = False) -> np.ndarray:
    """Feature rows of the nodes and what ``aside`` says of them; ``hide`` reads the naming tags as plain ones."""
    rows = np.zeros((len(nodes), len(FEATURES)))
    for i, node in enumerate(nodes):
        tag = _GROUP.get(node.tag, node.tag)
        if hide and tag in _MAIN:
            tag = "div"
        rows[i, _TAGS.index(tag) if tag in _TAGS else _TAGS.index("other")] = 1
        size = sum([len(t) for _, t in node.runs])
        rows[i, len(_TAGS) + ((size > 0) + (size > 25) + (size > 100) + (size > 400))] = 1
        at = len(_TAGS) + len(_TEXT)
        if node.names and not hide and set(re.findall(r"[a-z]+", node.names)) & _MAIN_NAMES:
            rows[i, at] = 1
        if size and node.links > 0.3 * size:
            rows[i, at + 1 + (node.links > 0.7 * size)] = 1
        if node.runs and node.runs[-1][1].rstrip()[-1:] in (".", "!", "?", ":", "…", "。"):
            rows[i, at + 3] = 1
        if beside[i]:
            rows[i, at + (4 if beside[i] == 2 else 5)] = 1
    return rows


def marginals(parents: Sequence[int], own: Sequence[float], edge: np.ndarray, bound: Sequence[bool] = ()) -> list[float]:
    """Log odds of the marginal of every node; parents come before their children, -1 is a root.

    Everything is kept as log odds of content. ``up`` is what a child tells its parent: the
    log ratio of its belief summed out under a content parent and under another one. Nodes that
    are ``bound`` are hardly ever content below a parent that is not.
    """
    (free00, free01), (s10, s11) = np.exp(edge).tolist()
    n = len(own)
    bound = bound or [False] * n
    below = list(own)
    up = [0.0] * n
    for i in range(n - 1, 0, -1):
        if parents[i] < 0:
            continue
        s00, s01 = (1.0, _BOUND) if bound[i] else (free00, free01)
        x = below[i]
        # Divided by the larger term, so that no exponential overflows.
        a, b = (math.exp(x), 1.0) if x < 0 else (1.0, math.exp(-x))
        up[i] = math.log((s11 * a + s10 * b) / (s01 * a + s00 * b))
        below[parents[i]] += up[i]
    all_ = below[:]
    for i in range(1, n):
        if parents[i] < 0:
            continue
        s00, s01 = (1.0, _BOUND) if bound[i] else (free00, free01)
        x = all_[parents[i]] - up[i]
        a, b = (math.exp(x), 1.0) if x < 0 else (1.0, math.exp(-x))
        all_[i] = below[i] + math.log((s11 * a + s01 * b) / (s10 * a + s00 * b))
    return all_


def _labels(nodes: Sequence[Node], parents: Sequence[int]) -> np.ndarray | None:
    """Content flags of a page whose markup names its main text, else None."""
    inside: list[bool] = []
    for node, parent in zip(nodes, parents, strict=True):
        inside.append(node.tag in _MAIN or (parent >= 0 and inside[parent]))
    return np.array(inside) if any(inside) else None


def _free(nodes: Sequence[Node]) -> tuple[list[Node], list[int], list[int], list[bool]]:
    """Nodes that are not blocked, places of their parents among them, ``aside``, and whether one is above.

    A blocked element says nothing about what surrounds it, so it is cut off with all below.
    So does one whose name puts it beside the text, but it stays, as a root of its own.
    """
    place: dict[int, int] = {}
    kept, parents, beside, inside, bound = [], [], [], [], []
    for i, (node, out) in enumerate(zip(nodes, blocked(nodes), strict=True)):
        if out:
            continue
        place[i] = len(kept)
        above = place.get(node.parent, -1)
        within = above >= 0 and (bound[above] or beside[above] == 2)
        inside.append(node.tag in _MAIN or (above >= 0 and inside[above]))
        says = aside(node, inside[-1])
        # The tag of the main text stands against a name, unless names around it say the same.
        if node.tag in _MAIN and not (within and says == 2):
            says, root = 0, within
        else:
            root = says == 2
        kept.append(node)
        beside.append(says)
        bound.append(within and not root)
        parents.append(-1 if root else above)
    return kept, parents, beside, bound


def fit(pages: Sequence[str]) -> Model:
    """Weights by gradient steps on the likelihood: labels less marginals, held near the prior."""
    start = prior()
    counts = _AGREE.copy()
    examples = []
    for page in pages:
        nodes, parents, beside, bound = _free(parse(page))
        label = _labels(nodes, parents)
        if label is None:
            continue
        for i, p in enumerate(parents):
            if p >= 0 and not bound[i]:
                counts[int(label[p]), int(label[i])] += 1
        examples.append((features(nodes, beside, hide=bool(len(examples) % 2)), parents, bound, label))
    model = Model(start.weights.copy(), np.log(counts / counts.sum(axis=1, keepdims=True)))
    rows_in_all = sum(len(parents) for _, parents, _, _ in examples)
    for _ in range(ROUNDS if examples else 0):
        gradient = np.zeros(len(FEATURES))
        for rows, parents, bound, label in examples:
            odds = np.array(marginals(parents, (rows @ model.weights).tolist(), model.edge, bound))
            gradient += rows.T @ (label - 1 / (1 + np.exp(-np.clip(odds, -50, 50))))
        model.weights += STEP * (len(FEATURES) * gradient / rows_in_all - DECAY * (model.weights - start.weights))
    return model


def main_text(page: str | None, model: Model) -> str:
    """Blocks of content, in page order, one per line."""
    if not page:
        return ""
    nodes, parents, beside, bound = _free(parse(page))
    odds = marginals(parents, (features(nodes, beside) @ model.weights).tolist(), model.edge, bound)
    blocks: dict[tuple[int, int], list[str]] = {}
    for i, node in enumerate(nodes):
        if odds[i] > 0:
            for place, piece in node.runs:
                blocks.setdefault((place, i), []).append(piece)
    lines = (" ".join("".join(pieces).split()) for _, pieces in sorted(blocks.items()))
    return "\n".join(line for line in lines if line)


def labelled_sample(df: DataFrame, key: str, page: str) -> list[str]:
    """At most ``SAMPLE`` different whole pages that name their main text, the shortest kinds first.

    Pages are ordered by how often their length doubles ``SAMPLE_CHARS`` and then by a hash, so long
    ones only teach where there are no others; as many are taken as have ``SAMPLE`` times
    ``SAMPLE_CHARS`` characters together, and one at least.
    """
    rows = df.select(F.col(key).alias("_key"), F.col(page).cast("string").alias("_page"))
    rows = rows.where(F.lower("_page").rlike("<(article|main)[ >]"))
    size = F.length("_page")
    folds = F.greatest(F.ceil(F.log2(size / F.lit(SAMPLE_CHARS))), F.lit(0))
    digest = F.xxhash64("_page", F.lit(10))
    # Digests first, so that no pages are sorted and repeated pages count once.
    once = rows.select(digest.alias("_digest"), folds.alias("_folds"), size.alias("_size")).distinct()
    first = once.orderBy("_folds", "_digest").limit(SAMPLE).collect()
    chosen, total = [], 0
    for row in first:
        if chosen and total + row["_size"] > SAMPLE * SAMPLE_CHARS:
            break
        chosen.append(row["_digest"])
        total += row["_size"]
    if not chosen:
        return []
    pages = rows.withColumn("_digest", digest).where(F.col("_digest").isin(chosen)).dropDuplicates(["_digest"])
    return [r["_page"] for r in sorted(pages.select("_digest", "_page").collect(), key=lambda r: chosen.index(r["_digest"]))]


def extract(df: DataFrame, key: str = "page_id", url: str = "url", page: str = "html", model: Model | None = None) -> DataFrame:
    """``key, url, text, n_chars`` of every row; without ``model`` one is fitted on ``df``."""
    spark = df.sparkSession
    model = model or fit(labelled_sample(df, key, page))
    # A few dozen numbers.
    sent = spark.sparkContext.broadcast((model.weights, model.edge))

    @F.arrow_udf("string")
    def text_of(pages: pa.Array) -> pa.Array:
        known = Model(*sent.value)
        return pa.array([main_text(p, known) for p in pages.to_pylist()], pa.string())

    rows = df.select(F.col(key), F.col(url), text_of(F.col(page).cast("string")).alias("text"))
    return rows.select(F.col(key), F.col(url), "text", F.length("text").cast("bigint").alias("n_chars"))
