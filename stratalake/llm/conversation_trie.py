"""Prefix trie of conversations by union-find over neighbours in sorted order.

1. *Turns.* Turns are numbered per conversation over range-partitioned chunks, so that a long
   conversation is many chunks. The first turns of a conversation are replaced by those of its
   base. A running exclusive-or of hashes of (place, role, text) names every prefix; its state is
   carried over chunk borders by one row per chunk and conversation.
2. *Contraction.* Rows of one prefix are one node. Only the steps below a branching node matter
   for the order, so a conversation's sort key is the list of these steps: it is as long as the
   conversation has branching ancestors (with N turns in all at most about the root of 2 N),
   however long the conversation is. Copies are one key.
3. *Forest.* Keys are sorted; neighbours are joined by an edge as deep as their common prefix.
   Within a chunk union-find takes the edges in descending depth: every merge of components makes
   or extends a branching node of that depth, and a component that cannot go on beyond the chunk
   is closed, that is reported with its members, leaves and savings.
4. *Borders.* What a chunk cannot close, because it goes on across a border, is left as a short
   list of contracted components, one per open depth. The lists of ``FAN`` neighbouring chunks are
   put behind each other and go through the same union-find, until one list is left.
5. *Nodes.* A closed component stands for a chain of nodes with the same members, which are known
   by the smallest member and the number of members; each node gets its values from its chain.

Ids that end at a node are hashed from sorted pieces of at most ``PIECE`` ids, streamed in order.
A hash of many ids is made by one task, as SHA-256 has no parts, in constant memory.

Defined results: rows without a conversation id take no part. Turns are ordered by ``turn`` (NULL
first), equal ones by the MD5 of role and text; repeated rows are turns of their own. A NULL role
or text is empty. Texts are hashed whole. Without conversations there are no nodes, not even a
root. Other columns are not looked at, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stratalake.operators.ordered import CHUNK, ROW, neighbours, range_chunks
from stratalake.session import fresh_path, pin, scratch

BASES, HEADS = 20, 4  # base of c is c - c % BASES; fewer than HEADS turns are taken from it
FAN = 64  # lists of contracted components that are merged together
PIECE = 4096

NODE = ["depth", "one", "two"]


def _head(conv: Column) -> Column:
    return F.crc32(conv.cast("string").cast("binary")) % HEADS


def _terms(depth: Column) -> list[Column]:
    """Two hashes of a turn at its place; prefixes are named by their exclusive-or."""
    return [F.xxhash64(F.lit(seed), depth.cast("bigint"), F.col("digest")).alias(f"term_{seed}") for seed in (1, 2)]


def _running(over: Window) -> list[Column]:
    return [
        F.bit_xor("term_1").over(over).alias("one"),
        F.bit_xor("term_2").over(over).alias("two"),
        F.sum("words").over(over).alias("total"),
    ]


def rebuilt_prefixes(df: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """One row per conversation and prefix of its rebuilt turns.

    ``conv, depth``; ``one, two`` name the prefix and ``up_one, up_two`` the one before; ``words``
    of the last turn and ``total`` of all; ``last`` marks the whole conversation.
    """
    said, who = F.coalesce(F.col(text).cast("string"), F.lit("")), F.coalesce(F.col(role).cast("string"), F.lit(""))
    digest = F.unhex(F.md5(F.concat(F.length(who).cast("string"), F.lit(":"), who, said)))
    # Fixed value: what separates words.
    words = F.regexp_count(said, F.lit(r"[^\x20\x09-\x0D]+")).cast("bigint")
    raw = df.select(F.col(conv).cast("bigint").alias("conv"), F.col(turn).alias("turn"), digest.alias("digest"), words.alias("words"))
    chunked = range_chunks(raw.where("conv IS NOT NULL"), ["conv", "turn", "digest"])
    # One row per conversation and chunk; a conversation has as many as it has chunks.
    earlier = Window.partitionBy("conv").orderBy(CHUNK).rowsBetween(Window.unboundedPreceding, -1)
    per = chunked.groupBy(CHUNK, "conv").agg(F.min(ROW).alias("_first"), F.count("*").alias("_n"))
    per = pin(per.withColumn("_before", F.coalesce(F.sum("_n").over(earlier), F.lit(0))), "spans")
    sizes = per.groupBy("conv").agg(F.sum("_n").alias("size"))
    based = sizes.select("*", _head(F.col("conv")).alias("head"), (F.col("conv") - F.col("conv") % BASES).alias("base"))
    given = sizes.select(F.col("conv").alias("base"), F.col("size").alias("_size"))
    taken = F.least("head", F.coalesce("_size", F.lit(0))).alias("taken")
    length = (taken + F.greatest(F.col("size") - F.col("head"), F.lit(0))).alias("length")
    convs = pin(based.join(given, "base", "left").select("conv", "base", "head", taken, length), "conversations")

    placed = chunked.join(per.join(convs, "conv"), [CHUNK, "conv"])
    placed = placed.withColumn("_at", F.col(ROW) - F.col("_first") + F.col("_before") + 1)
    own_depth = F.col("_at") - F.col("head") + F.col("taken")
    own = placed.where(F.col("_at") > F.col("head")).select(
        CHUNK, ROW, "conv", own_depth.alias("depth"), "words", "length", *_terms(own_depth)
    )
    heads = placed.where((F.col("conv") % BASES == 0) & (F.col("_at") < HEADS))
    heads = heads.select(F.col("conv").alias("base"), F.col("_at").alias("depth"), "digest", "words")
    # At most HEADS - 1 turns for each conversation.
    lent = convs.join(heads, "base").where(F.col("depth") <= F.col("taken"))
    lent = pin(lent.select("conv", "depth", "words", "length", *_terms(F.col("depth"))), "lent")

    upto = Window.partitionBy("conv").orderBy("depth").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    first = lent.select("*", *_running(upto))
    # What comes before a chunk's turns: the lent ones and those of earlier chunks.
    parts = own.groupBy(CHUNK, "conv").agg(
        F.bit_xor("term_1").alias("term_1"), F.bit_xor("term_2").alias("term_2"), F.sum("words").alias("words")
    )
    lent_parts = lent.groupBy("conv").agg(
        F.bit_xor("term_1").alias("term_1"), F.bit_xor("term_2").alias("term_2"), F.sum("words").alias("words")
    )
    parts = parts.unionByName(lent_parts.withColumn(CHUNK, F.lit(-1)))
    carried = parts.select(CHUNK, "conv", *[c.alias(f"_c{i}") for i, c in enumerate(_running_before(earlier))])
    inside = Window.partitionBy(CHUNK, "conv").orderBy(ROW).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rest = own.select("*", *_running(inside)).join(carried.where(F.col(CHUNK) >= 0), [CHUNK, "conv"])
    rest = rest.withColumns(
        {"one": F.col("one").bitwiseXOR(F.col("_c0")), "two": F.col("two").bitwiseXOR(F.col("_c1")), "total": F.col("total") + F.col("_c2")}
    )
    names = ["conv", "depth", "one", "two", "up_one", "up_two", "words", "total", "last"]
    turns = [
        part.withColumn("up_one", F.col("one").bitwiseXOR(F.col("term_1")))
        .withColumn("up_two", F.col("two").bitwiseXOR(F.col("term_2")))
        .withColumn("last", F.col("depth") == F.col("length"))
        .select(*names)
        for part in (first, rest)
    ]
    zero = F.lit(0).cast("bigint")
    root = convs.select(
        "conv", *[zero.alias(c) for c in ("depth", "one", "two", "up_one", "up_two", "words", "total")], (F.col("length") == 0).alias("last")
    )
    return turns[0].unionByName(turns[1]).unionByName(root)


def _running_before(earlier: Window) -> list[Column]:
    return [
        F.coalesce(F.bit_xor("term_1").over(earlier), F.lit(0)),
        F.coalesce(F.bit_xor("term_2").over(earlier), F.lit(0)),
        F.coalesce(F.sum("words").over(earlier), F.lit(0)),
    ]


# A component: its edges to both sides, its highest node so far, and what is below that node.
_ITEM = ["chunk", "place", "left", "left_total", "right", "right_total", "depth", "total", "conv", "n", "kids", "leaves", "saved"]


def merge_forest(items: list[dict]) -> tuple[list[dict], list[dict]]:
    """Closed components, and the contracted ones that go on beyond the list, of neighbours in order.

    ``left`` and ``right`` are the depths of the edges to the neighbours, -1 where there is none;
    ``left_total`` and ``right_total`` count the words up to there.
    """
    head = list(range(len(items)))  # the first item of a component stands for it
    state = [dict(x) for x in items]
    closed: list[dict] = []

    def find(i: int) -> int:
        while head[i] != i:
            head[i] = head[head[i]]
            i = head[i]
        return i

    def report(x: dict) -> None:
        if not x["kids"]:
            x["leaves"] = 1
        closed.append(dict(x))

    def lift(x: dict) -> None:
        """Close a whole component and put it below its parent, at the deeper of its two edges, as one child."""
        depth, total = max((x["left"], x["left_total"]), (x["right"], x["right_total"]))
        if x["depth"] > depth:
            report(x)
            x["saved"] += (x["n"] - 1) * (x["total"] - total)
            x["depth"], x["total"], x["kids"] = depth, total, 1

    for k in sorted(range(1, len(items)), key=lambda k: (-items[k]["left"], k)):
        i, j = find(k - 1), find(k)
        one, other = state[i], state[j]
        lift(one)
        lift(other)
        # Otherwise one of them goes on, deeper than this edge, beyond the list.
        if one["depth"] == other["depth"] == items[k]["left"]:
            for sum_of in ("n", "kids", "leaves", "saved"):
                one[sum_of] += other[sum_of]
            one["conv"] = min(one["conv"], other["conv"])
            one["right"], one["right_total"] = other["right"], other["right_total"]
            head[j] = i
    left = [state[i] for i in range(len(items)) if head[i] == i]
    for x in left:
        if x["left"] < 0 and x["right"] < 0:
            report(x)
    return closed, [x for x in left if x["left"] >= 0 or x["right"] >= 0]


def _contract(rows: pa.Table) -> pa.Table:
    items = rows.sort_by([("_order", "ascending"), ("place", "ascending")]).select(_ITEM).to_pylist()
    closed, left = merge_forest(items)
    for place, x in enumerate(left):
        x["place"] = place
    made = [x | {"closed": True} for x in closed] + [x | {"closed": False} for x in left]
    schema = pa.schema([*[(c, pa.int64()) for c in _ITEM], ("closed", pa.bool_())])
    return pa.Table.from_pylist(made, schema)


def _forest(ordered: DataFrame) -> DataFrame:
    """The closed components of sequences ``path, length, total, conv, n``."""
    seen = neighbours(ordered, [], ["path"], previous={"_previous": "path"})
    # The first step that the neighbour before does not share; its parent is where both part.
    same = F.zip_with("path", "_previous", lambda x, y: x.eqNullSafe(y))
    parting = F.when(F.col("_previous").isNotNull(), F.element_at("path", F.array_position(same, False).cast("int")))
    edged = seen.select(
        "path", "length", "total", "conv", "n", F.coalesce(parting["depth"] - 1, F.lit(-1)).alias("left"), parting["before"].alias("left_total")
    )
    chunked = range_chunks(edged, ["path"])
    inside = Window.partitionBy(CHUNK).orderBy(ROW)
    edge = F.struct("left", "left_total")
    following = chunked.where(F.col(ROW) == 0).select(CHUNK, F.lead(edge).over(Window.orderBy(CHUNK)).alias("_next"))
    right = F.coalesce(F.lead(edge).over(inside), "_next")
    none = F.lit(0).cast("bigint")
    items = chunked.join(F.broadcast(following), CHUNK).select(
        F.col(CHUNK).cast("bigint").alias("chunk"),
        F.col(ROW).alias("place"),
        F.col("left").cast("bigint").alias("left"),
        F.coalesce("left_total", none).alias("left_total"),
        F.coalesce(right["left"], F.lit(-1)).cast("bigint").alias("right"),
        F.coalesce(right["left_total"], none).alias("right_total"),
        F.col("length").alias("depth"),
        *["total", "conv", "n", none.alias("kids"), none.alias("leaves"), none.alias("saved")],
    )
    chunks = (chunked.agg(F.max(CHUNK)).first()[0] or 0) + 1
    schema = ", ".join(f"{c} bigint" for c in _ITEM) + ", closed boolean"
    items, found = items.withColumn("_order", F.col("chunk")), []
    while True:
        # A group is a chunk, or the contracted lists of FAN groups.
        merged = pin(items.groupBy("chunk").applyInArrow(_contract, schema), "forest")
        found.append(merged.where("closed"))
        if chunks == 1:
            break
        items = merged.where("NOT closed").drop("closed").withColumn("_order", F.col("chunk"))
        items = items.withColumn("chunk", F.floor(F.col("chunk") / FAN))
        chunks = -(-chunks // FAN)
    whole = found[0]
    for more in found[1:]:
        whole = whole.unionByName(more)
    return whole.select("conv", "n", "depth", "total", "kids", "leaves", "saved")


def _ends(prefixes: DataFrame) -> DataFrame:
    """SHA-256 of the sorted ids that end at a node."""
    key = [c for c in NODE]

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[int] = []
        now = None

        def made(key: tuple, ids: list[int]) -> pa.RecordBatch:
            columns = [*[[k] for k in key], [ids[0]], [",".join(map(str, ids))]]
            return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=[*NODE, "first", "ids"])

        for batch in batches:
            for *node, conv in zip(*(batch.column(c).to_pylist() for c in (*NODE, "conv")), strict=True):
                if held and (node != now or len(held) == PIECE):
                    yield made(now, held)
                    held = []
                now = node
                held.append(conv)
        if held:
            yield made(now, held)

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, state, done = None, None, []

        def made() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*done, strict=True)], names=[*NODE, "ends_sha256"])

        for batch in batches:
            for *node, ids in zip(*(batch.column(c).to_pylist() for c in (*NODE, "ids")), strict=True):
                if node == now:
                    state.update(b"," + ids.encode())
                    continue
                if now is not None:
                    done.append((*now, state.hexdigest()))
                now, state = node, hashlib.sha256(ids.encode())
            if done:
                yield made()
                done = []
        if now is not None:
            done.append((*now, state.hexdigest()))
            yield made()

    ended = prefixes.where("last").select(*key, "conv")
    ended = ended.repartitionByRange(*key, "conv").sortWithinPartitions(*key, "conv")
    cut = ended.mapInArrow(pieces, "depth bigint, one bigint, two bigint, first bigint, ids string")
    cut = cut.repartition(*key).sortWithinPartitions(*key, "first")
    return cut.mapInArrow(hashed, "depth bigint, one bigint, two bigint, ends_sha256 string")


def trie(prefixes: DataFrame) -> DataFrame:
    """Nodes of the trie of ``rebuilt_prefixes``, as ``conversation_trie`` returns them."""
    ending = F.when(F.col("last"), F.col("conv"))
    nodes = prefixes.groupBy(*NODE).agg(
        F.count("*").alias("n"),
        F.min("conv").alias("conv"),
        *[F.min(c).alias(c) for c in ("up_one", "up_two", "words", "total")],
        F.min(ending).alias("end_conv"),
        F.count(ending).alias("n_ends"),
    )
    nodes = pin(nodes, "nodes")
    below = nodes.where("depth > 0").groupBy((F.col("depth") - 1).alias("depth"), F.col("up_one").alias("one"), F.col("up_two").alias("two"))
    branching = nodes.join(below.agg(F.count("*").alias("kids")), NODE).where("kids > 1 OR n_ends > 0")
    branching = branching.select((F.col("depth") + 1).alias("depth"), F.col("one").alias("up_one"), F.col("two").alias("up_two"), F.col("conv").alias("parent"))
    # Nodes below a branching one; a node with very many children is one row on the right.
    tops = nodes.join(branching, ["depth", "up_one", "up_two"]).select(*NODE, "parent")
    tops = pin(tops, "tops")
    ended = nodes.where("n_ends > 0").select(F.col("end_conv").alias("conv"), F.col("depth").alias("length"), "total", F.col("n_ends").alias("n"))
    step = F.struct(*NODE, (F.col("total") - F.col("words")).alias("before"))
    steps = prefixes.where("depth > 0").join(ended.select("conv"), "conv", "left_semi").join(tops.select(*NODE), NODE).select("conv", step.alias("step"))
    paths = steps.groupBy("conv").agg(F.array_sort(F.collect_list("step")).alias("path"))
    none = F.array().cast("array<struct<depth: bigint, one: bigint, two: bigint, before: bigint>>")
    ordered = ended.join(paths, "conv", "left").withColumn("path", F.coalesce("path", none))
    chains = _forest(ordered).withColumnsRenamed({"depth": "_bottom", "total": "_total"})
    members = F.col("n") - 1
    found = nodes.join(chains, ["conv", "n"]).join(tops, NODE, "left").join(_ends(prefixes), NODE, "left")
    return found.select(
        F.col("conv").alias("conv_id"),
        "depth",
        F.coalesce("parent", F.when(F.col("depth") > 0, F.col("conv"))).alias("parent_conv_id"),
        F.col("n").alias("n_convs"),
        F.when(F.col("depth") == F.col("_bottom"), F.col("kids")).otherwise(1).cast("bigint").alias("n_children"),
        F.col("leaves").alias("n_leaves"),
        (F.col("saved") + members * (F.col("_total") - F.col("total") + F.col("words"))).alias("saved_tokens"),
        F.coalesce("ends_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("ends_sha256"),
    )


def conversation_trie(df: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """``conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256`` per node."""
    spark = df.sparkSession
    path = fresh_path(spark, "trie")
    with scratch(spark):
        trie(pin(rebuilt_prefixes(df, conv, turn, role, text), "prefixes")).write.parquet(path)
    return spark.read.parquet(path)
