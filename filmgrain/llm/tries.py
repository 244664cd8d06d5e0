"""Prefix trie of conversations, summed up along an Euler tour.

A node is a distinct sequence of first turns; it is known by its depth and 128 bits, the sums
of hashes of (place, digest of role and text) over its turns. Sums of a conversation are
taken in two steps, inside range-sorted blocks and over blocks, so that no task sees a whole
conversation. Nodes are sorted by their smallest member and depth, which puts what a
conversation adds to the trie side by side, and siblings follow that order.

The tour has two arcs a node: in, and out. In comes before in of the first child, or out;
out comes before in of the next sibling, or out of the parent. The tour is list-ranked:

1. blocks of nodes, in numpy, join the stretches of the tour that lie inside a block;
2. while more than ``LEAST`` stretches are left, coins decide, and a stretch whose coin is
   heads takes up its successor whose coin is tails, a quarter of all a round;
3. the few stretches left are followed on the driver, and what was taken up gets its place
   from the stretch that took it, round by round, back to the arcs.

The ranks carry sums along: of the arcs, of leaves, and of savings. The difference of a sum
between a node's two arcs is that of its subtree.

Defined results: a null role or text is empty, a null turn comes first; turns that tie are
ordered by role and then by digest of the text; rows without a conversation's id belong to
none and are left out; repeated rows are turns of their own; without rows there is no trie.
Texts of any length are read once, for their digest and length. Other columns are not read.
The list of a node's members goes through one task as a stream, to be hashed, in strings of
up to 4,096 ids each that other tasks have put together.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from filmgrain.llm.graph import stored
from filmgrain.llm.shipping import ship

#: Rows of a block are 2 to this power, at most.
BLOCK_BITS = 15
#: Stretches that the driver follows, at most.
LEAST = 4096
#: Ids in one string.
CHUNK = 4096
_NODE = ["depth", "a", "b"]
_LANES = 4
_LOW = (1 << 32) - 1


def numbered(conversations: DataFrame, id_column: str = "conv_id", turn_column: str = "turn",
             role_column: str = "role", text_column: str = "text") -> tuple[DataFrame, DataFrame]:
    """(turns: conv, block, m, digest, chars; blocks: conv, block, first, before, n, total).

    A turn's place in its conversation is ``before + m - first``, from 0.
    """
    role, text = (F.coalesce(c, F.lit("")) for c in (role_column, text_column))
    rows = conversations.select(
        F.col(id_column).cast("long").alias("conv"), F.col(turn_column).alias("turn"), role.alias("role"),
        F.unhex(F.md5(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text))).alias("digest"),
        F.char_length(text).cast("long").alias("chars")).filter("conv IS NOT NULL")
    turns = stored(rows.orderBy("conv", F.asc_nulls_first("turn"), "role", "digest").select(
        "conv", "digest", "chars", F.monotonically_increasing_id().alias("m")))
    turns = turns.withColumn("block", F.shiftright("m", 33).cast("int"))
    upto = Window.partitionBy("conv").orderBy("block").rowsBetween(Window.unboundedPreceding, 0)
    blocks = turns.groupBy("conv", "block").agg(F.min("m").alias("first"), F.count("*").alias("n"))
    return turns, stored(blocks.select("*", (F.sum("n").over(upto) - F.col("n")).alias("before"),
                                       F.sum("n").over(Window.partitionBy("conv")).alias("total")))


def _placed(turns: DataFrame, blocks: DataFrame) -> DataFrame:
    return turns.join(blocks, ["conv", "block"]).withColumn("place", F.col("before") + F.col("m") - F.col("first"))


def with_shared_heads(turns: DataFrame, blocks: DataFrame, every: int = 100, most: int = 6) -> tuple[DataFrame, DataFrame]:
    """(conv, block, depth, digest, chars; conv, depth): each conversation rebuilt, and how many turns it then has.

    The first h turns come from the conversation that begins the hundred, as far as it has
    them; the conversation's own follow after its first h. h is crc32 of the id modulo six.
    """
    base = F.col("conv") - F.col("conv") % every
    bases = _placed(turns.filter(F.col("conv") == base), blocks.filter(F.col("conv") == base)).filter(F.col("place") < most - 1)
    heads = bases.groupBy(F.col("conv").alias("base")).agg(
        F.array_sort(F.collect_list(F.struct("place", "digest", "chars"))).alias("head"))  # five turns at most
    convs = blocks.filter("before = 0").select(
        "conv", "total", base.alias("base"), (F.crc32(F.col("conv").cast("string")) % most).cast("int").alias("h"))
    none = F.array().cast(heads.schema["head"].dataType)
    convs = stored(convs.join(heads, "base", "left").withColumn(
        "head", F.coalesce(F.slice("head", F.lit(1), F.col("h")), none)).withColumn("k", F.size("head")))
    about = blocks.join(convs.select("conv", "h", "k"), "conv")
    own = _placed(turns, about).filter("place >= h").select(
        "conv", "block", (F.col("place") - F.col("h") + F.col("k") + 1).alias("depth"), "digest", "chars")
    shared = convs.select("conv", F.lit(-1).alias("block"), F.explode("head").alias("t")).select(
        "conv", "block", (F.col("t.place") + 1).alias("depth"), "t.digest", "t.chars")
    lengths = convs.select("conv", (F.col("k") + F.greatest(F.col("total") - F.col("h"), F.lit(0))).alias("depth"))
    return own.unionByName(shared), lengths


def _key(lanes: list[Column]) -> tuple[Column, Column]:
    low = [lane.bitwiseAND(F.lit(_LOW)) for lane in lanes]
    return tuple(F.shiftleft(low[i], 32).bitwiseOR(low[i + 1]) for i in (0, 2))


def prefixes(sequences: DataFrame) -> DataFrame:
    """(conv, depth, chars, a, b, pa, pb): the node of each turn's prefix, and that of the prefix before it."""
    lanes = [f"l{i}" for i in range(_LANES)]
    hashes = [F.xxhash64(F.lit(i), "depth", "digest") for i in range(_LANES // 2)]
    halves = [half for h in hashes for half in (h.bitwiseAND(F.lit(_LOW)), F.shiftrightunsigned(h, 32))]
    rows = sequences.select("conv", "block", "depth", "chars", *(x.alias(n) for n, x in zip(lanes, halves)))
    inside = Window.partitionBy("conv", "block").orderBy("depth").rowsBetween(Window.unboundedPreceding, 0)
    earlier = Window.partitionBy("conv").orderBy("block").rowsBetween(Window.unboundedPreceding, 0)
    sums = rows.groupBy("conv", "block").agg(*(F.sum(n).alias(n) for n in lanes))
    carried = sums.select("conv", "block", *((F.sum(n).over(earlier) - F.col(n)).alias(f"c{n}") for n in lanes))
    run = rows.select("*", *(F.sum(n).over(inside).alias(f"s{n}") for n in lanes)).join(carried, ["conv", "block"])
    now = [F.col(f"s{n}") + F.col(f"c{n}") for n in lanes]
    (a, b), (pa_, pb) = _key(now), _key([x - F.col(n) for x, n in zip(now, lanes)])
    return run.select("conv", "depth", "chars", a.alias("a"), b.alias("b"), pa_.alias("pa"), pb.alias("pb"))


def nodes(rows: DataFrame, lengths: DataFrame) -> DataFrame:
    """(id, block, depth, a, b, pa, pb, chars, n_convs, conv): every node once, by its smallest member and depth."""
    counted = (F.count("*").alias("n_convs"), F.min("conv").alias("conv"))
    below = rows.groupBy(*_NODE, "pa", "pb", "chars").agg(*counted)
    empty = F.lit(None).cast("long")
    root = lengths.agg(*counted).filter("n_convs > 0").select(
        F.lit(0).cast("long").alias("depth"), F.lit(0).cast("long").alias("a"), F.lit(0).cast("long").alias("b"),
        empty.alias("pa"), empty.alias("pb"), F.lit(0).cast("long").alias("chars"), "n_convs", "conv")
    both = below.unionByName(root).orderBy("conv", "depth").withColumn("id", F.monotonically_increasing_id())
    return stored(both.withColumn("block", F.shiftright("id", BLOCK_BITS)))


def linked(tree: DataFrame) -> DataFrame:
    """Nodes with ``parent``, ``parent_conv``, ``n_children`` and what follows both arcs, ``after_in`` and ``after_out``.

    The arcs of node ``id`` are 2 id and 2 id + 1.
    """
    parents = tree.select((F.col("depth") + 1).alias("depth"), F.col("a").alias("pa"), F.col("b").alias("pb"),
                          F.col("id").alias("parent"), F.col("conv").alias("parent_conv"))
    known = stored(tree.join(parents, ["depth", "pa", "pb"], "left"))
    children = known.filter("parent IS NOT NULL").select("parent", "block", "id")
    beside = children.withColumn("next", F.lead("id").over(Window.partitionBy("parent", "block").orderBy("id")))
    groups = children.groupBy("parent", "block").agg(F.min("id").alias("first"), F.count("*").alias("n"))
    later = groups.select("parent", "block", F.lead("first").over(
        Window.partitionBy("parent").orderBy("block")).alias("later"))
    sibling = beside.join(later, ["parent", "block"]).select("id", F.coalesce("next", "later").alias("next"))
    first = groups.groupBy(F.col("parent").alias("id")).agg(F.min("first").alias("first"), F.sum("n").alias("n_children"))
    both = known.join(first, "id", "left").join(sibling, "id", "left")
    return stored(both.select(
        "id", "block", *_NODE, "chars", "n_convs", "conv", "parent_conv", F.coalesce("n_children", F.lit(0)).alias("n_children"),
        F.coalesce(2 * F.col("first"), 2 * F.col("id") + 1).alias("after_in"),
        F.coalesce(2 * F.col("next"), 2 * F.col("parent") + 1).alias("after_out")))


_SUMS = ["place", "leaves", "saved"]
_ARCS = ("arc long, head long, place long, leaves long, saved long, next long, "
         "all_place long, all_leaves long, all_saved long")


def _stretches(block: pd.DataFrame) -> pd.DataFrame:
    """Arcs of one block with the first arc of their stretch and the sums up to them; first arcs also have the
    stretch's whole sums and the arc after it."""
    block = block.sort_values("id")
    n = 2 * len(block)
    arc, after = np.empty(n, dtype=np.int64), np.empty(n, dtype=np.int64)
    arc[0::2], arc[1::2] = 2 * block["id"], 2 * block["id"] + 1
    after[0::2], after[1::2] = block["after_in"], block["after_out"].fillna(-1)
    sums = np.zeros((n, 3), dtype=np.int64)
    sums[:, 0] = 1
    sums[0::2, 1], sums[0::2, 2] = block["n_children"] == 0, (block["n_convs"] - 1) * block["chars"]
    at = np.minimum(np.searchsorted(arc, after), n - 1)
    inside = np.flatnonzero(arc[at] == after)
    before = np.full(n, -1)
    before[at[inside]] = inside
    first, at = np.arange(n), before.copy()
    while (live := np.flatnonzero(at >= 0)).size:  # pointers double
        to = at[live]
        sums[live], first[live], at[live] = sums[live] + sums[to], first[to], at[to]
    last = np.ones(n, dtype=bool)
    last[inside] = False
    last = np.flatnonzero(last)
    whole = np.zeros((n, 4), dtype=np.int64)
    whole[first[last]] = np.column_stack([after[last], sums[last]])
    return pd.DataFrame({"arc": arc, "head": arc[first], **{c: sums[:, i] for i, c in enumerate(_SUMS)},
                         "next": whole[:, 0], **{f"all_{c}": whole[:, i + 1] for i, c in enumerate(_SUMS)}})


def _taken_up(lists: DataFrame, turn: int) -> DataFrame:
    """Each stretch; ``into`` is the one that takes it up, if any, with that one's sums as ``o_``; ``takes`` says
    that it takes up its own successor."""
    coin = lambda c: F.xxhash64(F.lit(turn), c).bitwiseAND(F.lit(1)) == 1
    takes = coin(F.col("arc")) & (F.col("next") >= 0) & ~coin(F.col("next"))
    marked = lists.withColumn("takes", takes)
    takers = marked.filter("takes").select(
        F.col("next").alias("arc"), F.col("arc").alias("into"), *(F.col(c).alias(f"o_{c}") for c in _SUMS))
    return stored(marked.join(takers, "arc", "left"))


def _followed(lists: DataFrame) -> DataFrame:
    """(head, o_ sums before it) of the stretches that are left, a bounded number."""
    rows = {r.arc: r for r in lists.collect()}
    starts = set(rows) - {r.next for r in rows.values()}
    out, at, sums = [], starts.pop() if starts else -1, (0, 0, 0)
    while at >= 0:
        r = rows[at]
        out.append((at, *sums))
        at, sums = r.next, tuple(s + r[c] for s, c in zip(sums, _SUMS))
    return lists.sparkSession.createDataFrame(out, "arc long, " + ", ".join(f"o_{c} long" for c in _SUMS))


def subtrees(linked_nodes: DataFrame, least: int = LEAST) -> DataFrame:
    """(id, n_leaves, saved_tokens), by ranking the tour of ``linked_nodes``."""
    arcs = stored(linked_nodes.select("id", "block", "n_children", "n_convs", "chars", "after_in", "after_out")
                  .groupBy("block").applyInPandas(lambda block: _stretches(block), _ARCS))  # noqa: PLW0108
    lists = arcs.filter("arc = head").select("arc", "next", *(F.col(f"all_{c}").alias(c) for c in _SUMS))
    rounds: list[DataFrame] = []
    while lists.count() > least:
        step = _taken_up(lists, len(rounds))
        rounds.append(step.filter("into IS NOT NULL"))
        joined = rounds[-1].select(F.col("into").alias("arc"), "next", *((F.col(c) + F.col(f"o_{c}")).alias(c) for c in _SUMS))
        lists = step.filter("into IS NULL AND NOT takes").select("arc", "next", *_SUMS).unionByName(joined)
    known = _followed(lists)
    before = [F.col(f"o_{c}") for c in _SUMS]
    for step in reversed(rounds):
        more = step.select("arc", "into", *(x.alias(f"i_{c}") for c, x in zip(_SUMS, before))).join(
            known.withColumnRenamed("arc", "into"), "into").select(
            "arc", *((F.col(f"i_{c}") + F.col(f"o_{c}")).alias(f"o_{c}") for c in _SUMS))
        known = stored(known.unionByName(more))
    placed = arcs.join(known.withColumnRenamed("arc", "head"), "head")
    out = F.col("arc") % 2 == 1
    span = lambda c: F.sum(F.when(out, F.col(c) + F.col(f"o_{c}")).otherwise(-F.col(c) - F.col(f"o_{c}")))
    return placed.groupBy(F.shiftright("arc", 1).alias("id")).agg(
        span("leaves").alias("inner_leaves"), span("saved").alias("inner_saved"))


def _batch(rows: list[tuple], *names: str) -> pa.RecordBatch:
    return pa.record_batch([pa.array(column) for column in zip(*rows)], names=[*_NODE, *names])


def _strings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted (depth, a, b, conv) -> (depth, a, b, first, ids): up to ``CHUNK`` ids of a node in a string."""
    key, ids = (), []
    for batch in batches:
        out = []
        for *now, conv in zip(*(c.to_pylist() for c in batch.columns)):
            if ids and (now != key or len(ids) == CHUNK):
                out.append((*key, ids[0], ",".join(map(str, ids))))
                ids = []
            key = now
            ids.append(conv)
        if out:
            yield _batch(out, "first", "ids")
    if ids:
        yield _batch([(*key, ids[0], ",".join(map(str, ids)))], "first", "ids")


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted strings -> (depth, a, b, sha) of all of a node's, comma-joined."""
    key, state = None, hashlib.sha256()
    for batch in batches:
        out = []
        for *now, _, ids in zip(*(c.to_pylist() for c in batch.columns)):
            if now == key:
                state.update(b"," + ids.encode())
                continue
            if key is not None:
                out.append((*key, state.hexdigest()))
            key, state = now, hashlib.sha256(ids.encode())
        if out:
            yield _batch(out, "sha")
    if key is not None:
        yield _batch([(*key, state.hexdigest())], "sha")


def ends(rows: DataFrame, lengths: DataFrame) -> DataFrame:
    """(depth, a, b, sha): digest of the members that end at a node."""
    zero = F.lit(0).cast("long")
    last = rows.join(lengths, ["conv", "depth"]).select(*_NODE, "conv").unionByName(
        lengths.filter("depth = 0").select("depth", zero.alias("a"), zero.alias("b"), "conv"))
    order = [*_NODE, "conv"]
    node = "depth long, a long, b long, "
    strings = last.repartitionByRange(*order).sortWithinPartitions(*order).select(*order).mapInArrow(
        _strings, node + "first long, ids string")
    return strings.repartition(*_NODE).sortWithinPartitions(*_NODE, "first").mapInArrow(_hashed, node + "sha string")


def trie(conversations: DataFrame, least: int = LEAST) -> DataFrame:
    """A row for every node of the rebuilt conversations."""
    ship(conversations.sparkSession)
    sequences, lengths = with_shared_heads(*numbered(conversations))
    rows = stored(prefixes(sequences))
    lengths = stored(lengths.withColumn("depth", F.col("depth").cast("long")))
    tree = linked(nodes(rows, lengths))
    below = subtrees(tree, least)
    leaf = (F.col("n_children") == 0).cast("long")
    own = (F.col("n_convs") - 1) * F.col("chars")
    return tree.join(below, "id").join(ends(rows, lengths), _NODE, "left").select(
        F.col("conv").alias("conv_id"), "depth", F.col("parent_conv").alias("parent_conv_id"), "n_convs", "n_children",
        (F.col("inner_leaves") + leaf).alias("n_leaves"), (F.col("inner_saved") + own).alias("saved_tokens"),
        F.coalesce("sha", F.sha2(F.lit(""), 256)).alias("ends_sha256"))
