"""The prefix trie against one built with dictionaries."""

import hashlib
import math
import random
import zlib
from collections import defaultdict

import pytest

from filmgrain.llm import tries


def by_hand(rows):
    convs = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            digest = hashlib.md5(f"{len(role.encode())}:{role}{text}".encode()).digest()
            convs[c].append((turn is not None, turn or 0, role, digest, text))
    convs = {c: [(r, x) for _, _, r, _, x in sorted(v)] for c, v in convs.items()}
    members, ended, kids = defaultdict(list), defaultdict(list), defaultdict(list)
    for c, own in convs.items():
        h = zlib.crc32(str(c).encode()) % 6
        whole = convs.get(c - int(math.fmod(c, 100)), [])[:h] + own[h:]
        for d in range(len(whole) + 1):
            members[tuple(whole[:d])].append(c)
        ended[tuple(whole)].append(c)
    for path in members:
        if path:
            kids[path[:-1]].append(path)
    leaves, saved = {}, {}
    for path in sorted(members, key=len, reverse=True):
        leaves[path] = sum(leaves[k] for k in kids[path]) or 1
        saved[path] = sum(saved[k] for k in kids[path]) + ((len(members[path]) - 1) * len(path[-1][1]) if path else 0)
    return sorted((
        min(m), len(p), min(members[p[:-1]]) if p else -10**9, len(m), len(kids[p]), leaves[p], saved[p],
        hashlib.sha256(",".join(map(str, sorted(ended.get(p, [])))).encode()).hexdigest()) for p, m in members.items())


def built(spark, rows, least=tries.LEAST):
    frame = spark.createDataFrame(
        [(*r, 7, "x", "n") for r in rows],
        "conv_id long, turn long, role string, text string, id long, block string, depth string")
    return sorted(tuple(-10**9 if v is None else v for v in r) for r in tries.trie(frame, least).collect())


def some(seed, convs, turns, words):
    rng = random.Random(seed)
    rows = []
    for c in rng.sample(range(-350, 350), convs):
        for t in range(rng.randint(1, turns)):
            rows.append((c, t, rng.choice(["user", "assistant"]), rng.choice(words)))
    return rows


def test_small_blocks_and_many_rounds(spark, monkeypatch):
    """Stretches of few arcs, ranked by coins to the last one."""
    rows = some(1, 60, 9, ["a", "bb", "ccc"])
    assert built(spark, rows) == by_hand(rows)
    monkeypatch.setattr(tries, "BLOCK_BITS", 2)
    assert built(spark, rows, least=40) == by_hand(rows)


def test_rounds_to_the_last_stretch(spark, monkeypatch):
    rows = some(2, 12, 4, ["a", "b"])
    monkeypatch.setattr(tries, "BLOCK_BITS", 1)
    assert built(spark, rows, least=1) == by_hand(rows)


def test_nulls_ties_repeats_and_long_ones(spark, monkeypatch):
    monkeypatch.setattr(tries, "CHUNK", 3)
    rows = [(5, None, None, None), (5, 2, "user", "x"), (5, 2, "user", "x"), (5, 2, "assistant", "y"), (None, 0, "user", "z"),
            (7, 0, "", "é\U0001F600"), (100, 0, "user", ""), (100, 1, "userq", "a"), (101, 0, "user", "qa"), (101, None, "z", "z"),
            (-101, 0, "user", "m"), (-100, 3, "user", "n"), (2**62, 1, "user", "far"), (300, 0, "user", "w" * 300_000)]
    rows += [(400 + i, t, "user", f"same {t}") for i in range(40) for t in range(3)]
    rows += [(700, t, "user", str(t % 3)) for t in range(3000)]  # one long conversation
    assert built(spark, rows) == by_hand(rows)


def test_nothing(spark):
    assert built(spark, []) == [] == built(spark, [(None, 1, "user", "x")])


def test_a_conversation_over_many_sorted_blocks(spark):
    """Places and sums carry over from block to block."""
    rows = [(c, t, "user", str(t * c % 5)) for c in (100, 101, 160) for t in range(400)]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        turns = tries.numbered(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))[0]
        assert turns.groupBy("conv").agg({"block": "max"}).count() == 3 and turns.select("block").distinct().count() > 3
        assert built(spark, rows) == by_hand(rows)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


@pytest.mark.parametrize("sizes", [(9, 3), (40, 20)])
def test_random_forests(spark, sizes):
    rows = some(sum(sizes), *sizes, ["p", "q"])
    assert built(spark, rows) == by_hand(rows)
