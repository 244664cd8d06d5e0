"""Operators on rows made by hand: each docstring's defined results."""

import hashlib
import random

import cases
import numpy as np
import pytest
from pyspark.sql import functions as F

from filmgrain.llm import (
    chat, graph, itq, langid, mixing, pieces, pii, sharding, substrings, syncmers, weighted_minhash,
)


@pytest.fixture(scope="module")
def docs(spark):
    return cases.frame(spark).cache()


@pytest.fixture(scope="module")
def none(spark):
    return cases.frame(spark, [])


@pytest.fixture(scope="module")
def field(spark):
    return pii.fit(pii.labelled_table(spark))


# --- personal data

def test_field_adds_checked_spans(field):
    added = lambda t: [(k, t[a:b]) for k, a, b in field.spans(t, pii.base_spans(t))]
    assert added("call me at (743) 555-3824 today") == [("phone", "(743) 555-3824")]
    assert added("write to bob[at]host[dot]com now") == [("email", "bob[at]host[dot]com")]
    assert added("card 4111.1111.1111.1111 ok") == [("card", "4111.1111.1111.1111")]
    assert added("on 2024-05-17 we sold 4821 of 3.14.15 at 12:30") == []


def test_field_adds_every_value_of_a_list(field):
    added = lambda t: [t[a:b] for _, a, b in field.spans(t, pii.base_spans(t))]
    for values, gap in (
        (["212-555-0101", "212-555-0102", "212-555-0103"], ", "), (["(743) 555-3824", "(743) 555-3825"], " "),
        (["4111 1111 1111 1111", "5500 0000 0000 0004"], " "), (["4111.1111.1111.1111", "5500.0000.0000.0004"], ", "),
        (["a[at]b[dot]com", "c[at]d[dot]com"], ", "), (["bob[at]host[dot]com", "ann(at)host(dot)org", "eve[at]host[dot]net"], " "),
        (["192[.]168[.]110[.]115", "192[.]168[.]110[.]116"], " "), (["192(.)168(.)110(.)115", "192(.)168(.)110(.)116"], " "),
    ):
        assert added(f"reach {gap.join(values)} now") == values
    part = lambda kind, t: [t[a:b] for a, b in pii._accepted(kind, t)]
    assert part("card", "1234 4111 1111 1111 1111, 4111-1111-1111-1112 5500 0000 0000 0004") == [
        "4111 1111 1111 1111", "5500 0000 0000 0004"]
    assert part("ip", "10[.]0[.]0[.]999, 10[.]0[.]0[.]2") == ["10[.]0[.]0[.]2"]
    assert part("phone", "212-555-01019 212-555-0102") == ["212-555-0102"]
    # beside a value that the patterns have found
    assert added("write a@b.co, c[at]d[dot]com, e[at]f[dot]com now") == ["c[at]d[dot]com", "e[at]f[dot]com"]


def test_field_is_a_probability_maximum():
    """Viterbi against every labelling of short sentences."""
    import itertools

    rng = np.random.default_rng(0)
    k = len(pii.LABELS)
    text = "a 12 b@c x. 7 (d)"
    s = pii.sentences(text)
    f = pii.Field(np.unique(s.shapes), rng.normal(size=(3, len(np.unique(s.shapes)) + 2, k)).astype(np.float32),
                  rng.normal(size=(k, k)).astype(np.float32), rng.normal(size=k).astype(np.float32))
    own, before, after = f.neighbours(s)
    got = f.decode(s)
    for first, n in zip(s.first, s.length):
        emit = f.emit[0][own] + f.emit[1][before] + f.emit[2][after]
        score = lambda y: f.open[y[0]] + sum(emit[first + t, y[t]] for t in range(n)) + sum(
            f.move[y[t - 1], y[t]] for t in range(1, n))
        best = max(itertools.product(range(k), repeat=int(n)), key=score)
        assert tuple(got[first:first + n]) == best


def test_pii_rows(spark, docs, none, field):
    found = docs.select("doc_id", pii.find(spark, field, F.col("text")).alias("s")).collect()
    assert len(found) == docs.count() and all(r.s is not None for r in found)
    assert none.select(pii.find(spark, field, F.col("text"))).count() == 0
    line = spark.createDataFrame([("a@b.co and 1.2.3.4!",), (None,), ("",)], "text string")
    assert [r[0] for r in line.select(pii.redact(spark, field, F.col("text"))).collect()] == ["<email> and <ip>!", None, ""]
    assert pii.train([]).spans("(743) 555-3824", []) == []


# --- languages

def test_filters_hold_their_languages(spark, docs, none):
    model = langid.fit(docs)
    assert model.languages == ("xx", "yy")
    for r in docs.filter("lang IS NOT NULL AND text IS NOT NULL").collect():
        for gram in langid.grams(r.text):
            assert len(model.masks_of(gram)) == len(gram)
    got = {r.doc_id: r.p for r in docs.select("doc_id", langid.predict(spark, model, F.col("text")).alias("p")).collect()}
    assert all((got[i].lang, got[i].score) == ("und", 0.0) for i in (4, 5, 6, 15))
    assert got[8].lang == "yy" and got[1].lang == "xx"
    assert langid.fit(none).decide("some text") == ("und", 0.0)


def test_filter_has_no_false_negatives_and_corrects_false_positives():
    rng = np.random.default_rng(1)
    grams = rng.integers(0, 2**63, 300_000, dtype=np.uint64)
    lang = np.arange(300_000) % 3
    model = langid.build(["a", "b", "c"], lang, grams, np.ones(300_000))
    for i in range(3):
        assert ((model.masks_of(grams[lang == i])[:, 0] >> i) & 1).all()
    other = model.masks_of(rng.integers(0, 2**63, 100_000, dtype=np.uint64))[:, 0]
    for i in range(3):
        assert abs(np.mean((other >> i) & 1) - model.filled[i] ** langid.HASHES) < 0.01


# --- chat

def test_chat_windows(spark):
    rng = random.Random(2)
    rows = [(c, t, rng.choice(["user", "assistant", "system", None]), "w" * rng.randint(0, 300))
            for c in range(12) for t in range(rng.randint(1, 150))]
    rows += [(None, None, "assistant", None), (5, None, "a\nb<[\\", "x\\l<|end|>[s]"), (3, 1, "user", "tie"), (3, 1, "user", "tie")]
    turns = spark.createDataFrame([(*r, "x") for r in rows], "conv_id long, turn long, role string, text string, window string")
    made = chat.windows(turns, budget=300, history=60)
    back = chat.read_back(made)
    by = {}
    for r in back.collect():
        by.setdefault(r.conv_id, []).append(r)
    want = {}
    for c, t, role, text in rows:
        want.setdefault(c, []).append((2**63 - 1 if t is None else t, role or "", text or ""))
    assert by.keys() == want.keys()
    for c, turns_ in want.items():
        windows = sorted(by[c], key=lambda r: r.window)
        assert [(t.role, t.text) for w in windows for t in w.turns] == [x[1:] for x in sorted(turns_)]
        assert "".join(w.loss for w in windows) == "".join(x[2] for x in sorted(turns_) if x[1] == "assistant")
    size = lambda text: (len(text) + 3) // 4 + chat.MARKUP_TOKENS
    for r in made.collect():
        texts = [p.split("\n", 1)[1] for p in r.formatted.split(chat.END)[:-1]]
        if r.n_turns - r.n_context > 1:  # a single turn may exceed the budget
            assert sum(size(t) for t in texts) <= 300 + 4 * len(texts)
    assert chat.windows(turns.filter("false")).count() == 0


# --- repeats, fingerprints, near-duplicates

def plain_repeats(rows):
    split = [(i, (t or "").encode().split()) for i, t in rows]
    first = {}
    for i, w in split:
        for k in range(len(w) - 12):
            if i is not None:
                key = tuple(w[k:k + 13])
                first[key] = min(first.get(key, i), i)
    out = []
    for i, w in split:
        gone = {p for k in range(len(w) - 12) if i is not None and first[tuple(w[k:k + 13])] < i for p in range(k, k + 13)}
        kept = b" ".join(x for p, x in enumerate(w) if p not in gone)
        out.append((i, len(w), len(gone), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def test_repeats(spark, docs, none):
    rng = random.Random(9)
    shared = [cases.words(rng.randint(10, 40), 100 + i) for i in range(6)]
    some = [(i, " ".join([cases.words(rng.randint(0, 30), i), rng.choice(shared), cases.words(5, -i), rng.choice(shared)]))
            for i in range(120)]
    for rows in (some, [(r.doc_id, r.text) for r in docs.collect()]):
        frame = spark.createDataFrame([(*r, 1, "t") for r in rows], "doc_id long, text string, tag long, packed string")
        got = substrings.remove_repeats(frame)
        assert sorted(((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in got.collect()), key=str) == plain_repeats(rows)
        for r in got.collect():
            assert hashlib.sha256(r.kept.encode()).hexdigest() == r.kept_sha256
            assert sum(s.end - s.start for s in r.repeats) == r.n_removed
    assert substrings.remove_repeats(none).count() == 0


def test_shared_anchors_across_batches():
    import pyarrow as pa

    rng = np.random.default_rng(3)
    key = np.sort(rng.integers(0, 40, 400))
    ids = np.concatenate([np.sort(rng.integers(0, 3, (key == k).sum())) for k in range(40)])
    table = pa.table({"anchor": key, "id": ids, "pos": np.arange(400, dtype=np.int32)})
    many = {k for k in range(40) if len(set(ids[key == k])) > 1}
    for size in (1, 2, 7, 400):
        got = [p for b in substrings._shared(iter(table.to_batches(max_chunksize=size))) for p in b.column("pos").to_pylist()]
        assert sorted(got) == [p for p in range(400) if key[p] in many]


def test_syncmers_do_not_depend_on_context(monkeypatch):
    text = cases.words(300, 20)
    where, what = syncmers.anchors(text)
    found = {(int(h), text[p:p + syncmers.K]) for p, h in zip(where, what)}
    inner = cases.words(40, 21) + text + cases.words(40, 22)
    moved, again = syncmers.anchors(inner)
    assert found <= {(int(h), inner[p:p + syncmers.K]) for p, h in zip(moved, again)}
    monkeypatch.setattr(syncmers, "PIECE", 64)
    pieced = syncmers.anchors(text)
    assert np.array_equal(pieced[0], where) and np.array_equal(pieced[1], what)


def test_syncmer_rows(spark, docs, none):
    got = syncmers.against_next(docs, partitions=5).collect()
    assert len(got) == docs.count() and all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in got)
    by = {r.doc_id: r for r in got}
    assert by[4].fingerprint == by[5].fingerprint == "" and by[1].fingerprint == by[2].fingerprint
    assert by[1].near_next == 1.0 and by[4].near_next == 1.0 and by[4].n_chars == 0
    assert syncmers.against_next(none).count() == 0
    one = syncmers.against_next(docs.filter("doc_id = 1")).collect()
    assert len(one) == 1 and one[0].near_next == 1.0


def test_fingerprints_hold_every_syncmer():
    text = cases.words(20_000, 23)
    where, what = syncmers.anchors(text)
    listed = syncmers.written(syncmers.sketch(text)).split(",")
    assert listed == [f"{p}:{int(h) >> 24:010x}" for p, h in zip(where, what)] and len(listed) > 10_000
    edited = text[:-len(text) // 100] + cases.words(200, 24)
    assert syncmers.written(syncmers.sketch(edited)) != ",".join(listed)
    assert 0.9 < syncmers.likeness(syncmers.sketch(text), syncmers.sketch(edited)) < 1
    # a passage of 50 words, at another place of each text
    passage = cases.words(50, 25)
    one, two = (syncmers.sketch(" ".join([cases.words(n, n), passage, cases.words(5000, -n)])) for n in (3000, 3100))
    own = len(syncmers.anchors(passage)[0])
    share = own / (len(one[0]) + len(two[0]) - own)
    assert 0.8 * share < syncmers.likeness(one, two) < 1.3 * share and syncmers.likeness(one, two) == syncmers.likeness(two, one)
    # a repeated anchor counts at each of its places
    twice = passage + " . " + passage
    assert len(syncmers.sketch(twice)[0]) > 1.9 * own
    assert abs(syncmers.likeness(syncmers.sketch(passage), syncmers.sketch(twice)) - 0.5) < 0.05


def test_near_duplicate_rows(spark, docs, none):
    got = sorted((r.doc_id is None, r.doc_id or 0, r.class_id, r.kept) for r in weighted_minhash.label(docs).collect())
    by = {i: (c, k) for missing, i, c, k in got if not missing and i != 12}
    assert by[1] == (1, True) and by[2] == (1, False) and by[3] == (1, False)
    assert by[4] == (4, True) and by[5] == (5, True) and by[7] == (7, True) and by[8] == (8, True)
    kept = weighted_minhash.keep_one(docs)
    assert kept.columns == docs.columns
    ids = [r.doc_id for r in kept.collect()]
    assert sorted(i for i in ids if i is not None) == [1, 4, 5, 6, 7, 8, 9, 10, 12, 12, 13, 14, 15] and ids.count(None) == 1
    assert weighted_minhash.label(none).count() == 0 and weighted_minhash.keep_one(none).count() == 0


def test_sampling_estimates_weighted_similarity():
    rng = np.random.default_rng(8)
    keys = rng.integers(0, 2**63, 400, dtype=np.uint64)
    a, b = rng.uniform(1, 2, 400), rng.uniform(1, 2, 400)
    agree = []
    for shift in range(30):
        k = np.sort(weighted_minhash.mix(keys + np.uint64(shift)))
        x, y = weighted_minhash.samples(k[:300], a[:300]), weighted_minhash.samples(k[60:], b[60:])
        agree.append(np.mean((x[0] == y[0]) & (x[1] == y[1])))
    low = np.minimum(a, b)[60:300].sum()
    want = low / (a[:300].sum() + b[60:].sum() - low)
    assert abs(np.mean(agree) - want) < 0.05


def test_bucket_groups_equal_all_pairs():
    base = cases.words(100, 30).encode().split()
    rng = random.Random(1)
    texts = []
    for i in range(80):
        w = list(base)
        for _ in range(rng.randint(0, 6)):
            w[rng.randrange(100)] = b"%d" % rng.randrange(10**6)
        texts.append(b" ".join(w))
    weight = np.ones(weighted_minhash.SLOTS, dtype=np.float32)
    import zstandard
    pairs = list(weighted_minhash._linked([(i, zstandard.compress(t)) for i, t in enumerate(texts)], weight, 0.8))
    sets = [set(weighted_minhash.shingles(t)[0].tolist()) for t in texts]

    def groups(edges):
        parent = list(range(80))
        for a, b in edges:
            x, y = a, b
            while parent[x] != x:
                x = parent[x]
            while parent[y] != y:
                y = parent[y]
            parent[max(x, y)] = min(x, y)
        root = lambda i: i if parent[i] == i else root(parent[i])
        return [root(i) for i in range(80)]

    assert groups(pairs) == groups((i, j) for i in range(80) for j in range(i) if
                                   len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j]))
    assert len(pairs) < 80


# --- vectors

def test_links_equal_all_pairs_and_recall(spark):
    rng = np.random.default_rng(4)
    centre = rng.normal(size=(12, 16))
    rows = []
    for i in range(400):
        v = centre[i % 12] + 0.06 * rng.normal(size=16)
        rows.append((i, v.tolist(), int(i % 12) % 3, "x"))
    rows += [(400, rows[0][1], 0, "x"), (401, None, 1, "x"), (402, [0.0] * 16, 1, "x"), (403, [1.0, None], 1, "x"),
             (404, [float("nan")] * 16, 0, "x"), (405, rows[0][1], None, "x"), (406, [], 0, "x"), (407, [3.0], 0, "x"),
             (408, [5.0], 0, "x"), (None, rows[0][1], 0, "x"), (409, [1e300] * 16, 0, "x"), (410, [1e-300] * 16, 0, "x")]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int, key string")
    got = {r.vec_id: r for r in itq.links(frame, block=64).collect()}
    good = [(i, np.array(v), y) for i, v, y, _ in rows if i is not None and y is not None and v is not None
            and None not in v and len(v) > 0 and np.isfinite(v).all() and np.any(v)]
    unit = {i: v / np.abs(v).max() / np.linalg.norm(v / np.abs(v).max()) for i, v, _ in good}
    pairs = [(a, b) for a, va, x in good for b, vb, y in good
             if a != b and x == y and len(va) == len(vb) and unit[a] @ unit[b] >= 0.98]
    want = {i: 0 for i, *_ in rows}
    for a, _ in pairs:
        want[a] += 1
    found = sum(r.n_links for r in got.values())
    assert len(got) == len(rows) and found >= 0.99 * len(pairs) and all(got[i].n_links <= want[i] for i in want)
    assert all(got[i].n_links == 0 and got[i].component_id == i for i in (401, 402, 403, 404, 405, 406))
    assert got[407].n_links == got[408].n_links == 1 and got[408].component_id == 407
    assert got[400].component_id == got[0].component_id
    assert itq.links(frame.filter("false")).count() == 0


def test_components(spark):
    rng = random.Random(6)
    edges = [(i, i + 1) for i in range(40)] + [(100 - i, 99 - i) for i in range(30)] + [(200, 200 + i) for i in range(50)]
    edges += [(5, 5), (7, 6), (7, 6)]
    rng.shuffle(edges)
    got = {r.id: r.component for r in graph.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(41)}, **{i: 70 for i in range(70, 101)}, **{i: 200 for i in range(200, 250)}}
    assert graph.components(spark.createDataFrame([], "a long, b long")).count() == 0


# --- mixing and shards

def test_targets_and_tree():
    assert mixing.targets([100, 100], [1, 1]) == [150, 150]
    assert mixing.targets([10, 100, 0], [5, 2, 1]) == [20, 145, 0]
    assert mixing.targets([], []) == [] and mixing.targets([0], [5]) == [0]
    tree = mixing.splitting_tree([1000, 7, 0, 250], 8, 3)
    assert tree.sum(axis=0).tolist() == [1000, 7, 0, 250] and np.ptp(tree.sum(axis=1)) <= 1
    assert (mixing.splitting_tree([1000, 7, 0, 250], 8, 3) == tree).all()
    assert np.ptp(mixing.splitting_tree([80_000, 40_000], 8, 1)[:, 0]) < 800  # shards hold the same mixture


def test_mixture_rows(spark, docs, none):
    mixed = mixing.mix(docs)
    rows = mixed.collect()
    assert len(rows) == docs.count() and all(len(r.takes) <= 2 for r in rows)
    drawn = mixing.drawn(docs, mixed)
    assert drawn.columns == docs.columns and drawn.count() == sum(len(r.takes) for r in rows)
    assert all(not r.takes for r in rows if r.size == 0)
    assert mixing.mix(none).count() == 0 and mixing.drawn(none, mixing.mix(none)).count() == 0


def test_mixture_meets_targets(spark):
    rng = random.Random(7)
    rows = [(i, "w " * rng.randint(1, 60), rng.choice("abcc")) for i in range(3000)]
    mixed = mixing.mix(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()
    for source in "abc":
        own = [r for r in mixed if r.source == source]
        assert abs(sum(r.size * len(r.takes) for r in own) - own[0].target) <= 2
    shards = {}
    for r in mixed:
        for t in r.takes:
            shards.setdefault(t.shard, []).append(r.source)
    share = [s.count("c") / len(s) for s in shards.values()]
    assert len(shards) == 8 and max(share) - min(share) < 0.15


def test_mixture_passes_by_a_document_longer_than_the_need(spark):
    rng = random.Random(11)
    short = [rng.randint(20, 60) for _ in range(300)]
    order = lambda i, text: hashlib.md5(f"17:{i}:{hashlib.md5(text.encode()).hexdigest()}".encode()).hexdigest()
    long_ = "w " * 40_000
    first = min(range(10**6, 10**6 + 2000), key=lambda i: order(i, long_))  # stands before nearly all others
    rows = [(first, long_, "a")] + [(i, "w " * n, "a") for i, n in enumerate(short)] + [(5000 + i, "w " * 100, "b") for i in range(300)]
    mixed = mixing.mix(spark.createDataFrame(rows, "doc_id long, text string, source string"), weights=(1, 1), share=0.5).collect()
    own = [r for r in mixed if r.source == "a"]
    assert 40_000 > own[0].target > sum(short)
    assert abs(sum(r.size * len(r.takes) for r in own) - own[0].target) < 60  # short ones, once and then again
    assert all(len(r.takes) == 0 for r in own if r.doc_id == first)
    shards = [t.shard for r in own for t in r.takes]
    assert len(set(shards)) == 8 and max(shards.count(i) for i in range(8)) < 0.3 * len(shards)


def test_shard_rows(spark, docs, none):
    rows = sharding.interleave(docs, shards=4).collect()
    assert len(rows) == docs.count()
    for shard in range(4):
        slots = sorted(r.slot for r in rows if r.shard == shard)
        assert slots == list(range(len(slots))) and len(slots) in (docs.count() // 4, docs.count() // 4 + 1)
    assert sharding.interleave(none).count() == 0
    big = spark.range(5000).selectExpr("id as doc_id", "if(id % 3 = 0, 'hot', string(id % 7)) as source", "'x' as text")
    share = sharding.interleave(big).groupBy("shard").agg(F.avg((F.col("source") == "hot").cast("int")).alias("s"))
    assert all(abs(r.s - 1 / 3) < 0.01 for r in share.collect())


# --- pieces

def test_pieces_are_the_best_path():
    v = pieces.read_vocabulary()
    codec = pieces.Codec(v)
    score = {i: s for i, _, s in v.pieces}
    known = {p: s for _, p, s in v.pieces}
    rng = random.Random(3)
    for _ in range(400):
        text = "".join(rng.choice(" thean\néß日▁\U0001F600xq1.,") for _ in range(rng.randint(1, 40)))
        whole = " " + text
        best = [0.0]
        for end in range(1, len(whole) + 1):
            ways = [best[b] + known[whole[b:end]] for b in range(max(0, end - 16), end) if whole[b:end] in known]
            if whole[end - 1] not in known:
                ways.append(best[end - 1] + codec.byte_score * len(whole[end - 1].encode()))
            best.append(max(ways))
        ids = codec.encode(text).tolist()
        assert abs(sum(score.get(i, codec.byte_score) for i in ids) - best[-1]) < 1e-6 and codec.decode(ids) == text
        assert codec.best([text])[text] == codec.encode(text).tobytes()  # split and whole are one


def test_pieces_of_other_vocabularies():
    whole = pieces.Vocabulary(((1, "a", -1.0), (2, "a b", -1.5), (3, "b", -1.0), (4, " ", -1.0)), None, 0, 5)
    codec = pieces.Codec(whole)
    assert not codec.splits and codec.encode("a bz").tolist() == [4, 2, 0]
    assert pieces.Codec(pieces.Vocabulary((), None, 0, 1)).encode("ab").tolist() == [0, 0, 0]


def test_piece_rows(spark, docs, none):
    v = pieces.read_vocabulary()
    coded = docs.withColumn("ids", pieces.encode(spark, v, F.col("text")))
    rows = coded.select("text", "ids", pieces.decode(spark, v, F.col("ids")).alias("back")).collect()
    assert all(r.back == r.text for r in rows) and all((r.ids is None) == (r.text is None) for r in rows)
    assert none.select(pieces.encode(spark, v, F.col("text"))).count() == 0


# --- the pipeline

def test_pipeline_stages(spark, docs, none):
    import corpus_pipeline as c

    names = docs.columns
    language = c.language(spark, docs, "")
    assert language.columns == names
    rows = language.collect()
    assert {r.doc_id for r in rows} == {r.doc_id for r in docs.collect()} - {4, 5, 6, 15} and all(r.lang for r in rows)
    hidden = c.personal_data(spark, docs.withColumn("text", F.concat("text", F.lit(" a@b.co"))), "")
    assert hidden.columns == names
    assert all(r.text is None or (r.text.endswith(" <email>") and r.n_chars == len(r.text)) for r in hidden.collect())
    assert c.near_duplicates(spark, docs, "").columns == c.mixture(spark, docs, "").columns == names
    assert c.encoded(spark, docs, "").columns == [*names, "piece_ids"]
    for _, stage in c.STAGES:
        assert stage(spark, none, "").count() == 0


def test_pipeline_runs(spark, folder):
    import corpus_pipeline as c

    out = c.run(spark, folder)
    assert out.columns == ["doc_id", "text", "lang", "source", "n_chars", "piece_ids"]
    v = pieces.read_vocabulary()
    assert out.filter(~pieces.decode(spark, v, F.col("piece_ids")).eqNullSafe(F.col("text"))).count() == 0
    assert out.count() > 0


def test_no_window_exceeds_the_budget(spark):
    """Unless a single turn does, with the system turn."""
    rng = random.Random(6)
    rows = [(1, 0, "system", "s" * 400), (1, 1, "user", "u" * 900), (1, 2, "assistant", "a" * 3500),
            (2, 0, "system", "s" * 3100)] + [(2, t, "user", "x" * 200) for t in range(1, 9)]
    rows += [(3 + c, t, rng.choice(["user", "assistant", "system"]), "w" * rng.randint(0, 3000)) for c in range(20) for t in range(40)]
    made = chat.windows(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).collect()
    tokens = lambda text: (len(text) + 3) // 4 + chat.MARKUP_TOKENS
    over = 0
    for r in made:
        turns = [t.split("\n", 1) for t in r.formatted.replace(chat.BEGIN, "").split(chat.END)[:-1]]
        own = [tokens(text) for _, text in turns[r.n_context:]]
        context = [(role, tokens(text)) for role, text in turns[:r.n_context]]
        total = sum(own) + sum(n for _, n in context)
        if total > 1024:
            over += 1
            assert len(own) == 1 and all(role == "system" for role, _ in context) and len(context) <= 1
    assert over < len(made) / 4


def test_long_words_that_differ_are_different(spark):
    """Words built so that a polynomial modulo a power of two cannot tell them apart."""
    one = "a"
    for _ in range(10):
        one += one.translate(str.maketrans("ab", "ba"))
    two = one.translate(str.maketrans("ab", "ba"))
    shared = " ".join(f"w{i}" for i in range(12))
    docs = spark.createDataFrame([(1, f"{shared} {one}"), (2, f"{shared} {two}"), (3, f"{shared} {one}")], "doc_id long, text string")
    assert {r.doc_id: r.n_removed for r in substrings.remove_repeats(docs).collect()} == {1: 0, 2: 0, 3: 13}


def test_passages_that_a_batch_settles(spark):
    """A passage in most documents, over small and large batches and partitions, against removal window by window."""
    rng = random.Random(4)
    passages = [cases.words(30, s) for s in range(3)]
    texts = []
    for i in range(120):
        parts = [cases.words(rng.randint(3, 20), 1000 + i)]
        if i % 10:
            parts.insert(rng.randint(0, 1), passages[0])
        if i % 7 == 0:
            parts.append(passages[1])
        if i in (5, 90):
            parts.append(passages[2])
        texts.append((i, " ".join(parts)))
    rng.shuffle(texts)
    seen, want = {}, {}
    for i, text in sorted(texts):
        own = text.split()
        windows = [tuple(own[j:j + 13]) for j in range(len(own) - 12)]
        gone = {j + d for j, w in enumerate(windows) if seen.get(w, i) < i for d in range(13)}
        want[i] = len(gone)
        for w in windows:
            seen.setdefault(w, i)
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    batch = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    for size, parts in (("3", 4), ("1000", 1), ("1", 7)):
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", size)
        try:
            got = {r.doc_id: r.n_removed for r in substrings.remove_repeats(docs.repartition(parts), partitions=5).collect()}
        finally:
            spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)
        assert got == want, (size, parts)


def test_tables_grow_with_the_label():
    tables, bits = zip(*(itq.layout(n) for n in (0, 100, 4000, 16_000, 10**6, 10**9)))
    assert list(bits) == sorted(bits) and list(tables) == sorted(tables) and bits[2] == 12 and bits[-1] == 30
    assert all((1 - (1 - np.arccos(0.98) / np.pi) ** b) ** t <= itq.MISSED for t, b in zip(tables, bits))


@pytest.mark.parametrize("dim", [8, 32, 200])
def test_recall_on_several_dimensions(spark, dim):
    rng = np.random.default_rng(dim)
    base = rng.standard_normal((600, dim))
    near = base[:300] + rng.standard_normal((300, dim)) * 0.15
    rows = [(i, v.tolist(), 0) for i, v in enumerate(np.concatenate([base, near]))]
    got = {r.vec_id: r.n_links for r in itq.links(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")).collect()}
    unit = np.array([v for _, v, _ in rows])
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    want = (unit @ unit.T >= 0.98).sum(axis=1) - 1
    assert want.sum() > 100 and sum(got.values()) >= 0.99 * want.sum() and all(got[i] <= want[i] for i in got)
