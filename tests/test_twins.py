"""Two ways to the same result must agree."""

import itertools
import random
from collections import Counter
from types import SimpleNamespace

import numpy as np
import pytest

from filmgrain.operators import clusters, documents, itemsets, joins
from filmgrain.plans import integration as gav
from filmgrain.plans import relational as rel
from filmgrain.plans.inventory import joins as join_queries
from filmgrain.plans.views import Catalogue


@pytest.fixture(scope="module")
def v(spark, folder):
    return Catalogue(spark, folder)


def brute_sets(rows, least):
    baskets = {}
    for b, i in rows:
        baskets.setdefault(b, set()).add(i)
    counts = Counter()
    for items in baskets.values():
        for n in range(1, 5):
            counts.update(itertools.combinations(sorted(items), n))
    return {s: c for s, c in counts.items() if c > least}


def random_baskets(huge: int):
    """Baskets of a few items, and ``huge`` baskets that hold about a third of all rows each."""
    rnd = random.Random(huge)
    rows = {(b, rnd.randrange(18)) for b in range(60) for _ in range(rnd.randrange(1, 6))}
    rows |= {(1000 + h, i) for h in range(huge) for i in range(18) if rnd.random() < 0.9}
    return sorted(rows)


@pytest.mark.parametrize("huge", [0, 1, 2, 4, 7])
def test_itemsets_with_huge_baskets(spark, huge):
    rows = random_baskets(huge)
    least = 3
    df = spark.createDataFrame(rows, "basket int, item int")
    want = {s: c for s, c in brute_sets(rows, least).items()}
    found = itemsets.levels(df, least, max_level=4)
    got = {tuple(r["items"]): r["support"] for r in itemsets.as_sets(found).collect()}
    assert got == want
    p = itemsets.prepare(df, least)
    assert p.set_aside == least and p.rows.select("basket").distinct().count() <= len({b for b, _ in rows}) - least
    few = itemsets._support(itemsets.hopeful_pairs(p, counters=3), 2, least)  # counters that nearly all pairs share
    assert {(r["item1"], r["item2"]): r["support"] for r in few.collect()} == {s: n for s, n in want.items() if len(s) == 2}


def nested_loop(rows):
    """Pairs of rows with the same basket, the smaller item first."""
    baskets = {}
    for b, i in rows:
        if b is not None and i is not None:
            baskets.setdefault(b, []).append(i)
    return sorted((b, x, y) for b, items in baskets.items() for x in items for y in items if x < y)


@pytest.mark.parametrize("block", [1, 4, 500])
def test_theta_self_forms_each_pair_once(spark, block):
    rows = random_baskets(3) + random_baskets(3)[::7]
    df = spark.createDataFrame(rows, "basket int, item int")
    pairs = joins.theta_self(df, "basket", "item", df.groupBy("basket").agg({"item": "count"}).toDF("basket", "n"), block)
    assert sorted(map(tuple, pairs.collect())) == nested_loop(rows)


def test_theta_self_join_pairs_all_baskets(spark, monkeypatch):
    """The largest baskets, items that are rare, rows that come twice and rows without a key are joined as in SQL."""
    rows = random_baskets(7) + [(1000, i) for i in range(0, 18, 2)] + [(2, 100), (2, 101)]
    rows += [(None, i) for i in range(18)] + [(1001, None), (3, None)]
    formed = []
    join = joins.theta_self
    monkeypatch.setattr(joins, "theta_self", lambda *given: formed.append(join(*given)) or formed[-1])
    monkeypatch.setattr(itemsets, "BLOCK_ROWS", 5)
    found = join_queries.join_theta_self(SimpleNamespace(baskets=spark.createDataFrame(rows, "basket int, item int")))
    want = nested_loop(rows)
    counts = Counter((x, y) for _, x, y in want)
    assert found.columns == ["item1", "item2", "support"]
    assert sorted(map(tuple, found.collect())) == sorted((*p, n) for p, n in counts.items() if n > 5) != []
    assert [sorted(map(tuple, pairs.collect())) for pairs in formed] == [want]


@pytest.mark.parametrize("huge", [0, 1, 2])
def test_fp_growth_agrees(spark, huge):
    rows = random_baskets(huge)
    df = spark.createDataFrame(rows, "basket int, item int")
    sets = lambda d: {tuple(r["items"]): r["support"] for r in d.collect()}
    assert sets(itemsets.fp_growth(df, 4)) == sets(itemsets.as_sets(itemsets.levels(df, 4)))


def test_support_never_grows_with_size(spark, v):
    found = itemsets.levels(v.baskets)
    support = {tuple(r["items"]): r["support"] for r in itemsets.as_sets(found).collect()}
    for items, n in support.items():
        for sub in itertools.combinations(items, len(items) - 1):
            assert not sub or support[sub] >= n


def test_kmeans_against_numpy(spark):
    rnd = np.random.default_rng(5)
    pts = np.round(rnd.random((400, 2)), 2)
    rows = [("g", i, float(x), float(y)) for i, (x, y) in enumerate(pts)]
    feats = spark.createDataFrame(rows, "label string, _id int, x double, y double")
    start = {i: (float(x), float(y)) for i, (x, y) in enumerate(pts[:6], 1)}
    before, after = clusters.fit(clusters.weighted_points(feats), feats, {("g", 6): start}, 40)
    c = pts[:6].copy()
    for _ in range(40):
        near = np.sqrt(((pts[:, None] - c[None]) ** 2).sum(-1)).argmin(1)
        c = np.array([pts[near == j].mean(0) for j in range(6)])
    got = np.array([after[("g", 6)][i] for i in range(1, 7)])
    assert np.allclose(got, c)


def test_sse_does_not_rise(spark):
    rnd = np.random.default_rng(6)
    pts = np.round(rnd.random((300, 2)), 2)
    feats = spark.createDataFrame(
        [("g", i, float(x), float(y)) for i, (x, y) in enumerate(pts)], "label string, _id int, x double, y double"
    )
    points = clusters.weighted_points(feats)
    runs = {("g", 5): {i: tuple(map(float, p)) for i, p in enumerate(pts[:5], 1)}}
    last = float("inf")
    for n in (1, 2, 3, 6):
        sse = clusters.inertia(points, *clusters.fit(points, feats, runs, n)).first()["sse"]
        assert sse <= last + 1e-9
        last = sse


def test_many_runs_at_once_equal_single_runs(spark):
    rnd = np.random.default_rng(7)
    rows = [(g, i, float(x), float(y)) for g in "ab" for i, (x, y) in enumerate(np.round(rnd.random((80, 2)), 1))]
    feats = spark.createDataFrame(rows, "label string, _id int, x double, y double")
    points = clusters.weighted_points(feats)
    runs = clusters.initial_all(feats, {"a": [3, 5], "b": [4]})
    together = clusters.fit(points, feats, runs, 8)[1]
    for run, start in runs.items():
        assert clusters.fit(points, feats, {run: start}, 8)[1][run] == together[run]


def test_a_title_is_one_document(spark, v):
    lists = {"producer_id": v.title_producer, "director_id": v.title_director}
    docs = documents.assemble(v.title, lists, (v.title_actor, v.actor_title_role, v.role))
    assert docs.count() == v.title.count() == docs.select("_id").distinct().count()
    entries = documents.unwind(docs.select("_id", "producer_id"), "producer_id")
    assert sorted(map(tuple, entries.collect())) == sorted(map(tuple, v.title_producer.collect()))


def test_view_forms_agree(spark, v, tmp_path):
    kind, args = "PROMO", {"after": 1996, "before": 2000, "least": 3}
    src = gav.sources(v.member, v.title, v.title_genre, v.genre, v.title_actor, kind)
    rows = lambda df: sorted(map(tuple, df.collect()))
    virtual_schema = gav.over_views(src, v.title_genre, v.genre, kind)
    direct_schema = gav.over_tables(v.member, v.title, v.title_genre, v.genre, v.title_actor, kind)
    virtual = rows(gav.prolific(virtual_schema, **args))
    assert virtual and virtual == rows(gav.prolific(direct_schema, **args))
    prefix = rows(gav.prefix_actors(virtual_schema, kind, "sm"))
    assert prefix and prefix == rows(gav.prefix_actors(direct_schema, kind, "sm"))

    stored = gav.materialise(src, "twin_", str(tmp_path))
    assert virtual == rows(gav.prolific(gav.over_views(stored, v.title_genre, v.genre, kind), **args))
    # a stored view is not refreshed
    again = gav.materialise(gav.Sources(*[df.limit(0) for _, df in src.items()]), "twin_", str(tmp_path))
    assert again.acted_in.count() == src.acted_in.count() > 0


def test_views_share_nobody(spark, v):
    src = gav.sources(v.member, v.title, v.title_genre, v.genre, v.title_actor, "PROMO")
    assert src.comedy_actor.join(src.non_comedy_actor, "id").count() == 0
    assert src.comedy_movie.join(src.non_comedy_movie, "id").count() == 0
    for _, df in src.items():
        assert df.distinct().count() == df.count()


def test_relational_and_document_form_agree(spark, v):
    from filmgrain.plans import document_queries as docq
    from filmgrain.plans.inventory.documents import docs_with

    by_name = rel.genre_year_producers(
        v.member, v.title_producer, v.title.withColumn("endYear", v.title.startYear), v.title_genre, v.genre,
        "00001", 1997, "PROMO", keep_count=True,
    )
    docs = docs_with(v, "genres", "producer_id")
    made = docq.producers_with_many(
        documents.heads(docs), documents.links(docs, "genres", "genre"),
        documents.links(docs, "producer_id", "producerid"), v.member, 1997, "PROMO", ".*00001.*", 1,
    )
    assert {(r["name"], r["total"]) for r in by_name.collect()} == {(r["name"], r["count"]) for r in made.collect()}


def test_reports_from_documents_equal_reports_from_tables(spark, v):
    from filmgrain.plans import document_queries as docq
    from filmgrain.plans.inventory.documents import docs_with

    docs = docs_with(v, "genres", "actors")
    genres = documents.links(docs, "genres", "genre")
    cast, roles = documents.cast_links(docs)
    same = lambda a, b: sorted(map(str, a.collect())) == sorted(map(str, b.collect()))
    assert same(docq.genre_cast(genres, cast), docq.genre_cast(v.labelled_genre, v.title_actor))
    assert same(docq.genre_boxplot(documents.heads(docs), genres), docq.genre_boxplot(v.title, v.labelled_genre))
    assert same(docq.year_count(documents.heads(docs)), docq.year_count(v.title))
    assert roles.count() == v.actor_title_role.count()


def test_salted_join_has_the_same_result(spark):
    from filmgrain.operators import joins, keys

    many = spark.range(3000).selectExpr("CASE WHEN id % 3 = 0 THEN 7 ELSE id % 40 END AS k", "id AS v")
    one = spark.range(30).selectExpr("id AS k", "id * 2 AS z")
    rows = lambda df: sorted(map(str, df.collect()))
    for how in ("inner", "left", "left_semi", "left_anti"):
        assert rows(joins.join_salted(many, one, ["k"], how)) == rows(many.join(one, ["k"], how))
    winners, losers = keys.split_key(many, ["k"], ["v"])
    assert winners.count() == 40 and losers.count() == 3000 - 40
