"""Stored tables, the keyed store, file positions and rejects, sampling, sketches: what a query's rows do not show."""

import re
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from filmgrain import schemas
from filmgrain.operators import keys, selection, updates
from filmgrain.operators.store import Collection
from filmgrain.plans import document_queries, etl, integration, registry, relational
from filmgrain.plans.inventory import integration as inventory
from filmgrain.plans.stored import LAYOUT, StoredCatalogue
from filmgrain.plans.views import Catalogue
from filmgrain.sources import readers, writers


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def v(spark, folder):
    return Catalogue(spark, folder)


@pytest.fixture
def no_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


# --- the catalogue

def test_links_join_titles_without_a_shuffle(spark, folder, v, no_broadcast):
    registry.load()
    exchanged = lambda name: re.findall(r"Exchange hashpartitioning\((\w+)#", plan(registry.RUN[name](spark, folder)))
    assert exchanged("q_missing_roles") == []
    assert not set(exchanged("q_genre_year_producers")) & {"titleid", "id"}
    for table in ("title_producer", "title_genre", "title_actor"):
        assert "HashAggregate" not in plan(getattr(v.stored, table).select("titleid"))  # nothing is made distinct again


def test_stored_tables_are_the_views(v):
    for name in ("genre", "title", "member", "title_genre", "title_producer", "title_writer", "title_director", "title_actor"):
        a, b = getattr(v.stored, name), getattr(v, name)
        assert a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty(), name
    assert v.stored.title is not v.title and v.stored.title.count() == v.title.count()


def test_source_views_are_stored_once(spark, v):
    lazy, stored = inventory.sources(v), v.stored.source_views(inventory.KIND)
    for (name, a), (_, b) in zip(stored.items(), lazy.items()):
        assert a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty() and not a.isEmpty(), name
    files = [sorted(df.inputFiles()) for _, df in stored.items()]
    assert files == [sorted(df.inputFiles()) for _, df in v.stored.source_views(inventory.KIND).items()]
    other = v.stored.source_views("another genre")  # a genre has views of its own
    assert other.comedy_movie.isEmpty() and other.non_comedy_movie.count() > stored.non_comedy_movie.count()


def test_stored_source_views_meet_the_links_once(v, monkeypatch):
    plans, keep = {}, StoredCatalogue.keep

    def noted(self, name, make, by=None):
        if name not in LAYOUT:
            plans[name] = plan(make(self))
        return keep(self, name, make, by)

    monkeypatch.setattr(StoredCatalogue, "keep", noted)
    views = v.stored.source_views("a third genre")
    assert len(plans) == 6 and [n[:8] for n, p in plans.items() if "_title_actor" in p] == ["acted_in"]
    assert views.acted_in.columns == ["titleid", "actorid"]


def test_links_of_repeated_titles_are_stored_once(spark):
    links = spark.createDataFrame([(1, 5), (1, 6), (2, 5), (3, 7), (None, 7)], "titleid long, actorid long")
    movies = spark.createDataFrame([(1, True), (1, True), (2, False), (None, True)], "id long, tagged boolean")
    assert sorted(map(tuple, integration.flagged_links(links, movies).collect())) == [(1, 5, True), (1, 6, True), (2, 5, False)]
    people = spark.createDataFrame([(i, f"n{i}", 1950, None) for i in (5, 6, 7)], "id long, name string, birthYear int, deathYear int")
    got = integration.actors_of(people, integration.flagged_links(links, movies))
    assert sorted((r["id"], r["tagged"]) for r in got.collect()) == [(5, True), (6, True)]


@pytest.mark.parametrize("name", ["q_gav_prolific_stored", "q_gav_prefix_stored"])
def test_queries_over_stored_views_read_nothing_else(spark, folder, name):
    registry.load()
    found = plan(registry.RUN[name](spark, folder))
    assert "lineitem.parquet" not in found and "orders.parquet" not in found and "acted_in" in found


def test_document_queries_make_no_link_distinct(spark, folder):
    registry.load()
    for name in ("q_doc_producers_50", "q_doc_writer_avg", "q_doc_longrun_sets", "rpt_genre_boxplot", "rpt_genre_cast"):
        assert "lineitem.parquet" not in plan(registry.RUN[name](spark, folder)), name


def test_selective_roles_reach_the_links(spark, v, no_broadcast):
    """Spark's runtime Bloom filter, which large links get by themselves, in the plan."""
    size = "spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold"
    spark.conf.set(size, "0")
    try:
        found = relational.role_pattern(v.stored.member, v.stored.actor_title_role, v.stored.role, ("a%f-1",), "x")
        assert "might_contain" in found._jdf.queryExecution().optimizedPlan().toString()
    finally:
        spark.conf.unset(size)


def test_missing_roles_both_ways(v):
    a = relational.missing_roles(v.title_actor, v.actor_title_role)
    b = relational.missing_roles_stored(v.stored.title_actor, v.stored.actor_title_role)
    assert a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


# --- the keyed store

def documents(spark, n):
    return spark.range(n).selectExpr("id AS _id", "concat('t', id) AS title", "cast(NULL AS string) AS currency_type")


def set_currency(rows, changes):
    return updates.set_by_id(rows, changes, ["currency_type"])


def test_merge_rewrites_touched_buckets_only(spark, tmp_path):
    stored = Collection(spark, str(tmp_path / "c")).create(documents(spark, 500), buckets=16)
    before = stored.manifest()
    changes = spark.createDataFrame([(3, "USD"), (777, "EUR")], "_id long, currency_type string")
    assert stored.merge(changes, set_currency, "one")
    after = stored.manifest()
    moved = [b for b in before.folders if before.folders[b] != after.folders[b]]
    assert 1 <= len(moved) <= 2 and after.number == 1
    assert stored.read().count() == 500 and [tuple(r) for r in stored.read().where("currency_type IS NOT NULL").collect()] == [(3, "t3", "USD")]
    assert not stored.merge(changes, set_currency, "one") and stored.manifest() == after  # a second run changes nothing
    assert stored.clear() == len(moved) and stored.read().count() == 500


def test_a_failed_merge_leaves_the_old_state(spark, tmp_path, monkeypatch):
    stored = Collection(spark, str(tmp_path / "c")).create(documents(spark, 40))
    changes = spark.createDataFrame([(3, "USD")], "_id long, currency_type string")

    def lost(*_):
        raise OSError("gone before the commit")

    with monkeypatch.context() as m:
        m.setattr(Collection, "_commit", lost)
        with pytest.raises(OSError):
            stored.merge(changes, set_currency, "one")
    again = Collection(spark, str(tmp_path / "c"))
    assert again.manifest().number == 0 and again.read().where("currency_type IS NOT NULL").isEmpty()
    assert again.merge(changes, set_currency, "one") and again.read().where("currency_type = 'USD'").count() == 1
    assert again.clear() >= 1


def test_replace_set_and_empty_batches(spark, tmp_path):
    stored = Collection(spark, str(tmp_path / "c")).create(documents(spark, 10), buckets=4)
    new = spark.createDataFrame([(2, None, "X"), (99, "absent", "Y")], "_id long, title string, currency_type string")
    stored.merge(new, updates.replace_by_id, "whole")
    assert sorted(r["_id"] for r in stored.read().collect()) == list(range(10))
    assert tuple(stored.read().where("_id = 2").first()) == (2, None, "X")
    assert stored.merge(new.limit(0), updates.replace_by_id, "nothing") and stored.read().count() == 10
    none = Collection(spark, str(tmp_path / "d")).create(documents(spark, 0))
    assert none.merge(new, updates.replace_by_id, "b") and none.read().count() == 0


def test_two_writers(spark, tmp_path):
    stored = Collection(spark, str(tmp_path / "c")).create(documents(spark, 5))
    with pytest.raises(RuntimeError):
        stored._commit(stored.manifest())


# --- lines, first ones and lost ones

def test_first_line_wins_over_the_smaller_one(spark, tmp_path):
    path = tmp_path / "a.tsv"
    path.write_text("k\tt\n1\tz\n2\tb\n1\ta\n1\ta\n2\tb\n1\tz\n", encoding="utf-8")
    rows = readers.read_tsv(spark, str(path), schemas.all_text("k", "t"), position=True)
    kept, lost = keys.split_first(rows, ["k"])
    assert sorted(map(tuple, kept.collect())) == [("1", "z"), ("2", "b")]
    assert sorted(map(tuple, lost.collect())) == [("1", "a", 2), ("1", "z", 1), ("2", "b", 1)]


def test_first_line_over_many_files(spark, tmp_path):
    lines = spark.range(1000).selectExpr("cast(id % 7 AS string) AS k", "cast(id AS string) AS t")
    writers.write_tsv(lines.orderBy(F.col("t").cast("int")).repartitionByRange(5, F.col("t").cast("int")), str(tmp_path / "d"))
    rows = readers.read_tsv(spark, str(tmp_path / "d"), schemas.all_text("k", "t"), position=True)
    kept, lost = keys.split_first(rows, ["k"])
    assert {r["k"]: r["t"] for r in kept.collect()} == {str(i): str(i) for i in range(7)}
    assert lost.agg(F.sum("copies")).first()[0] == 993


def test_links_and_what_became_of_them(spark):
    rows = spark.createDataFrame([("writers", 1, 5), ("writers", 1, 5), ("writers", 9, 5), ("writers", 9, 7), ("actors", 1, 5), ("writers", None, 5)],
                                 "target string, title_id long, person_id long")
    movies = spark.createDataFrame([(1,), (1,)], "title_id long")
    people = spark.createDataFrame([("writers", 5), ("writers", 5)], "target string, id long")
    got = sorted(map(tuple, etl.known_links(rows, movies, people).collect()), key=str)
    assert got == sorted([
        ("writers", 1, 5, "kept", 1), ("writers", 1, 5, "repeated", 1), ("writers", 9, 5, "unknown title", 1),
        ("writers", 9, 7, "unknown title", 1), ("actors", 1, 5, "unknown person", 1), ("writers", None, 5, "unknown title", 1)], key=str)


def test_every_key_of_a_wrapped_line(spark, tmp_path):
    path = tmp_path / "x.json"
    path.write_text('{"IMDb_ID":{"value":"tt1"},"other":{"value":"o"},"odd":{}}\n{}\n{"cost":{"value":"5"}}\nno json\n')
    rows = readers.read_wrapped_json_whole(spark, str(path)).collect()
    assert [(r["IMDb_ID"], r["cost"], r["rest"]) for r in rows] == [
        ("tt1", None, {"other": "o", "odd": None}), (None, None, {}), (None, "5", {}), (None, None, None)]


# --- samples and sketches

def test_samples_fall_into_no_residue_class(spark):
    ids = spark.range(0, 3_000_000, 1, 8).withColumnRenamed("id", "_id")
    drawn = [r["_id"] for r in selection.sample_rows(ids, 50, "_id").collect()]
    assert len({i % 1_000_003 for i in drawn}) == 50 and 5 < sum(i < 1_500_000 for i in drawn) < 45


def test_bottom_k_of_all_groups_in_one_job(spark):
    rows = spark.range(5000).selectExpr("CASE WHEN id % 3 = 0 THEN 'b' WHEN id < 4 THEN 'c' ELSE 'a' END AS label", "id AS _id")
    got = selection.bottom_k(rows, "label", "_id", {"a": 7, "b": 3, "c": 50})
    assert "WindowGroupLimit" in plan(got)
    found = {}
    for r in got.collect():
        found.setdefault(r["label"], []).append((r["rank"], r["_id"]))
    for label, k in (("a", 7), ("b", 3), ("c", 50)):
        one = [r["_id"] for r in selection.sample_rows(rows.where(F.col("label") == label), k, "_id").collect()]
        assert [i for _, i in sorted(found[label])] == one


def test_sketched_quartiles_stay_within_their_ranks(v):
    exact = {r["genre"]: r for r in document_queries.genre_boxplot(v.title, v.labelled_genre).collect()}
    near = document_queries.genre_boxplot_approx(v.title, v.labelled_genre, accuracy=100)
    ratings = v.labelled_genre.join(v.title.where("numVotes >= 10000"), F.col("titleid") == F.col("id")).select("genre", "avgRatings")
    values = {}
    for r in ratings.where("avgRatings IS NOT NULL").collect():
        values.setdefault(r["genre"], []).append(r["avgRatings"])
    for r in near.collect():
        if r["titles"] is None:
            continue
        have, n = sorted(values[r["genre"]]), len(values[r["genre"]])
        assert (r["titles"], r["low"], r["high"]) == (n, exact[r["genre"]]["low"], exact[r["genre"]]["high"])
        for share, q in ((0.25, r["q1"]), (0.5, r["median"]), (0.75, r["q3"])):
            low, high = sum(x < q for x in have), sum(x <= q for x in have)
            assert low - n / 100 - 1 <= share * n <= high + n / 100 + 1


def test_one_scan_for_all_routes(spark, folder):
    registry.load()
    for name, scans in (("flt_route_exact", 4), ("arr_explode_route", 3), ("upd_report", 3), ("etl_principals", 1)):
        assert len(re.findall(r"Scan |FileScan ", plan(registry.RUN[name](spark, folder)))) <= scans * 2, name


def test_every_test_file_is_collected():
    names = [p.name for p in Path(__file__).parent.rglob("test_*.py")]
    assert len(names) == len(set(names)), "pytest refuses a second file of a name"
