"""Small hand-made cases the derived tables cannot show."""

from pyspark.sql import functions as F

from filmgrain import schemas
from filmgrain.functions import text
from filmgrain.functions.numeric import min_max
from filmgrain.operators import clusters, dependencies, documents, itemsets, keys, selection, updates
from filmgrain.plans import document_queries, etl, relational
from filmgrain.sources import readers, writers


def col(df, name=None):
    return [r[name or df.columns[0]] for r in df.collect()]


def test_stray_quote_and_null_spelling(spark, tmp_path):
    path = tmp_path / "data.tsv"
    path.write_text('a\tb\tc\ntt3\t"open\t\\N\ntt4\tclosed"\tx\n', encoding="utf-8")
    rows = readers.read_tsv(spark, str(path), schemas.all_text("a", "b", "c")).collect()
    assert [tuple(r) for r in rows] == [("tt3", '"open', None), ("tt4", 'closed"', "x")]


def test_tsv_round_trip_keeps_quotes_and_backslashes(spark, tmp_path):
    df = spark.createDataFrame([('"a', "b\\c", None), ("x'y", '""', "1")], "a string, b string, c string")
    writers.write_tsv(df, str(tmp_path / "t"))
    back = readers.read_tsv(spark, str(tmp_path / "t"), df.schema)
    assert sorted(map(str, back.collect())) == sorted(map(str, df.collect()))


def test_csv_null_spelling(spark, tmp_path):
    df = spark.createDataFrame([(1, "a,b"), (2, ""), (3, "\\N"), (4, None), (5, 'q"q')], "id int, t string")
    writers.write_csv_nulls(df, str(tmp_path / "t"))
    back = readers.read_csv_table(spark, str(tmp_path / "t"), df.schema)
    assert dict(back.collect()) == {1: "a,b", 2: None, 3: None, 4: None, 5: 'q"q'}


def test_bad_number_is_null(spark):
    df = spark.createDataFrame([("Reality-TV",), ("90",), (None,), ("12.0",)], "r string")
    assert col(df.select(text.to_number("r"))) == [None, 90, None, 12]


def test_one_word_name(spark):
    df = spark.createDataFrame([("Cher",), ("Ada King Lovelace",)], "n string")
    first, last = text.split_name("n")
    assert [tuple(r) for r in df.select(first, last).collect()] == [("Cher", None), ("Ada", "King Lovelace")]


def test_second_acting_entry_goes(spark):
    df = spark.createDataFrame(
        [(["ACTRESS", "ACTOR", "WRITER"],), (["ACTOR"],), (["ACTOR", "X_ACT", "ACTRESS"],), (["WRITER"],)],
        "j array<string>",
    )
    assert col(df.select(text.drop_second_acting_entry(F.col("j")))) == [
        ["ACTRESS", "WRITER"], ["ACTOR"], ["ACTOR", "X_ACT", "ACTRESS"], ["WRITER"],
    ]


def test_fewer_and_more_than_three_genres(spark):
    df = spark.createDataFrame([("Drama",), ("A,B,C,D",), (None,)], "g string")
    rows = df.select(*text.fixed_slots("g", ["a", "b", "c"])).collect()
    assert [tuple(r) for r in rows] == [("Drama", None, None), ("A", "B", "C"), (None, None, None)]


def test_role_list(spark):
    df = spark.createDataFrame(
        [("tt1", "nm1", "actor", '["A","B"]'), ("tt1", "nm2", "writer", '["C"]'), ("tt2", "nm1", "actress", None)],
        "tconst string, nconst string, category string, characters string",
    )
    assert sorted(col(etl.role_rows(df), "role")) == ["A", "B"]


def test_category_routing_first_match(spark):
    df = spark.createDataFrame([("actress",), ("production_designer",), ("director",), ("editor",)], "c string")
    assert col(df.select(text.first_match("c", etl.CATEGORY_ROUTES))) == ["actors", "producers", "directors", None]


def test_batch_with_clash_inserts_nothing(spark):
    target = spark.createDataFrame([(7,)], "id int")
    clash = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c")], "id int, n string")
    present = spark.createDataFrame([(7, "a"), (8, "b")], "id int, n string")
    clean = spark.createDataFrame([(1, "a"), (2, "c")], "id int, n string")
    assert keys.insert_batch(clash, target, ["id"]).count() == 0
    assert keys.insert_batch(present, target, ["id"]).count() == 0
    assert keys.insert_batch(clean, target, ["id"]).count() == 2


def test_append_new_splits_everything(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.createDataFrame([(1, 1)], "k int, line int").write.parquet(path)
    rows = spark.createDataFrame([(1, 5), (2, 6), (2, 7), (2, 7), (3, 8)], "k int, line int")
    accepted, rejected = writers.append_new(rows, path, ["k"], ["line"])
    assert sorted(map(tuple, accepted.collect())) == [(2, 6), (3, 8)]
    assert sorted(map(tuple, rejected.collect())) == [(1, 5, 1, "key exists"), (2, 7, 2, "repeated key")]
    assert accepted.count() + rejected.agg(F.sum("copies")).first()[0] == rows.count()
    assert spark.read.parquet(path).count() == 3


def test_three_valued_filter(spark):
    df = spark.createDataFrame(
        [(1, 2014, None), (2, 2014, 2015), (3, 2013, None), (4, None, 2014), (5, 2014, 2014)],
        "id int, startYear int, endYear int",
    )
    assert col(df.where(relational.differs_3vl("startYear", "endYear", 2014)), "id") == [2, 3]


def test_different_writers_may_satisfy_each_condition(spark):
    title = spark.createDataFrame([(1, "movie", 100), (2, "movie", 50), (3, "movie", 10)], "id int, type string, runtime int")
    writers_ = spark.createDataFrame([(1, 1), (1, 2), (2, 1), (3, 2)], "titleid int, writerid int")
    member = spark.createDataFrame([(1, "A Bhardwaj", 1990), (2, "B", None)], "id int, name string, deathYear int")
    assert col(document_queries.writer_average(title, writers_, member), "avgRuntime") == [100.0]
    assert document_queries.writer_average(title.where("id = 3"), writers_, member).count() == 0


def test_empty_array_has_no_null_element(spark):
    df = spark.createDataFrame([(1, []), (2, [{"d": None}]), (3, [{"d": 5}])], "id int, a array<struct<d:int>>")
    assert col(df.where(documents.any_null("a", "d")), "id") == [2]


def test_unwind_drops_missing_and_passes_scalars(spark):
    df = spark.createDataFrame([(1, ["a", "b"]), (2, []), (3, None)], "id int, g array<string>")
    once = documents.unwind(df, "g")
    assert col(once, "g") == ["a", "b"] and col(documents.unwind(once, "g"), "g") == ["a", "b"]


def test_producer_sets(spark):
    title = spark.createDataFrame([(1, 120), (2, 130), (3, 119), (4, 200)], "id int, runtime int")
    made = spark.createDataFrame([(1, 1), (1, 2), (2, 2), (2, 1), (3, 1), (4, 2)], "titleid int, producerid int")
    member = spark.createDataFrame([(1, "A", None), (2, "B", 1990)], "id int, name string, deathYear int")
    rows = document_queries.longrun_producer_sets(title, made, member).collect()
    assert [(r["producers"], r["name"], r["count"]) for r in rows] == [([1, 2], ["A", "B"], 2)]


def test_text_dependencies_are_confirmed_on_the_text(spark):
    df = spark.createDataFrame([(1, "a", "x"), (1, "a", None), (2, "b", "y"), (3, "a", "y")], "i int, s string, t string")
    assert {tuple(r) for r in dependencies.single(df).collect()} == {("i", "s")}


def test_dependency_nulls(spark):
    df = spark.createDataFrame(
        [(None, 1, "p"), (None, 2, "p"), (1, 5, "p"), (1, 5, "p"), (2, None, "q")], "x int, y int, z string"
    )
    found = {tuple(r) for r in dependencies.single(df).collect()}
    # null x says nothing, null y under x = 2 breaks x -> y
    assert ("x", "z") in found and ("x", "y") not in found and ("y", "z") in found


def naive_dependencies(rows, columns):
    out = set()
    for left in columns:
        for right in columns:
            if left != right and all(
                a[left] is None or a[left] != b[left] or (a[right] is not None and a[right] == b[right])
                for a in rows for b in rows
            ):
                out.add((left, right))
    return out


def test_dependencies_against_row_pairs(spark):
    import random

    rnd = random.Random(3)
    columns = ["a", "b", "c", "d"]
    rows = []
    for _ in range(40):
        a = rnd.choice([None, 1, 2, 3, 4])
        rows.append({"a": a, "b": None if a is None else a % 2, "c": rnd.choice([1, None]), "d": 7})
    df = spark.createDataFrame([tuple(r[c] for c in columns) for r in rows], "a int, b int, c int, d int")
    assert {tuple(r) for r in dependencies.single(df).collect()} == naive_dependencies(rows, columns)


def test_implied_pairs_order_and_triviality(spark):
    deps = spark.createDataFrame([("b", "c")], "lhs string, rhs string")
    rows = {tuple(r) for r in dependencies.implied_pairs(deps, ["a", "b", "c", "d"]).collect()}
    assert rows == {("a", "b", "c"), ("b", "d", "c")}


def test_support_boundary(spark):
    rows = [(b, i) for b in range(5) for i in (1, 2)] + [(b, i) for b in range(10, 16) for i in (3, 4)]
    found = itemsets.levels(spark.createDataFrame(rows, "basket int, item int"))
    assert [tuple(r) for r in found[1].collect()] == [(3, 4, 6)]


def test_distance_tie_goes_to_the_earlier_centroid(spark):
    feats = spark.createDataFrame([("g", 1, 0.5, 0.0)], "label string, _id int, x double, y double")
    runs = {("g", 2): {1: (1.0, 0.0), 2: (0.0, 0.0)}}
    assert col(clusters.assign(feats, runs), "cluster") == [1]


def test_empty_cluster_is_replaced(spark):
    feats = spark.createDataFrame(
        [("g", 1, 0.0, 0.0), ("g", 2, 0.1, 0.0)], "label string, _id int, x double, y double"
    )
    runs = {("g", 2): {1: (0.0, 0.0), 2: (9.0, 9.0)}}
    moved = clusters.advance(clusters.weighted_points(feats), feats, runs, 1)[("g", 2)]
    assert moved[1] == (0.05, 0.0) and moved[2] in [(0.0, 0.0), (0.1, 0.0)]


def test_constant_column_scales_to_zero(spark):
    df = spark.createDataFrame([(5, 5, 5), (None, 5, 5)], "v int, lo int, hi int")
    assert col(df.select(min_max(F.col("v"), F.col("lo"), F.col("hi")))) == [0.0, None]


def test_update_with_only_a_key_is_dropped(spark):
    schema = "_id int, currency_type string, cost double, distributor string, box_office_revenue double, film_rating string"
    df = spark.createDataFrame([(1, None, None, None, None, None), (2, "USD", None, None, None, None)], schema)
    assert col(updates.informative(df), "_id") == [2]


def test_repeated_title_changes_one_document(spark):
    docs = spark.createDataFrame([(1, "T", None), (2, "T", None), (3, "U", "EUR")], "_id int, title string, currency_type string")
    new = spark.createDataFrame([("T", "USD"), ("U", None), ("V", "USD")], "title string, currency_type string")
    rows = updates.set_by_title(docs, new, ["currency_type"]).collect()
    assert sorted(map(tuple, rows)) == [(1, "T", "USD"), (2, "T", None), (3, "U", "EUR")]


def test_ragged_json_and_file_order(spark, tmp_path):
    path = tmp_path / "extra.json"
    path.write_text(
        '{"IMDb_ID":{"value":"tt0000007"},"cost":{"value":"5"}}\n'
        '{"IMDb_ID":{"value":"tt0000007"},"cost":{"value":"6"}}\n'
        '{"titleLabel":{"value":"x"}}\n{"IMDb_ID":{"value":"nm3"},"cost":{"value":"1"}}\n'
    )
    records = updates.rename_enrichment(readers.read_wrapped_json(spark, str(path), position=True))
    assert [(r["_id"], r["cost"]) for r in updates.by_id(records).collect()] == [(7, 5.0)]


def test_too_long(spark):
    df = spark.createDataFrame([(1, "abcd", "x"), (2, "ab", "xyz"), (3, "a", None)], "id int, a string, b string")
    rows = {(r["id"], r["column"], r["length"]) for r in keys.too_long(df, {"a": 3, "b": 2}).collect()}
    assert rows == {(1, "a", 4), (2, "b", 3)}


def test_dense_ids_over_many_partitions(spark):
    labels = spark.range(0, 5000).selectExpr("concat('l', id % 1777) AS l").repartition(13)
    ids = {r["l"]: r["id"] for r in selection.dense_ids(labels, "l").collect()}
    assert ids == {label: i for i, label in enumerate(sorted({f"l{n}" for n in range(1777)}))}


def test_first_per_key_ignores_input_order(spark):
    df = spark.createDataFrame([(1, 3, "c"), (1, 2, "b"), (2, 9, None)], "k int, o int, v string")
    assert sorted(map(tuple, selection.first_per_key(df, ["k"], ["o"]).collect())) == [(1, 2, "b"), (2, 9, None)]


def test_top_per_group_limits_before_the_shuffle(spark):
    df = spark.range(1000).selectExpr("id % 3 AS g", "id")
    top = selection.top_per_group(df, "g", ["id"], 25)
    assert top.count() == 75
    assert "WindowGroupLimit" in top._jdf.queryExecution().executedPlan().toString()


def test_two_spellings_are_one_id(spark):
    from filmgrain.operators import updates

    rows = [(1, "tt7", "a", "5"), (2, "tt0000007", "b", "6"), (3, "ttx", "c", "7"), (4, "nm7", "d", "8"), (5, None, "e", "9")]
    records = spark.createDataFrame(rows, "_pos long, _id string, title string, cost string").selectExpr(
        "*", "cast(NULL AS string) AS currency_type", "cast(NULL AS string) AS distributor",
        "cast(NULL AS string) AS box_office_revenue", "cast(NULL AS string) AS film_rating")
    got = updates.by_id(records)
    assert [(r["_id"], r["cost"]) for r in got.collect()] == [(7, 5.0)]
    docs = spark.createDataFrame([(7, "t")], "_id long, title string")
    assert updates.set_by_id(docs, got).count() == 1
    counts = updates.report(records, got, docs, "_id").collect()[0]
    assert (counts["with_key"], counts["without_key"], counts["repeated_keys"], counts["matched"]) == (2, 3, 1, 1)


def test_report_counts_in_one_pass(spark):
    records = spark.createDataFrame([("tt1", "a", "USD"), ("tt01", "a", None), ("tt2", "b", None), ("nm3", None, "X"), (None, "c", "Y"), ("tt9", "d", "Z")],
                                    "_id string, title string, currency_type string").selectExpr(
        "*", *[f"cast(NULL AS string) AS {c}" for c in ("cost", "distributor", "box_office_revenue", "film_rating")],
        "monotonically_increasing_id() AS _pos")
    docs = spark.createDataFrame([(1, "a"), (2, "b")], "_id long, title string")
    got = updates.report(records, updates.by_id(records), docs, "_id")
    assert got.first().asDict() == {
        "with_key": 4, "without_key": 2, "person_key": 1, "repeated_keys": 1, "no_information": 1, "to_update": 2, "matched": 1, "unmatched": 1}
    assert updates.report(records.limit(0), updates.by_id(records.limit(0)), docs, "_id").first()["with_key"] == 0


def test_two_ratings_of_one_movie(spark):
    from filmgrain.operators.updates import update_ratings

    movies = spark.createDataFrame([(1, 2.0, 3), (2, 1.0, 1)], "title_id long, ratings double, votes long")
    scores = spark.createDataFrame([(1, 9.0, 5, 1), (1, 4.0, 2, 2)], "title_id long, ratings double, votes long, _pos long")
    assert sorted(map(tuple, update_ratings(movies, scores).collect())) == [(1, 4.0, 2), (2, 1.0, 1)]
    assert sorted(map(tuple, update_ratings(movies, scores.drop("_pos")).collect())) == [(1, 9.0, 5), (2, 1.0, 1)]


def test_empty_cluster_is_refilled_every_turn(spark):
    from filmgrain.operators import clusters

    feats = spark.createDataFrame([(1, "g", -1.0, 0.0), (2, "g", 0.0, 0.0), (3, "g", 1.0, 0.0)],
                                  "_id long, label string, x double, y double")
    points, runs = clusters.weighted_points(feats), {("g", 2): {1: (0.0, 0.0), 2: (0.0, 0.0)}}
    plain = dict(runs)
    for turn in range(1, 9):
        plain = clusters.advance(points, feats, plain, turn)
    assert clusters.fit(points, feats, runs, 8)[1] == plain


def test_kinds_that_start_alike_have_ids_of_their_own(spark):
    from filmgrain.plans.views import _numbered

    labels = spark.createDataFrame([("Drama",), ("Drums",), ("Drama",), ("Ab",)], "genre string")
    assert sorted(map(tuple, _numbered(labels, "genre").collect())) == [(0, "Ab"), (1, "Drama"), (2, "Drums")]


def test_replace_by_id(spark):
    from filmgrain.operators.updates import replace_by_id

    docs = spark.createDataFrame([(1, "a"), (2, "b")], "_id long, title string")
    new = spark.createDataFrame([(2, None), (3, "c")], "_id long, title string")
    assert sorted(map(tuple, replace_by_id(docs, new).collect())) == [(1, "a"), (2, None)]
