"""Declared constraints, the load job, and dependencies on two columns."""

import itertools
import json
import random

import pytest
from pyspark.sql import functions as F

from filmgrain import schemas
from filmgrain.operators import constraints, dependencies
from filmgrain.operators.constraints import Rules
from filmgrain.plans import loading

RULES = {
    "link": Rules(("film", "person"), {"film": "film", "person": "person"}),
    "film": Rules(("id",), limits={"name": 4}),
    "person": Rules(("id",)),
}


def outcomes(df):
    return sorted(((*r[:-2], r.outcome, r.copies) for r in df.collect()), key=repr)


def test_declarations_follow_the_tables():
    rules = loading.RULES
    assert set(rules) == set(schemas.TABLES)
    assert rules["title"].limits == {"type": 255, "title": 512, "originalTitle": 512}
    assert rules["actor_title_role"] == Rules(
        ("titleid", "actorid", "roleid"), {"titleid": "title", "actorid": "member", "roleid": "role"})
    order = constraints.in_order(rules)
    assert all(order.index(p) < order.index(t) for t in rules for p in rules[t].parents.values())


def test_tables_that_need_each_other_are_refused():
    with pytest.raises(ValueError):
        constraints.in_order({"a": Rules(("id",), {"b": "b"}), "b": Rules(("id",), {"a": "a"})})


def test_each_row_has_its_first_fault(spark):
    film = spark.createDataFrame(
        [(1, "b"), (1, "a"), (1, "a"), (None, "x"), (None, "much too long"), (2, "four"), (3, "fifth"), (4, None), (1, "longer")],
        "id int, name string")
    assert outcomes(constraints.judge(film, RULES["film"], {})) == sorted([
        (1, "a", "kept", 1), (1, "a", "id repeated", 1), (1, "b", "id repeated", 1), (1, "longer", "name too long", 1),
        (None, "x", "id is null", 1), (None, "much too long", "id is null", 1),
        (2, "four", "kept", 1), (3, "fifth", "name too long", 1), (4, None, "kept", 1)], key=repr)


def test_the_earliest_sound_line_claims_a_key(spark):
    film = spark.createDataFrame(
        [(1, "much too long", 0), (1, "z", 1), (1, "a", 2), (1, "z", 3)], "id int, name string, _pos int")
    assert outcomes(constraints.judge(film, RULES["film"], {})) == sorted([
        (1, "much too long", "name too long", 1), (1, "z", "kept", 1), (1, "z", "id repeated", 1), (1, "a", "id repeated", 1)], key=repr)


def test_a_key_of_most_rows_is_one_row_and_counts(spark):
    rows = spark.range(0, 30_000, 1, 16).selectExpr(
        "IF(id % 3 = 0, 7, id) AS id", "IF(id % 3 = 0, 'same', 'own') AS name")
    judged = constraints.judge(rows, RULES["film"], {})
    assert outcomes(judged.where("id = 7 AND name = 'same'")) == [(7, "same", "id repeated", 10_000)]
    assert judged.where("outcome = 'kept'").count() == 20_000


def test_children_of_a_rejected_row_are_rejected(spark):
    tables = {
        "film": spark.createDataFrame([(1, "good"), (2, "too long")], "id int, name string"),
        "person": spark.createDataFrame([(5,), (5,)], "id int"),
        "link": spark.createDataFrame([(1, 5), (1, 5), (1, 5), (2, 5), (1, 6), (9, 9), (None, 5)], "film int, person int"),
    }
    seen = []
    kept, rejects = constraints.load(tables, RULES, lambda name, judged: (seen.append(name), judged)[1])
    assert seen == ["film", "person", "link"]
    assert {n: sorted(map(tuple, d.collect())) for n, d in kept.items()} == {"film": [(1, "good")], "person": [(5,)], "link": [(1, 5)]}
    assert sorted(map(tuple, rejects.drop("row").collect())) == [
        ("film", "2", "name too long", 1), ("link", ",5", "film is null", 1), ("link", "1,5", "film, person repeated", 2),
        ("link", "1,6", "person unknown", 1), ("link", "2,5", "film unknown", 1), ("link", "9,9", "film unknown", 1),
        ("person", "5", "id repeated", 1)]
    assert json.loads(rejects.where("table = 'film'").first().row) == {"id": 2, "name": "too long"}


def test_empty_tables(spark):
    tables = {n: spark.createDataFrame([], s) for n, s in (
        ("film", "id int, name string"), ("person", "id int"), ("link", "film int, person int"))}
    kept, rejects = constraints.load(tables, RULES, lambda name, judged: judged)
    assert rejects.count() == 0 and all(d.count() == 0 for d in kept.values())


def test_load_job_can_be_run_again(spark, tmp_path):
    long = "x" * 513
    text = lambda name, *rows: spark.createDataFrame(rows, schemas.RAW[name])
    dumps = {
        "title.basics": text(
            "title.basics", ("tt1", "movie", "One", "Un", "0", "2000", None, "90", "Drama,War"),
            ("tt2", "movie", long, "Deux", "0", "2001", None, "80", "Drama")),
        "title.ratings": text("title.ratings", ("tt1", "7.5", "100"), ("tt3", "6.0", "10")),
        "name.basics": text("name.basics", ("nm1", "Ann Lee", "1950", None, "actor", None)),
        "title.principals": text(
            "title.principals", ("tt1", "1", "nm1", "actor", None, '["A","B"]'), ("tt2", "1", "nm1", "actor", None, '["A"]'),
            ("tt1", "2", "nm2", "producer", None, None)),
    }
    for _ in range(2):
        kept, rejects = loading.load_catalogue(dumps, str(tmp_path))
        assert {n: d.count() for n, d in kept.items()} == {
            "title": 2, "member": 1, "genre": 2, "title_genre": 2, "role": 2, "actor_title_role": 2,
            "title_actor": 1, "title_writer": 0, "title_director": 0, "title_producer": 0}
        assert sorted((r.table, r.key, r.outcome) for r in rejects.collect()) == [
            ("actor_title_role", "2,1,0", "titleid unknown"), ("title", "2", "title too long"),
            ("title_actor", "2,1", "titleid unknown"), ("title_genre", "2,0", "titleid unknown"),
            ("title_producer", "1,2", "producerid unknown")]
        for name, rows in kept.items():
            assert rows.schema.names == schemas.TABLES[name].names
    files = kept["title"].select(F.input_file_name()).distinct().collect()
    assert files and all("outcome=kept" in f[0] for f in files)


# --- two columns on the left

def naive_pairs(rows, columns):
    def holds(left, right):
        present = [r for r in rows if all(r[c] is not None for c in left)]
        values = {}
        for r in present:
            values.setdefault(tuple(r[c] for c in left), set()).add(r[right])
        return bool(present) and all(len(v) == 1 and None not in v for v in values.values())

    return {(x, z, y) for x, z in itertools.combinations(columns, 2) for y in columns
            if y not in (x, z) and holds((x, z), y) and not holds((x,), y) and not holds((z,), y)}


@pytest.mark.parametrize("seed", range(3))
def test_minimal_pairs_against_plain_groups(spark, seed):
    rnd = random.Random(seed)
    columns = ["a", "b", "total", "c", "d", "e"]
    rows = []
    for i in range(60):
        a, b = rnd.choice([None, 1, 2, 3]), rnd.choice([1, 1, 1, 1, 2, 3])
        rows.append({"a": a, "b": b, "total": None if a is None else f"s{a + b}", "c": rnd.choice([0.0, -0.0, 1.5]),
                     "d": rnd.choice([None, "x"]), "e": i if i % 2 else None})
    df = spark.createDataFrame([tuple(r[c] for c in columns) for r in rows], "a int, b int, total string, c double, d string, e int")
    found = [tuple(r) for r in dependencies.minimal_pairs(df).collect()]
    assert len(found) == len(set(found)) and set(found) == naive_pairs(rows, columns)
    assert ("a", "b", "total") in found


def test_pairs_say_nothing_of_what_never_meets(spark):
    df = spark.createDataFrame([(1, None, 1), (None, 1, 2), (1, None, 3), (None, 1, 4)], "a int, b int, c int")
    assert dependencies.minimal_pairs(df).collect() == []
    assert dependencies.minimal_pairs(df.limit(0)).collect() == []


def test_a_null_beside_a_lone_pair_breaks_it(spark):
    rows = [(1, 1, 5), (1, 2, 6), (2, 1, 7), (2, 2, None)]
    df = spark.createDataFrame(rows, "a int, b int, c int")
    assert {tuple(r) for r in dependencies.minimal_pairs(df).collect()} == naive_pairs(
        [dict(zip("abc", r)) for r in rows], list("abc"))
