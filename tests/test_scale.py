"""What keeps jobs within bounds as tables grow."""

import gzip
from pathlib import Path

from pyspark.sql import functions as F

from filmgrain import schemas
from filmgrain.operators import constraints, dependencies, itemsets, joins, keys
from filmgrain.operators.constraints import Rules
from filmgrain.plans.inventory import sources
from filmgrain.plans.views import Catalogue
from filmgrain.sources import readers, writers


def rows(df):
    return sorted(map(str, df.collect()))


def made(df, text):
    """Rows that the operators of a run plan whose name holds ``text`` gave out."""
    found = []

    def visit(node):
        if text in node.nodeName() and node.metrics().contains("numOutputRows"):
            found.append(node.metrics().get("numOutputRows").get().value())
        inner = [node.children(), node.innerChildren()]
        if node.nodeName() == "AdaptiveSparkPlan":
            inner = []
            visit(node.executedPlan())
        elif "QueryStage" in node.nodeName():
            inner = []
            visit(node.plan())
        for some in inner:
            for i in range(some.size()):
                visit(some.apply(i))

    df.collect()
    visit(df._jdf.queryExecution().executedPlan())
    return found


def test_only_hot_keys_are_repeated(spark):
    """Before, every key came sixteen times."""
    many = spark.range(3000).selectExpr("CASE WHEN id % 3 = 0 THEN 7 WHEN id % 3 = 1 THEN NULL ELSE id % 400 END AS k", "id AS v")
    one = spark.range(300).selectExpr("id AS k", "id * 2 AS z")
    for how in ("inner", "left", "left_semi", "left_anti"):
        joined = joins.join_salted(many, one, ["k"], how, hot_rows=500)
        assert rows(joined) == rows(many.join(one, ["k"], how))
        assert sum(made(joined, "Generate")) <= 299 + joins.SALTS
    sized = one.withColumn("n", F.expr("CASE WHEN k = 7 THEN 1000 ELSE 3 END"))
    assert rows(joins.join_salted(many, sized, ["k"], rows="n", hot_rows=500)) == rows(many.join(sized, ["k"]))


def test_keys_that_come_once_meet_no_further_join(spark, tmp_path):
    lines = spark.range(400).selectExpr("cast(id AS string) AS k", "cast(id AS string) AS t")
    again = spark.range(5).selectExpr("cast(id AS string) AS k", "'again' AS t")
    writers.write_tsv(lines.unionByName(again).coalesce(1), str(tmp_path / "d"), "gzip")
    dump = readers.read_tsv(spark, str(tmp_path / "d"), schemas.all_text("k", "t"), position=True)
    for lost in (keys.split_first(dump, ["k"])[1], keys.split_key(dump.withColumn("_pos", F.col("_pos.row")), ["k"], ["_pos"])[1]):
        assert sum(made(lost, "Generate")) <= 5
        assert sorted((r.k, r.t, r.copies) for r in lost.collect()) == [(str(i), "again", 1) for i in range(5)]


def test_judged_rows_are_not_repeated(spark):
    table = spark.range(300).selectExpr("id % 250 AS id", "concat('n', id) AS name")
    judged = constraints.judge(table, Rules(("id",)), {})
    assert sum(made(judged, "Generate")) <= 300 + 250
    assert {r.outcome: r["count"] for r in judged.groupBy("outcome").count().collect()} == {"kept": 250, "id repeated": 50}


def test_staged_dumps_are_compressed(spark, folder):
    v = Catalogue(spark, folder)
    path = Path(sources.staged_tsv(v, "title.ratings"))
    files = [p for p in path.iterdir() if p.name.startswith("part-")]
    assert files and all(p.name.endswith(".csv.gz") for p in files)
    assert gzip.open(files[0], "rt").readline() == "tconst\taverageRating\tnumVotes\n"
    assert rows(readers.read_tsv(spark, str(path), schemas.RAW["title.ratings"])) == rows(v.raw_ratings)


def test_lines_of_compressed_dumps_keep_their_order(spark, tmp_path):
    """The first line of a key is found over several files."""
    lines = spark.range(1000).selectExpr("cast(id % 7 AS string) AS k", "id AS n", "cast(id AS string) AS t")
    writers.write_tsv(lines.repartitionByRange(5, "n").sortWithinPartitions("n").drop("n"), str(tmp_path / "d"), "gzip")
    dump = readers.read_tsv(spark, str(tmp_path / "d"), schemas.all_text("k", "t"), position=True)
    kept, lost = keys.split_first(dump, ["k"])
    assert {r["k"]: r["t"] for r in kept.collect()} == {str(i): str(i) for i in range(7)}
    assert lost.agg(F.sum("copies")).first()[0] == 993


def test_tasks_of_fp_growth_grow_with_the_baskets(spark, monkeypatch):
    from pyspark.ml.fpm import FPGrowth

    baskets = spark.range(4000).selectExpr("id div 4 AS basket", "(id * 7 + id div 4) % 13 AS item").distinct()
    seen = []
    fit = FPGrowth.fit
    monkeypatch.setattr(FPGrowth, "fit", lambda self, df: seen.append((self.getNumPartitions(), df.rdd.getNumPartitions())) or fit(self, df))
    sets = lambda df: sorted((tuple(r["items"]), r["support"]) for r in df.collect())
    whole = sets(itemsets.fp_growth(baskets, 30))
    monkeypatch.setattr(itemsets, "TASK_CELLS", 400)
    monkeypatch.setattr(itemsets, "GROUP_CELLS", 200)
    assert sets(itemsets.fp_growth(baskets, 30)) == whole == sets(itemsets.as_sets(itemsets.levels(baskets, 30)))
    assert seen[0] == (1, 1) and seen[1][0] > seen[1][1] > 5


def test_tasks_of_pairs_grow_with_the_baskets(spark, monkeypatch):
    baskets = spark.range(4000).selectExpr("id div 4 AS basket", "(id * 7 + id div 4) % 13 AS item").distinct()
    conf = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    few = itemsets.level_two(itemsets.prepare(baskets, 30))
    monkeypatch.setattr(itemsets, "TASK_ROWS", 1000)
    monkeypatch.setattr(itemsets, "TASK_PAIRS", 200)
    p = itemsets.prepare(baskets, 30)
    many = itemsets.level_two(p)
    assert few.rdd.getNumPartitions() == 1 and many.rdd.getNumPartitions() == p.tasks >= 20
    assert rows(many) == rows(few) != [] and rows(itemsets.level(baskets, 2, 30)) == rows(few)
    assert conf == {k: spark.conf.get(k) for k in conf}  # the session's settings are back


def test_pairs_of_a_large_basket_lie_in_many_tasks(spark, monkeypatch):
    baskets = spark.range(1500).selectExpr("0 AS basket", "id AS item").union(spark.range(1500).selectExpr("id div 5 + 1", "id"))
    sizes = baskets.groupBy("basket").agg(F.count("*").alias("n"))
    with itemsets._in_tasks(spark, 40):
        pairs = joins.theta_self(baskets, "basket", "item", sizes, 100)
        of = [r["count"] for r in pairs.groupBy(F.spark_partition_id()).count().collect()]
    assert sum(of) == 1500 * 1499 // 2 + 300 * 10 and max(of) < sum(of) / 8
    few = itemsets.joint_support(baskets, 1)
    monkeypatch.setattr(itemsets, "TASK_PAIRS", 100_000)
    many = itemsets.joint_support(baskets, 1)
    assert few.rdd.getNumPartitions() < 5 and many.rdd.getNumPartitions() > 20
    assert rows(many) == rows(few) and few.count() == 300 * 10


def test_broken_pairs_do_not_move_all_their_rows(spark, monkeypatch):
    """``a`` and ``b`` give ``sum``; in the second look no pair and no target is left that the first one broke."""
    table = spark.range(3000).selectExpr("id % 30 AS a", "id div 100 AS b", "id % 30 + id div 100 AS sum", "xxhash64(id) % 5 AS noise")
    looks = []
    whole = dependencies.unbroken
    monkeypatch.setattr(dependencies, "unbroken", lambda p, pairs, open_, one_in=1: looks.append((one_in, len(open_))) or whole(p, pairs, open_, one_in))
    got = rows(dependencies.minimal_pairs(table))
    assert looks[0][0] == dependencies.FIRST_LOOK and looks[1][0] == 1 and looks[1][1] < looks[0][1]
    monkeypatch.setattr(dependencies, "FIRST_LOOK", 1)
    assert got == rows(dependencies.minimal_pairs(table))
    assert "Row(lhs1='a', lhs2='b', rhs='sum')" in got
