from dropforge.operators.factored import Factored
from dropforge.sinks.store import Store


def sides(spark):
    left = spark.createDataFrame([("", i) for i in range(40)] + [("a", 1), ("a", 2), (None, 3), ("x", 4)], "`k.l` string, i int")
    right = spark.createDataFrame([("", j) for j in range(30)] + [("a", 9), (None, 8), ("y", 7)], "r string, j int")
    return Factored(left, right, "k.l", "r")


def test_counts_are_those_of_the_join(spark):
    f = sides(spark)
    assert sorted(map(tuple, f.counts().collect())) == [("", 40, 30, 1200), ("a", 2, 1, 2)]
    assert f.expand().count() == 1202 and f.expand(["a"]).count() == 2 and f.expand([]).count() == 0
    plan = f.counts()._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Aggregate") == 2 and plan.index("Join") < plan.index("Aggregate")


def test_sides_as_tables(spark, tmp_path):
    store = Store(spark, root=str(tmp_path))
    sides(spark).save(store, "f")
    kept = Factored.read(store, "f", "k.l", "r")
    assert kept.left.count() == 42 and kept.right.count() == 31
    assert sorted(map(tuple, kept.expand().collect())) == sorted(map(tuple, sides(spark).expand().collect()))
