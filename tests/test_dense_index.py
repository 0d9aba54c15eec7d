import pytest

from collections import Counter

from pyspark.sql import functions as F

from dropforge.operators.dense_index import dense_index


def check(df, **options):
    rows = dense_index(df, "i", **options).collect()
    n = df.count()
    assert sorted(r["i"] for r in rows) == list(range(1, n + 1))
    assert Counter(tuple(r)[1:] for r in rows) == Counter(tuple(r) for r in df.collect())
    return rows


def test_empty(spark):
    check(spark.createDataFrame([], "a int, b string"))


def test_nulls_and_blanks_are_different_rows(spark):
    df = spark.createDataFrame([(None, ""), (None, None), (1, ""), (1, None), (1, "")], "a int, b string")
    check(df)


def test_copies_of_one_row_over_chunks(spark):
    df = spark.range(1000).select(F.when(F.col("id") % 3 == 0, F.col("id")).otherwise(7).alias("a"))
    check(df, chunk=10, digits=1)
    check(df, chunk=1, digits=2)


def test_same_index_whatever_the_partitions(spark):
    df = spark.range(500).select((F.col("id") % 40).alias("a"), (F.col("id") % 3).cast("string").alias("b"))
    once = check(df.repartition(7), chunk=5)
    again = check(df.repartition(2, "b"), chunk=5)
    key = lambda r: r["i"]
    assert sorted(once, key=key) == sorted(again, key=key)


def test_only_the_bounded_bucket_table_is_in_one_partition(spark, tmp_path):
    path = str(tmp_path / "rows")
    spark.range(1000).select(F.col("id").alias("a")).write.parquet(path)
    out = dense_index(spark.read.parquet(path), "i")
    out.collect()
    plan = out._jdf.queryExecution().executedPlan().toString()
    final = plan[: plan.index("Initial Plan")]
    assert final.count("Exchange SinglePartition") == 1
    assert "ReusedExchange" in final  # the counted rows are shuffled once


def test_digits_are_bounded(spark):
    for digits in (0, 6):
        with pytest.raises(ValueError, match="digits"):
            dense_index(spark.range(3), digits=digits)
