from pyspark.sql import functions as F

from dropforge.llm import features


def test_sample_never_falls_to_nothing(spark):
    labels = spark.range(200_000).select(F.col("id").alias("doc_id"), F.lit(1).alias("toxic"))
    usable = labels.where(features.fold(F.col("doc_id"), 5) != 0).count()
    for share in (1.0, 0.05, 1e-3):
        n = features.training_sample(labels, "toxic", 5, 0, int(share * usable)).count()
        assert abs(n - share * usable) <= 5 * (share * usable) ** 0.5 + 1
    # With ten billion labels a share is below a millionth: places are finer than that.
    below = spark.range(4_000_000).where(features._place(F.col("id")) < 8e-7).count()
    assert 0 < below < 20


def test_repeated_labels_and_ids_stay_bounded(spark):
    labels = spark.createDataFrame([(1, 0), (1, 1), (1, None), (2, 0), (None, 1), (3, 7)], "doc_id long, toxic int").crossJoin(spark.range(50)).drop("id")
    chosen = features.training_sample(labels, "toxic", 1000, 999, 100)
    assert sorted(map(tuple, chosen.collect())) == [(1, 1.0), (2, 0.0)]
    docs = spark.createDataFrame([(1, t, n) for t in ("a b", None, "c") for n in (5, None)] * 40 + [(2, "", 0), (None, "x", 1), (4, "y", 1)], "doc_id long, text string, n_chars int")
    found = features.labelled(docs, chosen, "text", "n_chars").collect()
    assert len(found) == 2 and {r["_label"] for r in found} == {0.0, 1.0}
    assert features.labelled(docs.repartition(7), chosen, "text", "n_chars").exceptAll(spark.createDataFrame(found)).count() == 0
