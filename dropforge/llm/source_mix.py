"""Mixing sources to target weights by Pareto order sampling.

Every source gets a target in words: its weight's share of ``share`` times all words, at most ``most`` times the words
it has; what a source can't take is shared again by weight. A source with target ``f`` times its words first takes
``floor(f)`` whole copies of every document. The rest is an unequal-probability sample without replacement: each
document draws a random number ``u``, and documents are ranked by ``(u / (1 - u)) / odds`` with inclusion odds in
proportion to their size (the factor that makes the odds of a source sum to its sample is the same for all its
documents, so the ranks do not need it). Documents are taken in rank order up to the one that brings the source nearest
to its target, which fixes the size of the sample in words.

The cut is found from sums over ``BINS`` bins of the rank and one window over the bin it falls in, so no task holds a
source. ``u`` comes from a digest of the id, so reruns agree.

* A null or empty text has size 0 and is never taken.
* A null source is a source of its own, the last one. A null id draws as the empty id.
* Rows of one source with equal id and size have one rank: they are taken or left together.
* Without documents the result is empty. Columns of the input named like an added one are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from dropforge.llm.tables import table, written

WEIGHTS = (5.0, 2.0, 1.0)
SHARE = 1.5
MOST = 2.0
BINS = 4096
SEED = "mix-1"


def size_of(text: str = "text") -> Column:
    return F.coalesce(F.regexp_count(F.col(text), F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def _draw(doc_id: str, seed: str) -> Column:
    digits = F.substring(F.md5(F.concat(F.coalesce(F.col(doc_id).cast("string"), F.lit("")), F.lit(":" + seed))), 1, 13)
    return (F.conv(digits, 16, 10).cast("double") + 0.5) / F.lit(float(2**52))


def _rank_value(doc_id: str, size: str, seed: str) -> Column:
    u = _draw(doc_id, seed)
    return F.when(F.col(size) > 0, (u / (1.0 - u)) / F.col(size))


def _numbered(sources: DataFrame) -> DataFrame:
    """Sources in code point order with their place ``_i``: a range sort, then the offsets of its few partitions."""
    part = F.spark_partition_id()
    placed = written(
        sources.repartitionByRange(F.col("_source").asc_nulls_last()).sortWithinPartitions(F.col("_source").asc_nulls_last())
        .select("*", part.alias("_part"), (F.monotonically_increasing_id() - F.shiftleft(part.cast("long"), 33)).alias("_at")),
        "mix-sources",
    )
    before = F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1))
    offsets = placed.groupBy("_part").agg(F.count(F.lit(1)).alias("_n")).select("_part", F.coalesce(before, F.lit(0)).alias("_before"))
    return placed.join(offsets, "_part").select("_source", "_words", (F.col("_before") + F.col("_at")).alias("_i"))


def targets(sources: DataFrame, weights=WEIGHTS, share=SHARE, most=MOST) -> DataFrame:
    """``_source, _words, _target`` from ``_source, _words``."""
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("_i") % len(weights) + 1).cast("int"))
    s = written(_numbered(sources).withColumn("_weight", weight).withColumn("_most", most * F.col("_words")), "mix-weights")
    level = 0.0
    while True:  # the level only rises, and each round puts at least one more source at its limit
        row = s.agg(
            F.sum("_words").alias("words"),
            F.sum(F.when(F.col("_most") < level * F.col("_weight"), F.col("_most")).otherwise(0.0)).alias("full"),
            F.sum(F.when(F.col("_most") < level * F.col("_weight"), 0.0).otherwise(F.col("_weight"))).alias("rest"),
        ).first()
        if not row["words"] or not row["rest"]:
            break
        higher = (share * row["words"] - row["full"]) / row["rest"]
        if higher <= level:
            break
        level = higher
    return s.select("_source", "_words", F.least(F.col("_most"), level * F.col("_weight")).alias("_target"))


def mix(docs: DataFrame, weights=WEIGHTS, share=SHARE, most=MOST, bins=BINS, seed=SEED) -> DataFrame:
    """The documents with ``size, source_size, target, copies, taken``; ``copies`` is 0 for those left out."""
    slim = written(docs.select(F.col("source").alias("_source"), F.col("doc_id").alias("_doc"), size_of().alias("_size")), "mix-sizes")
    slim = slim.withColumn("_rank", _rank_value("_doc", "_size", seed))
    sources = slim.groupBy("_source").agg(F.sum("_size").alias("_words"), F.sum((F.col("_size") > 0).cast("long")).alias("_docs"))
    sources = written(sources, "mix-totals")
    aims = targets(sources.select("_source", "_words"), weights, share, most)
    aims = aims.join(sources.select(F.col("_source").alias("_s"), "_docs"), F.col("_source").eqNullSafe(F.col("_s"))).drop("_s")
    aims = aims.withColumn("_whole", F.when(F.col("_words") > 0, F.floor(F.col("_target") / F.col("_words"))).otherwise(F.lit(0)))
    aims = written(aims.withColumn("_need", F.col("_target") - F.col("_whole") * F.col("_words")), "mix-aims")

    scaled = F.col("_rank") * F.col("_words") / F.col("_docs")
    binned = (
        slim.where(F.col("_size") > 0)
        .join(aims.select(F.col("_source").alias("_s"), "_words", "_docs", "_need"), F.col("_source").eqNullSafe(F.col("_s"))).drop("_s")
        .withColumn("_bin", F.floor(bins * (scaled / (1.0 + scaled))))
    )
    order = Window.partitionBy("_source").orderBy("_bin")
    sums = binned.groupBy("_source", "_need", "_bin").agg(F.sum("_size").alias("_sum"))
    sums = sums.withColumn("_end", F.sum("_sum").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    cut = sums.where("_end >= _need").groupBy("_source").agg(
        F.min(F.struct("_bin", (F.col("_end") - F.col("_sum")).alias("_start"))).alias("_cut")
    ).select(F.col("_source").alias("_s"), F.col("_cut._bin").alias("_cut_bin"), F.col("_cut._start").alias("_start"))

    # Inside the bin: groups of equal rank values in order, and the first one that is left out.
    key = F.struct("_rank", "_doc", "_size")
    inside = binned.join(cut, F.col("_source").eqNullSafe(F.col("_s")) & (F.col("_bin") == F.col("_cut_bin"))).drop("_s")
    inside = inside.groupBy("_source", "_need", "_start", "_rank", "_doc", "_size").agg((F.count(F.lit(1)) * F.col("_size")).alias("_both"))
    running = F.sum("_both").over(Window.partitionBy("_source").orderBy(key).rowsBetween(Window.unboundedPreceding, 0))
    inside = inside.withColumn("_middle", F.col("_start") + running - F.col("_both") / 2)
    first_out = inside.where("_middle >= _need").groupBy("_source").agg(F.min(key).alias("_first_out"))
    # All of the bin taken: the cut is at its end.
    limits = aims.join(cut, F.col("_source").eqNullSafe(F.col("_s")), "left").drop("_s").join(
        first_out.withColumnRenamed("_source", "_s"), F.col("_source").eqNullSafe(F.col("_s")), "left"
    ).drop("_s")
    limits = written(limits, "mix-limits").withColumnRenamed("_source", "_s")

    added = ("size", "source_size", "target", "copies", "taken")
    out = docs.drop(*added).withColumn("_size", size_of()).withColumn("_rank", _rank_value("doc_id", "_size", seed))
    out = out.join(limits, F.col("source").eqNullSafe(F.col("_s")), "left")
    own = F.struct(F.col("_rank"), F.col("doc_id").alias("_doc"), F.col("_size"))
    own_bin = F.floor(bins * (scaled / (1.0 + scaled)))
    chosen = (
        (F.col("_size") > 0) & (F.col("_need") > 0)
        & F.when(F.col("_cut_bin").isNull() | (own_bin < F.col("_cut_bin")), True)
        .when(own_bin > F.col("_cut_bin"), False)
        .otherwise(F.col("_first_out").isNull() | (own < F.col("_first_out")))
    )
    copies = F.when(F.col("_size") > 0, F.col("_whole") + chosen.cast("long")).otherwise(F.lit(0)).cast("long")
    return out.withColumns({
        "size": F.col("_size"), "source_size": F.coalesce(F.col("_words"), F.lit(0)), "target": F.col("_target"), "copies": copies,
        "taken": copies * F.col("_size"),
    }).select(*[c for c in docs.columns if c not in added], *added)


def op6_source_mix(spark, sf_dir) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    return mix(docs).select("doc_id", "size", "source_size", "target", "taken", "copies")


SQL = """
WITH d AS (SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0)::BIGINT AS size FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS words,
  [5.0, 2.0, 1.0][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INT]::DOUBLE AS weight FROM d GROUP BY source),
o AS (SELECT *, 2.0 * words AS most,
  coalesce(sum(2 * words) OVER before, 0)::DOUBLE AS full_before, sum(words) OVER ()::DOUBLE AS all_words,
  (sum(weight) OVER () - coalesce(sum(weight) OVER before, 0))::DOUBLE AS rest FROM s
  WINDOW before AS (ORDER BY 2.0 * words / weight, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
level AS (SELECT arg_min((1.5::DOUBLE * all_words - full_before) / rest, 2.0 * words / weight) AS theta FROM o
  WHERE (1.5::DOUBLE * all_words - full_before) / rest <= 2.0::DOUBLE * words / weight),
a AS (SELECT source, words, least(most::DOUBLE, theta * weight)::DOUBLE AS target FROM o, level),
b AS (SELECT *, CASE WHEN words > 0 THEN floor(target / words) ELSE 0 END AS whole FROM a),
r AS (SELECT d.*, b.words, b.target, b.whole, b.target - b.whole * b.words AS need,
  (CAST('0x' || substr(md5(coalesce(doc_id::VARCHAR, '') || ':mix-1'), 1, 13) AS BIGINT)::DOUBLE + 0.5) / 4503599627370496.0::DOUBLE AS u
  FROM d JOIN b ON d.source IS NOT DISTINCT FROM b.source),
c AS (SELECT *, sum(CASE WHEN size > 0 THEN size ELSE 0 END) OVER (PARTITION BY source ORDER BY
  CASE WHEN size > 0 THEN (u / (1.0::DOUBLE - u)) / size END NULLS LAST, doc_id, size ROWS UNBOUNDED PRECEDING) AS running FROM r)
SELECT doc_id, size, words AS source_size, target,
  CASE WHEN size = 0 THEN 0 ELSE (whole + CASE WHEN need > 0 AND running - size / 2.0 < need THEN 1 ELSE 0 END) * size END::BIGINT AS taken,
  CASE WHEN size = 0 THEN 0 ELSE whole + CASE WHEN need > 0 AND running - size / 2.0 < need THEN 1 ELSE 0 END END::BIGINT AS copies
FROM c
"""
