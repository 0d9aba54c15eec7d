"""Dense index that keeps its numbers: a row that was there before has the number it had.

A row is known by a digest of its values and, among copies, by its place: the copies of one row are 0, 1, 2, … Rows that
were numbered before keep their number. New rows take the numbers that rows now gone have left, then the next ones; if
there are fewer rows than before, those numbered beyond the new end move into what is free. So the numbers are 1..n after
every load, and where rows only come none of the old ones changes.

Every step is a join or a count on keys that occur once (digest and chunk of copies, number), so no key is hot however many
copies a row has. Values travel in one exchange for counting and one for the join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dropforge.operators.dense_index import dense_index
from dropforge.session import scratch

ROW, COPY = "_row", "_copy"
CHUNK = 10_000
_NULL, _SEP = "\u0000", "\u001f"


def _written(df: DataFrame, label: str) -> DataFrame:
    path = scratch(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _key(columns: list[str]):
    # With the length of each value, so that no separator inside a value can make two rows alike.
    parts = []
    for c in columns:
        text = F.col(f"`{c}`").cast("string")
        parts.append(F.coalesce(F.concat(F.length(text).cast("string"), F.lit(":"), text), F.lit(_NULL)))
    return F.unhex(F.md5(F.concat_ws(_SEP, *parts)))


def stable_index(df: DataFrame, kept: DataFrame | None = None, name: str = "index") -> DataFrame:
    """``df`` with ``name``, a bigint 1..n, and the key of each row (``_row``, ``_copy``).

    ``kept`` holds ``_row, _copy, <name>`` of an earlier result, None for the first one; save these columns of the result
    for the next time. Columns must have a text form that tells their values apart.
    """
    spark, columns = df.sparkSession, df.columns
    if kept is None:
        kept = spark.createDataFrame([], f"{ROW} binary, {COPY} long, `{name}` long")
    counted = df.groupBy(*[F.col(f"`{c}`") for c in columns]).agg(F.count(F.lit(1)).alias("_copies"))
    chunks = (
        counted.withColumn(ROW, _key(columns))
        .withColumn("_chunk", F.explode(F.sequence(F.lit(0).cast("long"), F.expr(f"(_copies - 1) div {CHUNK}"))))
        .withColumn("_size", F.least(F.lit(CHUNK), F.col("_copies") - F.col("_chunk") * CHUNK))
    )
    numbers = (
        kept.select(ROW, F.expr(f"{COPY} div {CHUNK}").alias("_chunk"), F.struct(COPY, F.col(f"`{name}`").alias("_number")).alias("_had"))
        .groupBy(ROW, "_chunk")
        .agg(F.array_sort(F.collect_list("_had")).alias("_had"))  # at most CHUNK of them
    )
    place = F.col("_place")
    placed = (
        chunks.join(numbers, [ROW, "_chunk"], "left")
        .select(*[F.col(f"`{c}`") for c in columns], ROW, "_chunk", "_had", F.explode(F.sequence(F.lit(0), (F.col("_size") - 1).cast("int"))).alias("_place"))
        .select(
            *[F.col(f"`{c}`") for c in columns], ROW, (F.col("_chunk") * CHUNK + place).alias(COPY),
            F.get("_had", place)["_number"].alias("_number"),
        )
    )
    placed = _written(placed, "placed")
    sizes = placed.agg(F.count(F.lit(1)).alias("n"), F.count("_number").alias("old"), F.max("_number").alias("top")).first()
    n, top = sizes["n"], sizes["top"] or 0
    stays = F.coalesce(F.col("_number") <= n, F.lit(False))
    old = placed.where(stays).withColumnRenamed("_number", name)
    if sizes["old"] == n and top == n:
        return old
    new = dense_index(placed.where(~stays).select(ROW, COPY), "_rank")
    if sizes["old"] == top:  # 1..top are all taken: the new rows follow
        numbered = new.select(ROW, COPY, (F.col("_rank") + top).alias(name))
    else:
        taken = placed.where(stays).select(F.col("_number").alias("_free"))
        free = spark.range(1, n + 1).select(F.col("id").alias("_free")).join(taken, "_free", "left_anti")
        numbered = dense_index(free, "_rank").join(new, "_rank").select(ROW, COPY, F.col("_free").alias(name))
    fresh = placed.where(~stays).drop("_number").join(numbered, [ROW, COPY])
    return old.unionByName(fresh)
