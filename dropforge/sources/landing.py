"""Choice of the newest drop per source in a landing zone."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dropforge.session import exists
from dropforge.sources.schemas import SOURCES, Source

# Endings of files that are no drops.
SKIPPED = r"\.(gpg|xlsx)$"


def list_files(spark: SparkSession, root: str, folders=()) -> DataFrame:
    """Path and modification time of the files under ``root``, or under its ``folders`` that are there.

    Contents are not read, and folders that were not asked for are not listed.
    """
    root = root.rstrip("/")
    listed = None
    for folder in dict.fromkeys(f.strip("/") for f in folders or [""]):
        at = f"{root}/{folder}" if folder else root
        if folder and not exists(spark, at):
            continue
        files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(at)
        files = files.select("path", F.col("modificationTime").alias("modified"))
        listed = files if listed is None else listed.unionByName(files)
    return spark.createDataFrame([], "path string, modified timestamp") if listed is None else listed


def newest_per_source(files: DataFrame, root: str, sources) -> DataFrame:
    """The latest drop per source among ``files`` (path, modified).

    A drop is a file or a folder of part files that lies directly in the folder of its source and has the
    keyword in its name; it may belong to several sources. Drops of one time are told apart by path. Sources
    are matched by an expression over their fixed list and the maximum is taken on the map side first, so a
    keyword with very many files costs one pass over the listing.
    """
    root = re.sub("^file:/+", "/", root.rstrip("/"))
    parts = f"^(.*?{re.escape(root)})/(.*)$"
    start, below = (F.regexp_extract("path", parts, i) for i in (1, 2))
    drops = files.select("modified", start.alias("_root"), below.alias("_below"))

    found = []
    for s in sources:
        folder = s.folder.strip("/")
        name = F.split(F.substring("_below", len(folder) + 2, 2**31 - 1) if folder else F.col("_below"), "/")[0]
        hit = name.contains(s.keyword)
        if folder:
            hit &= F.col("_below").startswith(folder + "/")
        if not s.any_extension:
            hit &= ~F.lower(name).rlike(SKIPPED)
        path = F.concat_ws("/", F.col("_root"), *([F.lit(folder)] if folder else []), name)
        found.append(F.when(hit, F.struct(F.lit(s.name).alias("source"), path.alias("path"))))
    return (
        drops.select("modified", F.inline(F.array_compact(F.array(*found))))
        .groupBy("source")
        .agg(F.max(F.struct("modified", "path")).alias("latest"))
        .select("source", "latest.path", "latest.modified")
    )


def select_drops(spark: SparkSession, root: str, sources: dict[str, Source] | None = None) -> dict[str, str]:
    """Path of the newest drop of each source that has one. At most one row per declared source is collected."""
    declared = (sources or SOURCES).values()
    chosen = newest_per_source(list_files(spark, root, [s.folder for s in declared]), root, declared)
    return {row["source"]: row["path"] for row in chosen.collect()}
