"""Incremental landing: every drop of a source that has come since the last call goes into the history, once.

A file stream finds new drops; only paths and times are read from it, not contents. Its checkpoint knows which drops it
has handed out. A batch of drops is one commit of the store, and the number of the batch is published with its loads: a
batch that is handed out again after a crash is recognised, so a drop is never there twice and never half.

A drop belongs to the day it was last changed (in the session's time zone) and is added beside other drops of that day;
the one changed last is the current table. Drops are files that lie in the folder of their source: a folder of part files
is taken by ``dropforge.sinks.load`` instead. A wrong header stops the call before anything of its batch is published, and
the batch comes again with the next call.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dropforge.quality.drops import header_report, require_valid
from dropforge.quality.expectations import Expectation
from dropforge.sinks.load import load_drop
from dropforge.sinks.store import Store
from dropforge.sources.headers import read_headers
from dropforge.sources.landing import SKIPPED
from dropforge.sources.schemas import Source

#: The columns of the file source for whole files; the last one is never read.
FILES = T.StructType([
    T.StructField("path", T.StringType()), T.StructField("modificationTime", T.TimestampType()),
    T.StructField("length", T.LongType()), T.StructField("content", T.BinaryType()),
])
FILES_A_BATCH = 200


def new_drops(store: Store, landing: str, source: Source, files_a_batch: int = FILES_A_BATCH) -> DataFrame:
    """Stream of ``path, modified`` of the drops of a source."""
    folder = "/".join(part for part in (landing.rstrip("/"), source.folder.strip("/")) if part)
    files = store.spark.readStream.format("binaryFile").schema(FILES).option("maxFilesPerTrigger", files_a_batch).load(folder)
    name = F.element_at(F.split("path", "/"), -1)
    hit = name.contains(source.keyword)
    if not source.any_extension:
        hit &= ~F.lower(name).rlike(SKIPPED)
    return files.where(hit).select("path", F.col("modificationTime").alias("modified"))


def load_new_drops(
    store: Store,
    landing: str,
    source: Source,
    checkpoint: str,
    *,
    suite: list[Expectation] | None = None,
    files_a_batch: int = FILES_A_BATCH,
    at_once: int = 4,
) -> list[tuple[str, dict[str, int]]]:
    """Load what is new and return; gives the path of each drop loaded with its counts of faults.

    ``checkpoint`` is a folder of this source's own. Call it whenever drops may have come.
    """
    loaded: list[tuple[str, dict[str, int]]] = []
    stream = f"{source.name} {checkpoint.rstrip('/')}"

    def load_batch(found: DataFrame, batch: int) -> None:
        last = store.version()["streams"].get(stream)
        if last and batch <= last["batch"]:
            return  # published before a crash kept the stream from noting it
        # At most files_a_batch rows.
        drops = found.select("path", "modified", F.to_date("modified").alias("day")).orderBy("modified", "path").collect()
        headers = read_headers(store.spark, {d["path"]: source for d in drops}, at_once)
        require_valid(header_report(store.spark, {d["path"]: source for d in drops}, headers))
        done = []
        with store.commit() as run:
            with ThreadPoolExecutor(at_once) as pool:
                # Each drop in a commit of its own making; put together in the order of their times.
                runs = list(pool.map(lambda d: _one(store, d, source, headers[d["path"]], suite), drops))
            for d, (own, counts) in zip(drops, runs, strict=True):
                run.changes += own.changes
                done.append((d["path"], counts))
            run.passed(stream, batch)
        loaded.extend(done)

    query = (
        new_drops(store, landing, source, files_a_batch)
        .writeStream.foreachBatch(load_batch)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return loaded


def _one(store: Store, drop, source: Source, header, suite):
    own = store.begin()
    counts, _ = load_drop(own, drop["path"], source, drop["day"], header, suite, beside=True)
    return own, counts
