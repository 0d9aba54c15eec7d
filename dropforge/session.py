"""Session defaults and the shared scratch folder."""

from __future__ import annotations

import atexit
import math
import shutil
import tempfile
import uuid

from pyspark.sql import SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"


MB = 1024**2
PARTITION_BYTES = 512 * MB
MOST_SPLITS = 200_000


def shuffle_partitions(data_bytes: int, cores: int = 1, most: int | None = None) -> int:
    """Partitions to start a shuffle with: half a gigabyte each at any size.

    ``most`` limits them, for a driver that can't keep the state of so many; partitions then grow with the data.
    """
    wanted = max(cores, math.ceil(data_bytes / PARTITION_BYTES))
    return min(wanted, most) if most else wanted


def split_bytes(data_bytes: int) -> int:
    """Bytes a scan task reads: Spark's 128 MB, and up to 1 GB where that would make too many tasks."""
    return min(max(128 * MB, math.ceil(data_bytes / MOST_SPLITS)), 1024 * MB)


def session(
    app: str = "dropforge", *, data_bytes: int | None = None, most_partitions: int | None = None, **conf: str
) -> SparkSession:
    """A session with the settings the builders count on; ``conf`` comes last.

    ``data_bytes``, the size of the largest table, sets how much a scan task reads and how many partitions
    shuffles start with, ``most_partitions`` at most if given; adaptive execution brings those down where a shuffle turns
    out to be small.
    """
    defaults = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        # The JVM compiles methods of up to 8000 bytecodes; a fused stage over a table of a hundred columns and
        # more passes that and would be interpreted, so such stages are better not fused.
        "spark.sql.codegen.hugeMethodLimit": "8000",
    }
    if data_bytes:
        defaults["spark.sql.shuffle.partitions"] = str(shuffle_partitions(data_bytes, 200, most_partitions))
        defaults["spark.sql.files.maxPartitionBytes"] = str(split_bytes(data_bytes))
    builder = SparkSession.builder.appName(app)
    for key, value in {**defaults, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


_local_root: str | None = None


def scratch(spark: SparkSession, label: str) -> str:
    """A new folder name under the shared checkpoint folder of the cluster, local only where none is set."""
    global _local_root
    root = spark.conf.get(CHECKPOINT_DIR, None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError(f"set {CHECKPOINT_DIR} to a folder all executors share")
        if _local_root is None:
            _local_root = tempfile.mkdtemp(prefix="dropforge-")
            atexit.register(shutil.rmtree, _local_root, ignore_errors=True)
        root = _local_root
    return f"{root.rstrip('/')}/{label}-{uuid.uuid4().hex}"


def exists(spark: SparkSession, path: str) -> bool:
    """Whether there is a file or folder, wherever Spark can read it."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()).exists(at)


def size_of(spark: SparkSession, path: str) -> int:
    """Bytes of a file or of all files in a folder."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()).getContentSummary(at).getLength()
