"""Session helpers: settings this library relies on, and the shared work folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar
from urllib.parse import urlparse

from pyspark.sql import DataFrame, SparkSession

# Settings every job relies on. Adaptive execution merges small shuffle partitions and
# splits skewed join partitions; for their number at the start see ``size_shuffles``.
# UTC keeps partition columns independent of the host.
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.parquet.compression.codec": "snappy",
    # Shuffle files go when their action is done, not when the driver happens to collect its garbage.
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
}

ROCKSDB_PROVIDER = (
    "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
)


def configure(spark: SparkSession) -> SparkSession:
    """Apply the run-time settings to a session the cluster already created."""
    for key, value in BASE_CONF.items():
        spark.conf.set(key, value)
    return spark


PARTITION_BYTES = 128 * 1024 * 1024  # of input per shuffle partition at the start
UNKNOWN_BYTES = 1 << 60  # the optimizer's guess where it knows nothing is far above


def file_bytes(df: DataFrame) -> int:
    """The optimizer's size of a frame, from file lengths; 0 where it knows nothing."""
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return size if size < UNKNOWN_BYTES else 0


def size_shuffles(spark: SparkSession, *inputs: DataFrame) -> int:
    """Let shuffles start with a partition per 128 MB of the inputs, never fewer than set.

    Adaptive execution only merges partitions of an aggregation, so their first number
    must follow the data. Sizes are the optimizer's, from file lengths; an input without
    files has none and is left out.
    """
    size = sum(map(file_bytes, inputs))
    number = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-size // PARTITION_BYTES))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.initialPartitionNum", number)
    return number


@contextmanager
def state_parts(spark: SparkSession) -> Iterator[None]:
    """Streams started inside keep their state in a part per core, never more than set.

    Every micro-batch opens, commits and uploads each part, however little it holds, so their
    number follows the cores; a part lies on disk and may grow. A stream that goes on from a
    checkpoint keeps the number it began with.
    """
    name = "spark.sql.shuffle.partitions"
    number = spark.conf.get(name)
    spark.conf.set(name, min(int(number), spark.sparkContext.defaultParallelism))
    try:
        yield
    finally:
        spark.conf.set(name, number)


def s3a_conf(endpoint: str, access_key: str, secret_key: str) -> dict[str, str]:
    """Hadoop settings for an S3-compatible store: path style, TLS by URL scheme."""
    url = urlparse(endpoint)
    if url.scheme not in ("http", "https") or not url.hostname:
        raise ValueError(f"endpoint must be an http(s) URL, got: {endpoint!r}")
    return {
        "spark.hadoop.fs.s3a.endpoint": endpoint,
        "spark.hadoop.fs.s3a.access.key": access_key,
        "spark.hadoop.fs.s3a.secret.key": secret_key,
        "spark.hadoop.fs.s3a.path.style.access": "true",
        "spark.hadoop.fs.s3a.connection.ssl.enabled": str(url.scheme == "https").lower(),
    }


def work_dir(spark: SparkSession) -> str:
    """Shared folder for staged tables: the one the cluster names, else a local one.

    A machine-local folder is taken only in local mode; a cluster without
    ``spark.checkpoint.dir`` is an error, since its executors could not share it.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    made = tempfile.mkdtemp(prefix="sluice-")
    spark.conf.set("spark.checkpoint.dir", made)
    return made


_RUN: ContextVar[str] = ContextVar("run", default="shared")


@contextmanager
def scratch(spark: SparkSession) -> Iterator[str]:
    """Tables staged inside, unless for a run of their own, are removed at the end.

    What is to outlive it must be written before, for instance by ``stage`` for another run.
    """
    name = f"scratch-{uuid.uuid4().hex}"
    token = _RUN.set(name)
    try:
        yield name
    finally:
        _RUN.reset(token)
        drop_run(spark, name)


def stage(df: DataFrame, name: str, by: list[str] | None = None,
          run: str | None = None) -> DataFrame:
    """Write ``df`` as a table in the shared folder and read it back.

    Cuts lineage so that several consumers share one computation, and survives the
    loss of executors, since the rows live in files. ``by`` splits the table into
    folders, so that a consumer of one value reads only its share. Tables of one
    ``run`` lie together, so that ``drop_run`` can remove them; without one they belong to
    the ``scratch`` they are made in, or to all.
    """
    spark = df.sparkSession
    path = f"{run_dir(spark, run or _RUN.get())}/{name}-{uuid.uuid4().hex}"
    writer = df.write.option("compression", "zstd")  # ids in hexadecimal take half the room of snappy
    if by:
        writer = writer.partitionBy(*by)
    writer.parquet(path)
    return spark.read.schema(df.schema).parquet(path).select(*df.columns)


def run_dir(spark: SparkSession, run: str) -> str:
    return f"{work_dir(spark)}/stage/{run}"


def drop_run(spark: SparkSession, run: str) -> None:
    """Remove the staged tables of a run once nothing reads them any more."""
    path = spark._jvm.org.apache.hadoop.fs.Path(run_dir(spark, run))
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
