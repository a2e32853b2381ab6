"""The lake: partitioned Parquet, written in files of bounded size and scanned back."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.functions.text import strip_slashes
from sluice.operators.record import partition_columns, stored_record
from sluice.operators.report import files
from sluice.spec import PARTITION_FIELDS, STORED_FIELDS, PipelineConfig

DATA = "data"
QUARANTINE = "quarantine"
DEAD_LETTERS = "dlq"
RUNS = "_runs"

_TYPES = {"schema_valid": "boolean", "drift_detected": "boolean", "breaking_change": "boolean",
          "quality_score": "double", "quality_passed": "boolean", "quality_threshold": "double"}

# Declared types spare the schema inference; partition values are read as numbers.
LAKE_TYPE = ", ".join(
    [f"`{c}` {_TYPES.get(c, 'string')}" for c in STORED_FIELDS if c != "source"]
    + ["year int", "month int", "day int", "hour int", "source string"])


def lake_path(root: str, prefix: str) -> str:
    return f"{root.rstrip('/')}/{strip_slashes(prefix)}"


def file_system(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target, target.getFileSystem(spark._jsc.hadoopConfiguration())


def scan_lake(spark: SparkSession, root: str, prefix: str = DATA,
              folder: str = "") -> DataFrame:
    """Stored records under a prefix; partition folders become columns.

    ``folder`` (such as ``year=2024/month=06``) limits the listing of files to a part of
    the lake, which matters when the lake has very many; one that is missing is empty.
    """
    base = lake_path(root, prefix)
    if not folder:
        return spark.read.schema(LAKE_TYPE).parquet(base)
    target, fs = file_system(spark, f"{base}/{folder}")
    if not fs.exists(target):
        return spark.createDataFrame([], LAKE_TYPE)
    return spark.read.schema(LAKE_TYPE).option("basePath", base).parquet(f"{base}/{folder}")


def newest_folder(spark: SparkSession, root: str, prefix: str) -> str | None:
    """Folder of the newest hour under a prefix, found by listing one level at a time."""
    base, folder = lake_path(root, prefix), ""
    for level in PARTITION_FIELDS[:-1]:
        target, fs = file_system(spark, f"{base}/{folder}")
        if not fs.exists(target):
            return None
        names = [s.getPath().getName() for s in fs.listStatus(target)]
        names = [n for n in names if n.startswith(f"{level}=")]
        if not names:
            return None
        folder = f"{folder}/{max(names)}" if folder else max(names)
    return folder


def record_bytes(spark: SparkSession, root: str, prefix: str, cfg: PipelineConfig) -> float:
    """Bytes per record of the prefix's newest hour; a default without history.

    Only the files of that hour are looked at, and of them only size and row count.
    """
    folder = newest_folder(spark, root, prefix)
    if folder is None:
        return float(cfg.default_record_bytes)
    last = scan_lake(spark, root, prefix, folder)
    got = files(last).agg(F.sum("bytes").alias("b"), F.sum("records").alias("n")).first()
    return got["b"] / got["n"] if got["n"] else float(cfg.default_record_bytes)


def records_per_file(bytes_per_record: float, cfg: PipelineConfig) -> int:
    """Records that fill a file of the target size, at most the safety cap."""
    wanted = int(cfg.target_file_mb * 1024 * 1024 / max(bytes_per_record, 1.0))
    return max(1, min(wanted, cfg.max_records_per_file))


def write_lake(validated: DataFrame, root: str, prefix: str, cfg: PipelineConfig,
               bytes_per_record: float | None = None, parts: int | None = 1,
               to: str | None = None) -> None:
    """Append validated events under a prefix, partitioned by intake hour and source.

    ``rebalance`` sends rows of one partition folder together, cut by event id into
    ``parts``, and splits what is still large over several tasks; the record limit
    bounds each file. With ``parts`` None the rows stay where they are, which is right for a
    frame that is already cut into as many tasks as files are wanted. ``to`` is another
    folder to write to, for rows that are published later.
    """
    spark = validated.sparkSession
    if bytes_per_record is None:
        bytes_per_record = record_bytes(spark, root, prefix, cfg)
    rows = partition_columns(stored_record(validated))
    if parts is not None:
        part = F.pmod(F.xxhash64("event_id"), F.lit(max(parts, 1)))
        rows = rows.withColumn("_part", part).hint(
            "rebalance", *[F.col(c) for c in [*PARTITION_FIELDS, "_part"]]).drop("_part")
    (rows.write.mode("append")
     .option("compression", "snappy")
     .option("maxRecordsPerFile", records_per_file(bytes_per_record, cfg))
     .partitionBy(*PARTITION_FIELDS)
     .parquet(to or lake_path(root, prefix)))


@dataclass(frozen=True)
class Sink:
    """Files for one prefix of the lake; called, it writes them there or to another folder."""

    prefix: str
    write: Callable[[str | None], None]

    def __call__(self, to: str | None = None) -> None:
        self.write(to)


def once_per_run(spark: SparkSession, root: str, run: str, sink: str,
                 write: Callable[[], None]) -> bool:
    """Do a sink of a run exactly once, however often the run is done again.

    A ``Sink`` is published: it writes its files to a folder of the run, and their list is
    the commit record. Before the record exists a repetition starts over; after it exists
    a repetition only finishes the moves into the lake, which can be repeated file by file.
    So no failure doubles or loses a row, and a reader sees no file of a run without commit
    record. Moving costs the driver one call a file, as the usual output committer does.
    Any other action is done unless its mark, set right after it, is there.
    """
    done, fs = file_system(spark, f"{run_path(root, run)}/done/{sink}")
    if fs.exists(done):
        return False
    if isinstance(write, Sink):
        _publish(spark, root, run, sink, write)
    else:
        write()
    fs.create(done, True).close()
    return True


def _publish(spark: SparkSession, root: str, run: str, sink: str, write: Sink) -> None:
    out, fs = file_system(spark, f"{run_path(root, run)}/out/{sink}")
    record, _ = file_system(spark, f"{run_path(root, run)}/files/{sink}")
    if not fs.exists(record):
        fs.delete(out, True)
        write.write(out.toString())
        write_text(spark, record, "\n".join(data_files(fs, out)))
    target, _ = file_system(spark, lake_path(root, write.prefix))
    made: set[str] = set()
    for name in filter(None, read_text(spark, record).split("\n")):
        source, place = _below(spark, out, name), _below(spark, target, name)
        folder = name.rpartition("/")[0]
        if folder not in made:
            fs.mkdirs(place.getParent())
            made.add(folder)
        moved = fs.rename(source, place) if fs.exists(source) else fs.exists(place)
        if not moved:
            raise OSError(f"{source} cannot be moved to {place}")
    fs.delete(out, True)


def _below(spark: SparkSession, base, name: str):
    return spark._jvm.org.apache.hadoop.fs.Path(base, spark._jvm.org.apache.hadoop.fs.Path(name))


def data_files(fs, folder) -> list[str]:
    """Files below a folder, by their paths from there; marks of the committer are left out."""
    if not fs.exists(folder):
        return []
    base = fs.getFileStatus(folder).getPath().toUri().getPath().rstrip("/") + "/"
    found, files = [], fs.listFiles(folder, True)
    while files.hasNext():
        path = files.next().getPath()
        if not path.getName().startswith(("_", ".")):
            found.append(path.toUri().getPath()[len(base):])
    return sorted(found)


def write_text(spark: SparkSession, path, text: str) -> None:
    """A small file that is there whole or not at all."""
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    draft = path.suffix(".draft")
    out = fs.create(draft, True)
    out.write(bytearray(text.encode()))
    out.close()
    fs.rename(draft, path)


def read_text(spark: SparkSession, path) -> str:
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    stream = fs.open(path)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def run_path(root: str, run: str) -> str:
    """Folder of what the lake keeps about one run: finished sinks and what it left open."""
    return lake_path(root, f"{RUNS}/{run}")


def remember_previous(spark: SparkSession, root: str, run: str, previous: str | None) -> None:
    """Note which run came before, and forget the one before that, which nobody follows now."""
    note, fs = file_system(spark, f"{run_path(root, run)}/previous")
    if not fs.exists(note):
        write_text(spark, note, previous or "")
    if previous:
        older, _ = file_system(spark, f"{run_path(root, previous)}/previous")
        if fs.exists(older) and (name := read_text(spark, older)):
            forget_run(spark, root, name)


def forget_run(spark: SparkSession, root: str, run: str) -> None:
    """Remove what is kept about a run that will not be repeated or followed any more."""
    path, fs = file_system(spark, run_path(root, run))
    fs.delete(path, True)


def write_dead_letters(letters: DataFrame, root: str, to: str | None = None) -> None:
    letters.select("key", "value", "headers").write.mode("append").parquet(
        to or lake_path(root, DEAD_LETTERS))
