"""Which files of a folder cannot be read, and why."""

from __future__ import annotations

import re
import sys

import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession, functions as F

from barsmith.session import scratch_table
from barsmith.sources.snapshots import latest

# The functions that run in tasks travel with the job; executors need not have this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

PROBED = "path string, bytes bigint, rows bigint, first timestamp_ntz, last timestamp_ntz, reason string"
FILES_A_TASK = 256


def _probe(path: str) -> tuple:
    """Rows of a Parquet file and the range of its times by its footer, or why that cannot be read."""
    try:
        files, place = fs.FileSystem.from_uri(re.sub(r"^file:/+", "/", path))
        with files.open_input_file(place) as file:
            footer = pq.read_metadata(file)
        return footer.num_rows, *_range(footer), None
    except (pa.ArrowException, OSError, ValueError) as error:
        said = str(error).split("\n")[0]
        if "magic bytes" in said or "minimum file footer" in said:
            return None, None, None, "not a Parquet file"
        return None, None, None, f"{type(error).__name__}: {said}"[:200]


def _range(footer) -> tuple:
    """The least and the largest `timestamp` in UTC; None where a part of the file does not tell."""
    names = [footer.schema.column(i).path for i in range(footer.num_columns)]
    if "timestamp" not in names:
        return None, None
    ends = []
    for group in range(footer.num_row_groups):
        part = footer.row_group(group).column(names.index("timestamp"))
        known = part.statistics
        if known is None or not known.has_min_max:
            if known is None or known.null_count != part.num_values:
                return None, None
            continue
        ends += [known.min.replace(tzinfo=None), known.max.replace(tzinfo=None)]
    return (min(ends), max(ends)) if ends else (None, None)


def probe_files(files: DataFrame) -> DataFrame:
    """path, bytes, rows, first, last, reason of Parquet files (path, length); `reason` is NULL for readable ones.

    The files' footers are read in tasks, by ranges; no page of data is. `first` and `last` are the range
    of the column `timestamp`. Files that `pyarrow.fs` cannot open have that as their reason.
    """

    def run(batches):
        kinds = [pa.int64(), pa.timestamp("us"), pa.timestamp("us"), pa.string()]
        for batch in batches:
            found = [_probe(path) for path in batch.column(0).to_pylist()]
            columns = [pa.array([f[i] for f in found], kind) for i, kind in enumerate(kinds)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), *columns], names=["path", "bytes", "rows", "first", "last", "reason"]
            )

    files = scratch_table(files.select("path", "length"), "files")
    tasks = max(1, -(-files.count() // FILES_A_TASK))
    return files.repartition(tasks, "path").mapInArrow(run, PROBED)


def list_files(spark: SparkSession, *paths: str, pattern: str = "*") -> DataFrame:
    """path, length of the files below folders; none is opened. Spark leaves out empty ones."""
    reader = spark.read.format("binaryFile").options(recursiveFileLookup=True, pathGlobFilter=pattern)
    return reader.load(list(paths)).select("path", "length")


def store_files(spark: SparkSession, base: str) -> DataFrame | None:
    """`probe_files` of the files of a store that count, with their `folder`; None if there is no store."""
    base = base.rstrip("/")
    snapshot = latest(spark, base)
    paths, left_out = ([], []) if snapshot is None else snapshot.paths(base)
    if not paths:
        return None
    folder = F.regexp_extract("path", "/(gen=[^/]*/.*)/[^/]*$", 1)
    files = list_files(spark, *paths).where(~folder.isin(left_out) if left_out else F.lit(True))
    return probe_files(files).withColumn("folder", folder)


def quarantined(spark: SparkSession, base: str) -> DataFrame:
    """The files of a store's bars that cannot be read: path, bytes, reason.

    `read_bars(..., ignore_corrupt=True)` passes them over without a word. Files that no longer
    count are not looked at.
    """
    files = store_files(spark, base)
    if files is None:
        return spark.createDataFrame([], "path string, bytes bigint, reason string")
    return files.where(F.col("reason").isNotNull()).select("path", "bytes", "reason")


def store_stats(spark: SparkSession, base: str, by: tuple[str, ...] = ("year", "month")) -> DataFrame:
    """Files, bytes, rows and the range of times of a store's folders, from the files' footers alone.

    `by` names folder columns; `symbol` is one in a store filed by symbols. No column is read, so this costs a
    small part of `data_range`. A file that cannot be read counts in `unreadable`.
    """
    sums = [
        F.count("*").alias("files"),
        F.sum("bytes").alias("bytes"),
        F.sum("rows").alias("rows"),
        F.min("first").alias("first_timestamp"),
        F.max("last").alias("last_timestamp"),
        F.count("reason").alias("unreadable"),
    ]
    files = store_files(spark, base)
    if files is None:
        files = spark.createDataFrame([], f"{PROBED}, folder string")
    value = lambda name: F.url_decode(
        F.replace(F.regexp_extract("folder", f"(?:^|/){name}=([^/]*)", 1), F.lit("+"), F.lit("%2B"))
    )
    kind = lambda name: "string" if name in ("symbol", "interval") else "int"
    return files.groupBy(*[value(name).cast(kind(name)).alias(name) for name in by]).agg(*sums)
