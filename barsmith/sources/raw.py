"""Landing files of a provider, as batch frames."""

from __future__ import annotations

import csv
import json

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F

from barsmith.operators.normalize import normalize
from barsmith.schema import raw_schema
from barsmith.session import sized_side


# Text files carry a header, and its names must be the expected ones.
RAW_OPTIONS = {"header": True, "enforceSchema": False}


def read_raw(spark: SparkSession, path: str, fmt: str = "parquet", interval: str = "1d") -> DataFrame:
    """Raw bars with the provider's column names; none if there is no such folder.

    The schema is never inferred. The format `wide` is that of `read_wide`.
    """
    if fmt == "wide":
        return read_wide(spark, path, interval)
    schema = raw_schema(interval)
    try:
        return spark.read.schema(schema).options(**RAW_OPTIONS).format(fmt).load(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def read_wide(spark: SparkSession, path: str, interval: str = "1d") -> DataFrame:
    """Raw bars from text files of many tickers side by side, under two header lines.

    One header line has the fields and the other the tickers, in either order; a third, with the name of the
    time column alone, may follow. All files have the same header. A row is taken apart as an array,
    so the plan does not grow with the number of tickers. A value that is no number is missing,
    and a ticker without any value at a time has no row.
    """
    schema = raw_schema(interval)
    time, *numbers, ticker = schema.names
    try:
        lines = spark.read.text(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)
    heads = [r.value for r in lines.head(2)]
    if len(heads) < 2:
        return spark.createDataFrame([], schema)
    fields, tickers = [next(csv.reader([line])) for line in heads]
    if not set(fields) & set(numbers):
        fields, tickers = tickers, fields
    if not set(fields) & set(numbers):
        raise ValueError(f"no header line of {path} has any of {', '.join(numbers)}")
    places: dict[str, dict[str, int]] = {}
    for at, (field, name) in enumerate(zip(fields, tickers)):
        if at and field in numbers:
            places.setdefault(name, {})[field] = at
    table = json.dumps([{"name": name, "at": [of.get(f, -1) for f in numbers]} for name, of in places.items()])
    layout = F.from_json(F.lit(table), "array<struct<name string, at array<int>>>")
    cells = F.split(F.regexp_replace("value", '"', ""), ",", -1)

    def row(of):
        values = [F.get("_cells", F.get(of["at"], F.lit(i))).try_cast("double").alias(f) for i, f in enumerate(numbers)]
        return F.struct(*values, of["name"].alias(ticker))

    body = lines.where(~F.col("value").isin(heads) & ~F.col("value").rlike("^[^,0-9]*,*$"))
    # a line is taken apart once, not for each of its tickers
    body = body.select(cells.alias("_cells"), layout.alias("_layout"))
    return body.select(F.get("_cells", F.lit(0)).alias(time), F.inline(F.transform("_layout", row))).dropna("all", subset=numbers)


def raw_bars(spark, path: str, fmt: str = "parquet", interval: str = "1d", zone=None, ntz=False) -> DataFrame:
    """`read_raw`, normalised."""
    return normalize(read_raw(spark, path, fmt, interval), interval, zone=zone, ntz=ntz)


def with_fallback(primary: DataFrame, secondary: DataFrame) -> DataFrame:
    """The primary source, plus the secondary for symbols the primary lacks."""
    known = sized_side(primary.select("symbol").distinct())
    return primary.unionByName(secondary.join(known, "symbol", "left_anti"))


def recent_files(spark: SparkSession, path: str, n: int) -> list[str]:
    """The n newest Parquet files below `path`, newest first; nothing is opened."""
    listing = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", "*.parquet")
        .load(path)
        .select("path", "modificationTime")
    )
    newest = listing.orderBy(F.desc("modificationTime"), F.desc("path")).limit(n)
    return [row["path"] for row in newest.collect()]


def read_recent_files(
    spark: SparkSession, path: str, n: int, schema=None, ignore_corrupt: bool = False
) -> DataFrame:
    """Only the n newest files of a Parquet folder, with its partition columns.

    With `ignore_corrupt` files that cannot be read count as empty. A folder without
    files gives an empty frame of the schema, or one without columns.
    """
    files = recent_files(spark, path, n)
    if not files:
        return spark.createDataFrame([], schema or "")
    reader = spark.read.options(basePath=path, ignoreCorruptFiles=ignore_corrupt)
    reader = reader.schema(schema) if schema else reader
    return reader.parquet(*files)
