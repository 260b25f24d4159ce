"""What the corpus operators share: tables, folds, names, shipping of task functions."""

from __future__ import annotations

import sys

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def ship(module: str) -> None:
    """Send a module's task functions with the job: executors may not have the library."""
    cloudpickle.register_pickle_by_value(sys.modules[module])


ship(__name__)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def width(spark: SparkSession) -> int:
    """Partitions of a shuffle."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def fold(doc_id: Column | str, folds: int) -> Column:
    """crc32 of an id as text, modulo `folds`; a null id counts as the empty text."""
    key = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.crc32(F.coalesce(key.cast("string"), F.lit(""))) % folds


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Column names like `names` that the frame does not have yet."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def with_text_column(df: DataFrame, text: str, name: str, kind: str, make) -> DataFrame:
    """Add a column computed from each whole text.

    `make()` is called once in a task and returns a function from a text to a value; a
    null text is passed as the empty one.
    """
    at = df.columns.index(text)
    arrow = {"double": pa.float64(), "bigint": pa.int64(), "string": pa.string()}[kind]

    def run(batches):
        value = make()
        for batch in batches:
            column = pa.array([value(t or "") for t in batch.column(at).to_pylist()], arrow)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, column], names=[*batch.schema.names, name]
            )

    schema = T.StructType([*df.schema.fields, T.StructField(name, T._parse_datatype_string(kind))])
    return df.mapInArrow(run, schema)
