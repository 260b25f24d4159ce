"""Session settings and tables written on the way."""

from __future__ import annotations

import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from barsmith.sources.paths import delete, make_until_exit

_local_roots: dict[str, str] = {}


def configure(spark: SparkSession) -> SparkSession:
    """Bars are kept in UTC; the session must read and print them so."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


@contextmanager
def setting(spark: SparkSession, key: str, value):
    """A session setting for the jobs inside the block."""
    before = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


def scratch_dir(spark: SparkSession) -> str:
    """Shared folder for intermediate tables of this application.

    The cluster names it in `spark.checkpoint.dir`. Only a local session may go
    without: it gets a temporary folder of its own. The folder goes with the driver.
    """
    app = spark.sparkContext.applicationId
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        if app not in _local_roots:
            _local_roots[app] = tempfile.mkdtemp(prefix="barsmith-")
        root = _local_roots[app]
    folder = f"{root.rstrip('/')}/barsmith-{app}"
    make_until_exit(spark, folder)
    return folder


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path under the scratch folder, never used before."""
    return f"{scratch_dir(spark)}/{name}-{uuid.uuid4().hex}"


def scratch_table(df: DataFrame, name: str = "table") -> DataFrame:
    """Write `df` once and read it back.

    This cuts the lineage at a table which outlives lost executors, and gives
    Catalyst the true size of the result.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    table = spark.read.schema(df.schema).parquet(path)
    table._scratch = path
    return table


def discard(table: DataFrame) -> None:
    """Delete a scratch table before the driver exits; nothing may read it any more."""
    delete(table.sparkSession, table._scratch)


def sized_side(df: DataFrame) -> DataFrame:
    """A join side whose size Spark knows before it plans the join.

    Per-symbol tables (cutoffs, models, universes) are usually tiny, but they grow
    with the number of symbols. Written first, they are broadcast only if their
    files are below `spark.sql.autoBroadcastJoinThreshold`, and then the bars are
    not shuffled at all. Beyond it both sides are shuffled, and adaptive execution
    splits the partitions of hot keys. A scratch table is taken as it is.
    """
    return df if "_scratch" in vars(df) else scratch_table(df, "side")
