"""As-of joins: to each row what was valid at its time."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from barsmith.schema import at
from barsmith.session import sized_side


def asof_join(df: DataFrame, versions: DataFrame, keys=("symbol",), since: str = "since", time: str = "timestamp") -> DataFrame:
    """`df`, and beside each row the columns of the newest version of its key from before or at its time.

    A version holds from its `since` until the next one of its key. For the join it is repeated for
    each month it holds in, as far as `df` has rows, so rows meet only the versions of their own
    month, and a key with most of the rows is spread over its months. Rows without a version get NULLs;
    a version without a key or time is none; of versions of one key and time any one counts.
    """
    keys = list(keys)
    month = lambda moment: F.year(moment) * 12 + F.month(moment)
    first, last = df.agg(F.min(month(F.col(time))), F.max(month(F.col(time)))).first()
    known = versions.where(F.col(since).isNotNull()).dropDuplicates([*keys, since])
    by_key = Window.partitionBy(*keys).orderBy(since)
    known = known.withColumn("_until", F.lead(since).over(by_key))
    low = F.greatest(month(F.col(since)), F.lit(first).cast("int"))
    high = F.least(F.coalesce(month(F.col("_until")), F.lit(last).cast("int")), F.lit(last).cast("int"))
    known = known.where(low <= high).withColumn("_month", F.explode(F.sequence(low, high)))
    more = [c for c in versions.columns if c not in keys]
    known = sized_side(known.select(*keys, "_month", "_until", *more))
    row, version = df.alias("row"), known.alias("version")
    moment = F.col(f"row.{time}")
    held = (moment >= F.col(f"version.{since}")) & (F.col("version._until").isNull() | (moment < F.col("version._until")))
    same = month(moment) == F.col("version._month")
    for key in keys:
        same = same & (F.col(f"row.{key}") == F.col(f"version.{key}"))
    return row.join(version, same & held, "left").select("row.*", *[F.col(f"version.{c}").alias(c) for c in more])


def valid_at(versions: DataFrame, moment, keys=("symbol",), since: str = "since") -> DataFrame:
    """The newest version of each key from before or at one moment."""
    known = versions.where(F.col(since) <= at(versions, moment, since))
    newest = Window.partitionBy(*keys).orderBy(F.desc(since))
    return known.withColumn("_rank", F.row_number().over(newest)).where("_rank = 1").drop("_rank")
