"""The bar store: partitioned Parquet, unique on (interval, symbol, timestamp).

Each interval has a base folder of its own, as hourly bars have one level more.
Two layouts. `bucket` (default) files bars by interval, year, month (and day for
hourly bars) and a hash of the symbol. The number of folders then depends on time
and not on the number of symbols, and files stay large. `symbol` has one folder
tree per symbol; it suits a universe of at most some thousand symbols.

Partitions lie in trees `gen=...`, one of each write. What counts is in the newest snapshot
(`sources/snapshots.py`): readers see old or new bars, never none, and one writer at a time changes
the store. Read a store with `read_bars`, the SQL views or the catalog table; a plain Parquet read would
find replaced bars, too.
"""

from __future__ import annotations

import datetime
import re
from dataclasses import dataclass
from urllib.parse import unquote

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from barsmith.operators.bars import merge_bars
from barsmith.operators.normalize import accepted, with_partitions
from barsmith.operators.select import latest_n
from barsmith.schema import BAR_COLUMNS, at, bar_schema, months_back
from barsmith.session import scratch_table, setting, sized_side
from barsmith.sources.paths import delete, folders, names, touch
from barsmith.sources.snapshots import Snapshot, clean, commit, latest, lease, new_generation

# Touched partitions are pruned by literal values up to this many.
LITERALS = 1000
# Fixed value: Spark's folder name for a missing value.
NO_VALUE = "__HIVE_DEFAULT_PARTITION__"
# Bars a symbol that trades on weekdays has in a month, at least.
BARS_PER_MONTH = {"1d": 18, "1h": 110}


@dataclass(frozen=True)
class Layout:
    """How bars are filed. `extra` names further columns (double) that are kept with each bar."""

    by: str = "bucket"
    buckets: int = 16
    extra: tuple[str, ...] = ()

    @property
    def mark(self) -> str:
        """The name of the file in a store's folder that records its layout."""
        return f"_layout-{self.by}-{self.buckets if self.by == 'bucket' else 0}"

    def columns(self, interval: str) -> list[str]:
        time = ["year", "month", "day"] if interval == "1h" else ["year", "month"]
        if self.by == "symbol":
            return ["interval", "symbol", *time]
        return ["interval", *time, "bucket"]

    def bucket(self, symbol: Column) -> Column:
        return F.pmod(F.xxhash64(symbol), F.lit(self.buckets)).cast("int")

    def place(self, df: DataFrame, interval: str) -> DataFrame:
        """Add the partition columns."""
        df = with_partitions(df, interval)
        return df if self.by == "symbol" else df.withColumn("bucket", self.bucket(F.col("symbol")))

    def schema(self, interval: str, ntz: bool) -> T.StructType:
        """Full schema, so partition values are never guessed from folder names."""
        schema = bar_schema(ntz)
        for column in self.extra:
            schema = schema.add(column, T.DoubleType())
        for column in self.columns(interval):
            if column not in schema.names:
                schema = schema.add(column, T.IntegerType())
        return schema


def check_layout(spark, base: str, layout: Layout) -> bool:
    """Whether the store has recorded this layout; an error if it has another one.

    With another number of buckets reads would miss bars and updates double them.
    """
    marks = names(spark, f"{base.rstrip('/')}/_layout-*")
    if marks and marks != [layout.mark]:
        raise ValueError(f"the store at {base} has {marks[0]}, not {layout.mark}")
    return bool(marks)


def _scan(
    spark, base: str, interval: str, layout: Layout, ntz: bool, ignore_corrupt: bool, wanted=lambda partition: True
) -> DataFrame:
    """What the newest snapshot has, of the `wanted` partition folders; a folder without snapshots as it is."""
    check_layout(spark, base, layout)
    base = base.rstrip("/")
    schema = layout.schema(interval, ntz)
    snapshot = latest(spark, base)
    paths, left_out = ([base], []) if snapshot is None else snapshot.paths(base, wanted, LITERALS)
    reader = spark.read.schema(schema).options(
        basePath=base, ignoreCorruptFiles=ignore_corrupt, ignoreMissingFiles=ignore_corrupt
    )
    try:
        df = reader.parquet(*paths) if paths else spark.createDataFrame([], schema)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        df = spark.createDataFrame([], schema)
    if left_out and paths:
        df = df.where(~_folder(layout.columns(interval)).isin([_folder_values(folder) for folder in left_out]))
    return df.where(F.col("interval") == interval)


def _folder(columns: list[str]) -> Column:
    """The values of a row's folders as one text; a filter on it opens only the others."""
    return F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit(NO_VALUE)) for c in ("gen", *columns)])


def _folder_values(folder: str) -> str:
    return "|".join(unquote(part.split("=", 1)[1]) for part in folder.split("/"))


def _month(moment) -> int | None:
    """Year times 12 plus month of a moment given as text or date; None if only Spark can tell."""
    if isinstance(moment, str) and (found := re.match(r"(\d{4})-(\d{2})", moment)):
        return int(found[1]) * 12 + int(found[2])
    return moment.year * 12 + moment.month if isinstance(moment, datetime.date) else None


def _between(since, *untils):
    """Which partition folders may hold bars of a time; a month more on each side, for time zones.

    Spark prunes folders by itself once it has listed them; these are not even listed.
    """
    low = _month(since)
    highs = [m for m in map(_month, untils) if m is not None]

    def wanted(partition: str) -> bool:
        parts = dict(p.split("=", 1) for p in partition.split("/"))
        if not (parts["year"].isdigit() and parts["month"].isdigit()):
            return True
        month = int(parts["year"]) * 12 + int(parts["month"])
        return (low is None or month >= low - 1) and all(month <= high + 1 for high in highs)

    return wanted


def _month_number(moment: Column) -> Column:
    return F.year(moment) * 12 + F.month(moment)


def read_bars(
    spark: SparkSession,
    base: str,
    interval: str,
    symbols: list[str] | None = None,
    since=None,
    until=None,
    layout: Layout = Layout(),
    ntz: bool = False,
    ignore_corrupt: bool = False,
    asof=None,
    folders: bool = False,
) -> DataFrame:
    """Canonical bars of one interval; an empty frame if there is no store.

    With `folders` the partition columns (year, month and so on) come too. `symbols`, `since` (inclusive), `until` (exclusive) and `asof` (inclusive) prune
    partitions, hourly ones by day.
    """
    df = _scan(spark, base, interval, layout, ntz, ignore_corrupt, _between(since, until, asof))
    if interval == "1h":
        number = F.col("year") * 10000 + F.col("month") * 100 + F.col("day")
        folder = lambda m: F.year(m) * 10000 + F.month(m) * 100 + F.dayofmonth(m)
    else:
        number, folder = F.col("year") * 12 + F.col("month"), _month_number
    if symbols is not None:
        df = df.where(F.col("symbol").isin(symbols))
        if layout.by == "bucket":
            df = df.where(F.col("bucket").isin([layout.bucket(F.lit(s)) for s in symbols]))
    if since is not None:
        moment = at(df, since)
        df = df.where((F.col("timestamp") >= moment) & (number >= folder(moment)))
    if until is not None:
        moment = at(df, until)
        df = df.where((F.col("timestamp") < moment) & (number <= folder(moment)))
    if asof is not None:
        moment = at(df, asof)
        df = df.where((F.col("timestamp") <= moment) & (number <= folder(moment)))
    more = [c for c in layout.columns(interval) if c not in BAR_COLUMNS] if folders else []
    return df.select(*BAR_COLUMNS, *layout.extra, *more)


def recent_bars(spark, base: str, interval: str, asof, months: int, **options) -> DataFrame:
    """`read_bars` of the last calendar months up to `asof`; other folders stay closed."""
    return read_bars(spark, base, interval, since=months_back(asof, months), asof=asof, **options)


def read_latest(spark, base: str, interval: str, n: int = 120, *, asof, **options) -> DataFrame:
    """Each symbol's n newest bars up to `asof`, reading old partitions only where needed.

    Most symbols have n bars in the months before `asof`. Of the older partitions
    only the symbol column is read, to find symbols that do not; their older bars
    are read then.
    """
    start = months_back(asof, n // BARS_PER_MONTH[interval] + 1)
    newest = scratch_table(latest_n(read_bars(spark, base, interval, since=start, asof=asof, **options), n), "newest")
    older = read_bars(spark, base, interval, until=start, **options)
    full = newest.groupBy("symbol").count().where(F.col("count") == n).select("symbol")
    short = sized_side(older.select("symbol").distinct().join(sized_side(full), "symbol", "left_anti"))
    if short.isEmpty():
        return newest
    older = latest_n(older.join(short, "symbol", "left_semi"), n)
    return latest_n(newest.unionByName(older.select(*newest.columns)), n)


def write_bars(
    df: DataFrame,
    base: str,
    interval: str,
    layout: Layout = Layout(),
    replace: str = "dynamic",
    wait: float | None = None,
) -> None:
    """Write bars into their partitions, replacing only those the frame touches.

    `replace="static"` empties the whole store in the same step. Another writer is waited for,
    up to `wait` seconds.
    """
    base = base.rstrip("/")
    with lease(df.sparkSession, base, wait):
        _write(df, base, interval, layout, _opened(df.sparkSession, base, layout), replace == "static")


def _opened(spark, base: str, layout: Layout) -> Snapshot:
    """The snapshot a write starts from; what is due is deleted."""
    check_layout(spark, base, layout)
    before = latest(spark, base)
    if before is None and folders(spark, f"{base}/interval=*"):
        raise ValueError(f"{base} has bars but no snapshots; copy it with read_bars and write_bars")
    return clean(spark, base, before or Snapshot())


def _write(
    df: DataFrame, base: str, interval: str, layout: Layout, before: Snapshot, whole=False, batch_id=None, emptied=()
) -> None:
    """Write a generation of the partitions that `df` touches, and make it count.

    Those of `emptied` that get no rows are gone; with `whole` all others are.

    Rebalancing sends a partition's rows to one task, and adaptive execution splits
    a partition that is too large into several, so a hot one gets several files.
    Merging small tasks would save no file here, only leave fewer of them to write
    all the folders, so it is off.
    """
    spark = df.sparkSession
    columns = layout.columns(interval)
    order = [*columns, *[c for c in ("symbol", "timestamp") if c not in columns]]
    placed = layout.place(df.select(*BAR_COLUMNS, *layout.extra), interval)
    rows = placed.hint("rebalance", *columns).sortWithinPartitions(*order)
    generation = new_generation(before)
    tree = f"{base}/gen={generation}"
    # Times as whole numbers: files then know their range, which filters on the time and `store_stats` use.
    numbers = setting(spark, "spark.sql.parquet.outputTimestampType", "TIMESTAMP_MICROS")
    with setting(spark, "spark.sql.adaptive.coalescePartitions.enabled", "false"), numbers:
        rows.write.option("compression", "snappy").partitionBy(*columns).parquet(tree)
    written = folders(spark, "/".join([tree, *[f"{c}=*" for c in columns]]))
    changed = {"/".join(folder.split("/")[-len(columns) :]): generation for folder in written}
    gone = set(before.partitions if whole else emptied) - set(changed)
    if not check_layout(spark, base, layout):
        touch(spark, f"{base}/{layout.mark}")
    if changed or gone or batch_id:
        commit(spark, base, before.after(changed, gone, batch_id))


def tree(spark, base: str) -> str | None:
    """The folder of the newest generation that counts."""
    snapshot = latest(spark, base.rstrip("/"))
    return f"{base.rstrip('/')}/gen={max(snapshot.partitions.values())}" if snapshot and snapshot.partitions else None


def plan_write(df: DataFrame) -> DataFrame:
    """What a write would do: rows per symbol. Writes nothing."""
    return df.groupBy("symbol").agg(F.count("*").alias("rows"))


def write_summary(spark, base: str, interval: str, layout: Layout = Layout(), ntz: bool = False) -> DataFrame:
    """Rows and files per symbol in the store."""
    df = _scan(spark, base, interval, layout, ntz, False)
    return df.groupBy("symbol").agg(
        F.count("*").alias("rows"), F.count_distinct("_metadata.file_path").alias("files")
    )


def touched_partitions(batch: DataFrame, interval: str, layout: Layout = Layout()) -> DataFrame:
    """Partitions a batch falls into."""
    return layout.place(batch, interval).select(*layout.columns(interval)).distinct()


def read_touched(
    spark, base: str, batch: DataFrame, interval: str, layout: Layout = Layout(), ntz: bool = False
) -> DataFrame:
    """All stored bars of the partitions a batch falls into, and no other files.

    A batch usually touches few dates, so those (and the symbols or buckets, if
    few) become literal filters, which prune for certain. The semi-join then
    keeps exactly the touched combinations; where they are too many for literals,
    Spark prunes by the joined side at run time.
    """
    columns = layout.columns(interval)
    touched = sized_side(touched_partitions(batch, interval, layout))
    df = _scan(spark, base, interval, layout, ntz, False)
    who = "symbol" if layout.by == "symbol" else "bucket"
    for names in ([c for c in columns if c not in ("interval", who)], [who]):
        values = touched.select(*names).distinct().limit(LITERALS + 1).collect()
        if 0 < len(values) <= LITERALS:
            df = df.where(_any_of(names, values))
    # Spark prunes at run time by a side that has a filter, whatever it lets through.
    return df.join(touched.where(F.col("year") > -1), columns, "left_semi").select(*BAR_COLUMNS, *layout.extra)


def _any_of(names: list[str], rows: list) -> Column:
    if len(names) == 1:
        return F.col(names[0]).isin([row[0] for row in rows])
    # Dates as one number each: year, then month, then day.
    number, values = F.lit(0), [0] * len(rows)
    for i, name in enumerate(names):
        number = number * 100 + F.col(name)
        values = [v * 100 + row[i] for v, row in zip(values, rows)]
    return number.isin(values)


def upsert_bars(
    spark,
    base: str,
    batch: DataFrame,
    interval: str,
    layout: Layout = Layout(),
    ntz: bool = False,
    batch_id: str | None = None,
    wait: float | None = None,
    merge=merge_bars,
) -> None:
    """Merge a batch into the store: new bars are added, known ones replaced.

    The merged partitions are written beside the old ones, and one file makes them count, all in
    the same moment. Who reads meanwhile sees the store as it was; if the job dies it stays so.
    A batch whose `batch_id` the store has taken is not applied again; without an id, applying it
    twice leaves the store as it was after the first time. Bars that `accepted` refuses are left out.

    Another `merge(existing, batch)` may give what the touched partitions hold from now on, in a
    store filed by buckets also nothing.
    """
    base = base.rstrip("/")
    with lease(spark, base, wait):
        before = _opened(spark, base, layout)
        if batch_id is not None and batch_id in before.batches:
            return
        batch = accepted(batch)
        existing = read_touched(spark, base, batch, interval, layout, ntz)
        emptied = []
        if merge is not merge_bars and layout.by == "bucket":
            touched = touched_partitions(batch, interval, layout).collect()
            emptied = ["/".join(f"{c}={row[c]}" for c in row.asDict()) for row in touched]
        _write(merge(existing, batch), base, interval, layout, before, batch_id=batch_id, emptied=emptied)


def expire_bars(df: DataFrame, asof, days: int = 365) -> DataFrame:
    """Bars of the last `days` before `asof`."""
    return df.where(F.col("timestamp") >= at(df, asof) - F.make_dt_interval(days=F.lit(days)))


def expire_store(
    spark, base: str, interval: str, asof, days: int = 365, layout: Layout = Layout()
) -> list[str]:
    """Delete the month folders that end before the retention limit; no file is read.

    They stop counting first. Other than replaced bars they are not kept for readers that began before.
    """
    base = base.rstrip("/")
    limit = spark.range(1).select(
        _month_number(F.lit(asof).cast("timestamp_ntz") - F.make_dt_interval(days=F.lit(days)))
    ).first()[0]
    with lease(spark, base):
        before = _opened(spark, base, layout)
        gone = []
        for partition in before.partitions:
            parts = dict(p.split("=", 1) for p in partition.split("/"))
            if not (parts["year"].isdigit() and parts["month"].isdigit()):
                continue  # bars without a time, of a store written by others
            if int(parts["year"]) * 12 + int(parts["month"]) < limit:
                gone.append(partition)
        if gone:
            commit(spark, base, before.after({}, gone))
    months = {f"{base}/gen={before.partitions[p]}/{re.match('.*/month=[^/]*', p)[0]}" for p in gone}
    for folder in months:
        delete(spark, folder)
    return sorted(months)
