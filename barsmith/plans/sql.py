"""SQL over the store: views, tables of the catalog, and a table function."""

from __future__ import annotations

from urllib.parse import unquote

from pyspark.sql import SparkSession

from barsmith.schema import BAR_COLUMNS, bar_schema
from barsmith.sources.snapshots import Snapshot, latest, numbered
from barsmith.sources.store import NO_VALUE, Layout, read_bars

# The table property that tells which snapshot a table shows; partitions added by one statement.
SHOWN, AT_ONCE = "barsmith.snapshot", 200


def register_views(spark: SparkSession, stores: dict[str, str], **options) -> list[str]:
    """Temporary views `bars_1d`, `bars_1h` over {interval: folder}; query with `spark.sql`.

    A view has the columns of a bar and those of the store's folders. Filters on year, month,
    day, and bucket or symbol, open only the folders they name; a filter on the timestamp
    alone opens them all. For views of some symbols or of a time, give `symbols`, `since`,
    `until` or `asof` as to `read_bars`: these always prune. A view shows the store as it was when it was
    registered; `sync_table` keeps a table up to date.
    """
    for interval, base in stores.items():
        read_bars(spark, base, interval, folders=True, **options).createOrReplaceTempView(f"bars_{interval}")
    return [f"bars_{interval}" for interval in stores]


def sync_table(
    spark: SparkSession,
    table: str,
    base: str,
    interval: str,
    layout: Layout = Layout(),
    ntz: bool = False,
    statistics: bool = False,
) -> int:
    """Make the catalog's external table `table` show what the store has now; how many partitions changed.

    Call it after each write. The table is created if it is not there. Each partition of the table has
    the place of the store's partition that counts, so queries list only the folders they need, and readers
    that began before go on with the old ones. Only partitions that changed since the last call are
    touched. With `statistics` the rows are counted for the optimizer, from the files' footers.
    """
    base, columns = base.rstrip("/"), layout.columns(interval)
    now = latest(spark, base) or Snapshot()
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in layout.schema(interval, ntz))
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {table} ({fields}) USING parquet PARTITIONED BY ({', '.join(columns)}) LOCATION '{_quoted(base)}'"
    )
    shown = {r["key"]: r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES {table}").collect()}.get(SHOWN)
    there = {r["partition"] for r in spark.sql(f"SHOW PARTITIONS {table}").collect()}
    before = numbered(spark, base, int(shown)) if shown is not None else None
    known = before.partitions if before is not None else {}  # else each place is set anew

    changed = [p for p, generation in now.partitions.items() if p not in there or known.get(p) != generation]
    gone = [p for p in there if p not in now.partitions]
    place = lambda p: f"LOCATION '{_quoted(f'{base}/gen={now.partitions[p]}/{p}')}'"
    new = [p for p in changed if p not in there]
    for at in range(0, len(new), AT_ONCE):
        added = " ".join(f"{_spec(p)} {place(p)}" for p in new[at : at + AT_ONCE])
        spark.sql(f"ALTER TABLE {table} ADD IF NOT EXISTS {added}")
    for partition in changed:
        if partition in there:
            spark.sql(f"ALTER TABLE {table} {_spec(partition)} SET {place(partition)}")
    for at in range(0, len(gone), AT_ONCE):
        spark.sql(f"ALTER TABLE {table} DROP IF EXISTS {', '.join(_spec(p) for p in gone[at : at + AT_ONCE])}")
    spark.sql(f"ALTER TABLE {table} SET TBLPROPERTIES ('{SHOWN}' = '{now.number}')")
    if changed or gone:
        spark.catalog.refreshTable(table)
    if statistics:
        spark.sql(f"ANALYZE TABLE {table} COMPUTE STATISTICS")
    return len(changed) + len(gone)


def _quoted(text: str) -> str:
    return text.replace("\\", "\\\\").replace("'", "\\'")


def _spec(partition: str) -> str:
    """`PARTITION (...)` of a folder such as `year=2020/month=1`."""
    values = []
    for part in partition.split("/"):
        name, value = part.split("=", 1)
        values.append(f"`{name}` = " + ("NULL" if value == NO_VALUE else f"'{_quoted(unquote(value))}'"))
    return f"PARTITION ({', '.join(values)})"


def register_function(
    spark: SparkSession, tables: dict[str, str], layout: Layout = Layout(), ntz: bool = False, name: str = "bars"
) -> None:
    """A temporary SQL table function `bars(of_interval, of_symbols, since, until)` over {interval: table or view}.

    `since` is inclusive, `until` exclusive; NULL, or leaving it out, means all. The function knows the
    folders, so it opens only those of its symbols and time, whatever the query around it.
    """
    stamp = "TIMESTAMP_NTZ" if ntz else "TIMESTAMP"
    kinds = {f.name: f.dataType.simpleString() for f in bar_schema(ntz)}
    arms = []
    for interval, table in tables.items():
        number = "year * 12 + month"
        folder = "year({0}) * 12 + month({0})"
        if interval == "1h":
            number, folder = "year * 10000 + month * 100 + day", "year({0}) * 10000 + month({0}) * 100 + day({0})"
        tests = [
            f"of_interval = '{interval}'",
            f"`interval` = '{interval}'",
            "(of_symbols IS NULL OR array_contains(of_symbols, symbol))",
            f"(since IS NULL OR (`timestamp` >= since AND {number} >= {folder.format('since')}))",
            f"(until IS NULL OR (`timestamp` < until AND {number} <= {folder.format('until')}))",
        ]
        if layout.by == "bucket":
            of = f"transform(of_symbols, s -> CAST(pmod(xxhash64(s), {layout.buckets}) AS INT))"
            tests.append(f"(of_symbols IS NULL OR array_contains({of}, bucket))")
        arms.append(f"SELECT {', '.join(f'`{c}`' for c in BAR_COLUMNS)} FROM {table} WHERE {' AND '.join(tests)}")
    spark.sql(
        f"""CREATE OR REPLACE TEMPORARY FUNCTION {name}(
            of_interval STRING, of_symbols ARRAY<STRING> DEFAULT NULL, since {stamp} DEFAULT NULL, until {stamp} DEFAULT NULL
        ) RETURNS TABLE ({', '.join(f'`{c}` {kinds[c]}' for c in BAR_COLUMNS)})
        RETURN {' UNION ALL '.join(arms)}"""
    )
