import os
import re
import threading
from concurrent.futures import ThreadPoolExecutor

import pandas as pd
import pytest
from pyspark.sql import functions as F

from barsmith.operators import bars as B
from barsmith.plans.sql import register_function, register_views, sync_table
from barsmith.schema import bar_schema
from barsmith.sources import raw as R, snapshots as S, store as P
from barsmith.sources.paths import create_new, read_text
from barsmith.sources.probe import list_files, probe_files, quarantined, store_stats
from helpers import same, to_spark, walk

LAYOUTS = [P.Layout(by="symbol"), P.Layout(buckets=3)]


@pytest.fixture(params=LAYOUTS, ids=["symbol", "bucket"])
def layout(request):
    return request.param


def read(spark, base, layout, **more):
    return P.read_bars(spark, base, "1d", layout=layout, ntz=True, **more)


def test_round_trip(spark, tmp_path, layout):
    frames = [walk("A", 90, 1), walk("007", 40, 2), walk("C D", 10, 3)]
    base = str(tmp_path / "store")
    P.write_bars(to_spark(spark, *frames), base, "1d", layout)
    same(read(spark, base, layout).toPandas(), pd.concat(frames))
    folder = "interval=1d/symbol=A/year=2020/month=1" if layout.by == "symbol" else "interval=1d/year=2020/month=1"
    assert os.path.isdir(f"{P.tree(spark, base)}/{folder}")


def test_scan_prunes_partitions(spark, tmp_path, layout):
    frames = [walk("A", 400, 1), walk("B", 400, 2)]
    base = str(tmp_path / "store")
    P.write_bars(to_spark(spark, *frames), base, "1d", layout)
    part = read(spark, base, layout, symbols=["A"], since="2020-03-05", until="2020-05-02")
    want = frames[0][(frames[0]["timestamp"] >= "2020-03-05") & (frames[0]["timestamp"] < "2020-05-02")]
    same(part.toPandas(), want)
    plan = part._jdf.queryExecution().executedPlan().toString()
    filters = plan[plan.index("PartitionFilters"): plan.index("PushedFilters")]
    for column in ("interval", "symbol" if layout.by == "symbol" else "bucket", "year", "month"):
        assert column in filters
    assert "GreaterThanOrEqual(timestamp" in plan


def test_read_latest_goes_back_only_where_needed(spark, tmp_path, layout):
    frames = [walk("A", 400, 1), walk("OLD", 30, 2), walk("FEW", 9, 3, start="2021-01-20")]
    base = str(tmp_path / "store")
    P.write_bars(to_spark(spark, *frames), base, "1d", layout)
    for n, asof in ((5, "2021-02-04"), (50, "2021-02-04"), (350, "2021-02-04")):
        got = P.read_latest(spark, base, "1d", n, asof=asof, layout=layout, ntz=True)
        same(got.toPandas(), pd.concat([f.tail(n) for f in frames]))


def test_upsert_replaces_and_adds(spark, tmp_path, layout):
    old, new = walk("A", 100, 1), walk("A", 130, 1)
    new["close"] += 7
    batch = new[new["timestamp"] > "2020-03-25"]
    other = walk("B", 50, 2)
    base = str(tmp_path / "store")
    P.upsert_bars(spark, base, to_spark(spark, old, other), "1d", layout, ntz=True)
    want = pd.concat([old[old["timestamp"] <= "2020-03-25"], batch, other])
    for _ in range(2):
        P.upsert_bars(spark, base, to_spark(spark, batch), "1d", layout, ntz=True)
        same(read(spark, base, layout).toPandas(), want)


def test_upsert_leaves_other_files_alone(spark, tmp_path, layout):
    base = str(tmp_path / "store")
    old = walk("A", 200, 1)
    P.write_bars(to_spark(spark, old), base, "1d", layout)
    opened = lambda: {r[0] for r in read(spark, base, layout).select(F.input_file_name()).distinct().collect()}
    files = opened()
    P.upsert_bars(spark, base, to_spark(spark, old.tail(3)), "1d", layout, ntz=True)
    assert len(files & opened()) == len(files) - 1


def test_upsert_survives_a_crash_at_every_step(spark, tmp_path, layout, monkeypatch):
    """A job that dies leaves the store as it was, and a later upsert makes it whole."""
    old = walk("A", 60, 1)
    batch = old[old["timestamp"] >= "2020-01-28"].assign(close=1.0)
    later = walk("B", 3, 2)

    def dies(*args, **more):
        raise OSError("lost")

    for step in ("read_touched", "setting", "folders", "commit"):
        base = str(tmp_path / step)
        P.write_bars(to_spark(spark, old), base, "1d", layout)
        with monkeypatch.context() as patch:
            patch.setattr(P, step, dies)
            with pytest.raises(OSError):
                P.upsert_bars(spark, base, to_spark(spark, batch), "1d", layout, ntz=True)
        same(read(spark, base, layout).toPandas(), old)
        for more in (batch, later):
            P.upsert_bars(spark, base, to_spark(spark, more), "1d", layout, ntz=True)
        same(read(spark, base, layout).toPandas(), pd.concat([old[old["timestamp"] < "2020-01-28"], batch, later]))
        assert not os.path.exists(f"{base}/_lease")


def test_trees_of_dead_writers_and_replaced_bars_go(spark, tmp_path, layout, monkeypatch):
    base, old = str(tmp_path / "store"), walk("A", 40, 1)
    P.write_bars(to_spark(spark, old), base, "1d", layout)
    dead = f"{base}/gen={S.new_generation(S.latest(spark, base))}"
    layout.place(to_spark(spark, old.assign(close=1.0)), "1d").write.partitionBy(*layout.columns("1d")).parquet(dead)
    same(read(spark, base, layout).toPandas(), old)
    for n in (1, 2):
        P.upsert_bars(spark, base, to_spark(spark, walk("B", 3, n)), "1d", layout, ntz=True)
    assert not os.path.exists(dead)
    before = S.latest(spark, base)
    assert len(before.retired) == 1 and os.path.isdir(f"{base}/{before.retired[0][0]}")
    monkeypatch.setattr(S, "KEEP", -1)
    P.upsert_bars(spark, base, to_spark(spark, walk("B", 3, 2)), "1d", layout, ntz=True)
    assert not os.path.exists(f"{base}/{before.retired[0][0]}")
    same(read(spark, base, layout).toPandas(), pd.concat([old, walk("B", 3, 2)]))


def test_readers_see_old_or_new_bars_during_upserts(spark, tmp_path, layout):
    """Partitions and the whole store change in one moment, for readers that began before, too."""
    base, old = str(tmp_path / "store"), walk("A", 60, 1)
    P.write_bars(to_spark(spark, old.assign(close=0.0)), base, "1d", layout)
    first, done, seen, failed = read(spark, base, layout), threading.Event(), set(), []

    def reader():
        while not done.is_set():
            try:
                got = read(spark, base, layout).groupBy().agg(F.count("*"), F.min("close"), F.max("close")).first()
                seen.add(tuple(got))
            except Exception as error:
                failed.append(error)

    thread = threading.Thread(target=reader)
    thread.start()
    for n in range(1, 6):
        P.upsert_bars(spark, base, to_spark(spark, old.assign(close=float(n))), "1d", layout, ntz=True)
    done.set()
    thread.join()
    assert not failed
    assert seen <= {(60, float(n), float(n)) for n in range(6)} and len(seen) > 1
    assert first.agg(F.sum("close")).first()[0] == 0.0


def test_a_second_writer_waits_or_gives_up(spark, tmp_path, layout):
    base, bars = str(tmp_path / "store"), to_spark(spark, walk("A", 9, 1))
    more = to_spark(spark, walk("B", 9, 2))
    P.write_bars(bars, base, "1d", layout)
    with S.lease(spark, base):
        with pytest.raises(S.StoreBusy, match="written by"):
            P.upsert_bars(spark, base, more, "1d", layout, ntz=True, wait=0.3)
        second = threading.Thread(target=lambda: P.upsert_bars(spark, base, more, "1d", layout, ntz=True))
        second.start()
        second.join(1.0)
        assert second.is_alive() and read(spark, base, layout).count() == 9
    second.join()
    assert read(spark, base, layout).count() == 18


def test_a_lease_left_behind_is_taken_over_and_its_owner_fails(spark, tmp_path, layout, monkeypatch):
    base, bars = str(tmp_path / "store"), to_spark(spark, walk("A", 9, 1))
    P.write_bars(bars, base, "1d", layout)
    before = S.latest(spark, base)
    with S.lease(spark, base):
        monkeypatch.setattr(S, "LEASE", -1)
        P.upsert_bars(spark, base, to_spark(spark, walk("B", 9, 2)), "1d", layout, ntz=True, wait=0)
        with pytest.raises(S.StoreBusy, match="nothing was written"):
            S.commit(spark, base, before.after({}))
    assert read(spark, base, layout).count() == 18


def test_of_many_that_create_a_file_one_succeeds(spark, tmp_path):
    with ThreadPoolExecutor(8) as pool:
        made = list(pool.map(lambda n: create_new(spark, str(tmp_path / "x" / "file"), str(n)), range(16)))
    assert sum(made) == 1 and read_text(spark, str(tmp_path / "x" / "file")) == str(made.index(True))
    assert os.listdir(tmp_path / "x") == ["file"]


def test_a_batch_with_an_id_counts_once(spark, tmp_path, layout):
    base = str(tmp_path / "store")
    for close in (1.0, 2.0):
        P.upsert_bars(spark, base, to_spark(spark, walk("A", 9, 1).assign(close=close)), "1d", layout, ntz=True, batch_id="b-1")
    same(read(spark, base, layout).toPandas(), walk("A", 9, 1).assign(close=1.0))


def test_writing_anew_replaces_the_whole_store(spark, tmp_path, layout):
    base = str(tmp_path / "store")
    P.write_bars(to_spark(spark, walk("A", 90, 1)), base, "1d", layout)
    P.write_bars(to_spark(spark, walk("B", 9, 1)), base, "1d", layout, "static")
    same(read(spark, base, layout).toPandas(), walk("B", 9, 1))


def test_another_layout_is_refused(spark, tmp_path):
    base, bars = str(tmp_path / "store"), to_spark(spark, walk("A", 40, 1))
    P.upsert_bars(spark, base, bars, "1d", P.Layout(buckets=4), ntz=True)
    assert read(spark, base, P.Layout(buckets=4)).count() == 40
    for other in (P.Layout(), P.Layout(by="symbol")):
        for use in (lambda: read(spark, base, other), lambda: P.upsert_bars(spark, base, bars, "1d", other, ntz=True),
                    lambda: P.write_bars(bars, base, "1d", other)):
            with pytest.raises(ValueError, match="layout"):
                use()


def test_bad_bars_never_replace_good_ones(spark, tmp_path, layout):
    base, old = str(tmp_path / "store"), walk("A", 40, 1)
    P.write_bars(to_spark(spark, old), base, "1d", layout)
    bad = to_spark(spark, old.tail(2).assign(close=float("nan")), old.head(1).assign(timestamp=pd.NaT))
    P.upsert_bars(spark, base, bad, "1d", layout, ntz=True)
    same(read(spark, base, layout).toPandas(), old)


def test_hourly_scans_prune_days(spark, tmp_path):
    base, layout = str(tmp_path / "store"), P.Layout(buckets=2)
    frame = walk("A", 300, 1).assign(interval="1h")
    frame["timestamp"] = pd.date_range("2020-01-01", periods=300, freq="h")
    P.write_bars(to_spark(spark, frame), base, "1h", layout)
    got = P.read_bars(spark, base, "1h", since="2020-01-05 06:00:00", asof="2020-01-06 02:00:00", layout=layout, ntz=True)
    same(got.toPandas(), frame[(frame["timestamp"] >= "2020-01-05 06:00") & (frame["timestamp"] <= "2020-01-06 02:00")])
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "day" in plan[plan.index("PartitionFilters"): plan.index("PushedFilters")]


def test_missing_store_is_empty(spark, tmp_path):
    got = P.read_bars(spark, str(tmp_path / "none"), "1d")
    assert got.count() == 0 and "timestamp" in got.columns


def test_corrupt_files_can_be_skipped(spark, tmp_path, layout):
    base = str(tmp_path / "store")
    frame = walk("A", 60, 1)
    P.write_bars(to_spark(spark, frame), base, "1d", layout)
    folder = os.path.dirname(read(spark, base, layout).inputFiles()[0].removeprefix("file://"))
    with open(f"{folder}/bad.parquet", "wb") as f:
        f.write(b"not parquet")
    with pytest.raises(Exception):
        read(spark, base, layout).collect()
    same(read(spark, base, layout, ignore_corrupt=True).toPandas(), frame)


def test_expire_store_drops_whole_months(spark, tmp_path, layout):
    base = str(tmp_path / "store")
    frame = walk("A", 400, 1)
    P.write_bars(to_spark(spark, frame), base, "1d", layout)
    gone = P.expire_store(spark, base, "1d", "2021-02-01", 100, layout)
    assert gone
    same(read(spark, base, layout).toPandas(), frame[frame["timestamp"] >= "2020-10-01"])


def test_recent_files(spark, tmp_path):
    path = str(tmp_path / "files")
    for i in range(4):
        to_spark(spark, walk(f"S{i}", 5)).coalesce(1).write.mode("append").parquet(path)
        newest = max((os.path.join(path, f) for f in os.listdir(path) if f.endswith(".parquet")), key=os.path.getmtime)
        os.utime(newest, (1_700_000_000 + i, 1_700_000_000 + i))
        os.rename(newest, os.path.join(path, f"file{i}.parquet"))
    got = R.read_recent_files(spark, path, 2)
    assert {r["symbol"] for r in got.select("symbol").distinct().collect()} == {"S2", "S3"}


def test_folders_without_files_and_broken_files(spark, tmp_path):
    empty, base = tmp_path / "empty", str(tmp_path / "files")
    empty.mkdir()
    schema = bar_schema(ntz=True)
    assert R.read_recent_files(spark, str(empty), 3, schema).count() == 0
    assert R.read_recent_files(spark, str(empty), 3).count() == 0
    assert R.read_raw(spark, str(tmp_path / "none"), "csv").count() == 0
    to_spark(spark, walk("A", 30, 1)).coalesce(1).write.parquet(base)
    with open(f"{base}/broken.parquet", "w") as f:
        f.write("no bars")
    assert R.read_recent_files(spark, base, 2, schema, ignore_corrupt=True).count() == 30


def test_dedupe_prefers_the_newest_version(spark):
    rows = [("1d", "A", 1, 0, 5.0), ("1d", "A", 1, 2, 1.0), ("1d", "A", 1, 1, 9.0), ("1d", "A", 2, 0, 3.0),
            ("1d", "A", 2, 0, 4.0)]
    df = spark.createDataFrame(rows, "interval string, symbol string, timestamp int, ingest_seq int, close double")
    got = {r["timestamp"]: r["close"] for r in B.dedupe_keep_last(df).collect()}
    assert got == {1: 1.0, 2: 4.0}
    plan = B.dedupe_keep_last(df)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_merge_stats(spark):
    old, new = walk("A", 10, 1), walk("A", 13, 1).tail(5)
    got = B.merge_stats(to_spark(spark, old), to_spark(spark, new, walk("B", 2, 2))).drop("interval").toPandas().set_index("symbol")
    assert got.loc["A"].tolist() == [10, 5, 2, 3, 13]
    assert got.loc["B"].tolist() == [0, 2, 0, 2, 2]


def test_sql_views(spark, tmp_path, layout):
    base = str(tmp_path / "store")
    P.write_bars(to_spark(spark, walk("A", 30, 1)), base, "1d", layout)
    stores = {"1d": base, "1h": str(tmp_path / "none")}
    assert register_views(spark, stores, layout=layout, ntz=True) == ["bars_1d", "bars_1h"]
    assert spark.sql("SELECT count(*) FROM bars_1d").first()[0] == 30
    assert spark.sql("SELECT count(*) FROM bars_1h").first()[0] == 0


def test_sql_filters_prune_folders(spark, tmp_path, layout):
    base = str(tmp_path / "store")
    P.write_bars(to_spark(spark, walk("A", 90, 1), walk("B", 90, 2)), base, "1d", layout)
    register_views(spark, {"1d": base}, layout=layout, ntz=True)
    part = spark.sql("SELECT * FROM bars_1d WHERE year = 2020 AND month = 2")
    filters = part._jdf.queryExecution().executedPlan().toString()
    filters = filters[filters.index("PartitionFilters"): filters.index("PushedFilters")]
    assert "year" in filters and "month" in filters
    assert part.count() == 58


def test_many_touched_partitions_are_pruned_too(spark, tmp_path, layout, monkeypatch):
    base, old = str(tmp_path / "store"), walk("A", 200, 1)
    P.write_bars(to_spark(spark, old), base, "1d", layout)
    monkeypatch.setattr(P, "LITERALS", 0)
    touched = P.read_touched(spark, base, to_spark(spark, old.tail(3)), "1d", layout, ntz=True)
    assert "dynamicpruning" in touched._jdf.queryExecution().executedPlan().toString().lower()
    month = old["timestamp"].dt.month == old["timestamp"].iloc[-1].month
    assert touched.count() == month.sum()


def location(df) -> int:
    """How many folders a query lists."""
    df.collect()
    found = re.findall(r"InMemoryFileIndex\((\d+) paths?\)", df._jdf.queryExecution().executedPlan().toString())
    return sum(map(int, found))


def test_catalog_table_follows_the_store(spark, tmp_path, layout):
    base, name = str(tmp_path / "st'ore"), f"prices_{layout.by}"
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    frames = [walk("A", 90, 1), walk("B'%=1", 40, 2)]
    P.write_bars(to_spark(spark, *frames), base, "1d", layout)
    assert sync_table(spark, name, base, "1d", layout, ntz=True) > 0
    shown = lambda: spark.table(name).select(*frames[0].columns).toPandas()
    same(shown(), pd.concat(frames))
    assert sync_table(spark, name, base, "1d", layout, ntz=True) == 0
    new = walk("A", 2, 3, start="2020-02-09").assign(close=9.0)
    later = walk("C", 5, 4, start="2021-05-05")
    for batch in (new, later):
        P.upsert_bars(spark, base, to_spark(spark, batch), "1d", layout, ntz=True)
    assert sync_table(spark, name, base, "1d", layout, ntz=True, statistics=True) == 2
    stored = read(spark, base, layout).toPandas()
    same(shown(), stored)
    assert len(stored) == 135 and (stored["close"] == 9.0).sum() == 2
    assert "135 rows" in {r[0]: r[1] for r in spark.sql(f"DESCRIBE EXTENDED {name}").collect()}["Statistics"]
    part = spark.sql(f"SELECT * FROM {name} WHERE year = 2021")
    assert part.count() == 5 and location(part) == 1
    P.expire_store(spark, base, "1d", "2021-06-01", 60, layout)
    assert sync_table(spark, name, base, "1d", layout, ntz=True) > 0
    same(shown(), later)
    spark.sql(f"DROP TABLE {name}")


def test_table_function_opens_only_its_folders(spark, tmp_path, layout):
    base, hours = str(tmp_path / "store"), str(tmp_path / "hours")
    P.write_bars(to_spark(spark, walk("A", 400, 1), walk("B", 400, 2)), base, "1d", layout)
    hourly = walk("A", 100, 1).assign(interval="1h")
    hourly["timestamp"] = pd.date_range("2020-01-01", periods=100, freq="h")
    P.write_bars(to_spark(spark, hourly), hours, "1h", layout)
    tables = {}
    for interval, folder in (("1d", base), ("1h", hours)):
        tables[interval] = f"bars_{interval}_{layout.by}"
        spark.sql(f"DROP TABLE IF EXISTS {tables[interval]}")
        sync_table(spark, tables[interval], folder, interval, layout, ntz=True)
    register_function(spark, tables, layout, ntz=True)
    part = spark.sql("SELECT * FROM bars('1d', array('A'), TIMESTAMP_NTZ '2020-03-05', TIMESTAMP_NTZ '2020-05-02')")
    want = walk("A", 400, 1)
    same(part.toPandas(), want[(want["timestamp"] >= "2020-03-05") & (want["timestamp"] < "2020-05-02")])
    assert location(part) == 3  # March, April and May of one symbol or bucket
    day = spark.sql("SELECT * FROM bars('1h', since => TIMESTAMP_NTZ '2020-01-03 05:00:00', until => TIMESTAMP_NTZ '2020-01-04')")
    assert day.count() == 19 and location(day) == 2
    assert spark.sql("SELECT * FROM bars('1d')").count() == 800
    assert spark.sql("SELECT * FROM bars('1d', array('none'))").count() == 0
    joined = spark.sql("SELECT count(*) FROM bars('1d', array('A')) AS a JOIN bars('1d', array('B')) AS b USING (timestamp)")
    assert joined.first()[0] == 400
    for table in tables.values():
        spark.sql(f"DROP TABLE {table}")


def test_unreadable_files_are_named(spark, tmp_path, layout):
    base = str(tmp_path / "store")
    P.write_bars(to_spark(spark, walk("A", 60, 1), walk("B", 60, 2)), base, "1d", layout)
    assert quarantined(spark, base).count() == 0 == quarantined(spark, str(tmp_path / "none")).count()
    files = [f.removeprefix("file://") for f in sorted(read(spark, base, layout).inputFiles())]
    with open(files[0], "r+b") as f:  # cut in the middle
        f.truncate(os.path.getsize(files[0]) // 2)
    with open(f"{os.path.dirname(files[1])}/notes.txt", "w") as f:
        f.write("no bars")
    with open(files[1], "r+b") as f:  # the footer's length is wrong
        f.seek(-8, os.SEEK_END)
        f.write(b"\xff\xff\xff\x7f")
    found = {r.path.removeprefix("file:").replace("//", "/"): r.reason for r in quarantined(spark, base).collect()}
    assert set(found) == {files[0], files[1], f"{os.path.dirname(files[1])}/notes.txt"}
    assert found[files[0]] == "not a Parquet file" and all(found.values())
    rest = [f for f in files if f not in found]
    counted = probe_files(list_files(spark, *rest)).collect()
    assert sum(r.rows for r in counted) == read(spark, base, layout, ignore_corrupt=True).count()
    P.upsert_bars(spark, base, to_spark(spark, walk("C", 3, 1, start="2021-01-01")), "1d", layout, ntz=True)
    assert quarantined(spark, base).count() == 3
    stats = store_stats(spark, base, ("interval",)).first()
    assert stats.interval == "1d" and stats.unreadable == 3


def test_stats_come_from_footers(spark, tmp_path, layout):
    base = str(tmp_path / "store")
    frames = [walk("A", 90, 1), walk("B +%/x", 50, 2)]
    assert store_stats(spark, base).count() == 0
    P.write_bars(to_spark(spark, *frames).withColumn("timestamp", F.col("timestamp").cast("timestamp")), base, "1d", layout)
    P.upsert_bars(spark, base, to_spark(spark, walk("A", 3, 3)).withColumn("timestamp", F.col("timestamp").cast("timestamp")), "1d", layout)
    by = ("symbol",) if layout.by == "symbol" else ("year",)
    got = sorted((r[0], r.rows, str(r.first_timestamp), str(r.last_timestamp)) for r in store_stats(spark, base, by).collect())
    if layout.by == "bucket":
        assert got == [(2020, 140, "2020-01-02 00:00:00", "2020-03-31 00:00:00")]
    else:
        want = [(f["symbol"].iloc[0], len(f), str(f["timestamp"].min()), str(f["timestamp"].max())) for f in frames]
        assert got == sorted(want)


def test_wide_text_files(spark, tmp_path):
    path = tmp_path / "wide"
    path.mkdir()
    heads = ["Price,Close,Close,Open,Open,Volume,Dividends", "Ticker,AA,B B,AA,B B,AA,AA"]
    (path / "a.csv").write_text("\n".join([*heads, "Date,,,,,,", "2020-01-02,1.5,2,1,,7,0", "2020-01-03,,,,,,", '2020-01-06,"3",x,2,nan,,0']))
    (path / "b.csv").write_text("\n".join([*heads, "2020-01-07,,9,,8,,0", ""]))
    got = sorted(((r.Date, r.Ticker, r.Open, r.Close, r.Volume, r.High) for r in R.read_raw(spark, str(path), "wide").collect()), key=str)
    want = [("2020-01-02", "AA", 1.0, 1.5, 7.0, None), ("2020-01-02", "B B", None, 2.0, None, None),
            ("2020-01-06", "AA", 2.0, 3.0, None, None), ("2020-01-07", "B B", 8.0, 9.0, None, None)]
    assert got == want
    (tmp_path / "turned.csv").write_text("Ticker,AA\nPrice,Close\n2020-01-02,4")
    assert [r.Close for r in R.read_wide(spark, str(tmp_path / "turned.csv")).collect()] == [4.0]
    (tmp_path / "other.csv").write_text("a,b\nc,d\n")
    with pytest.raises(ValueError, match="no header line"):
        R.read_wide(spark, str(tmp_path / "other.csv"))
    assert R.read_wide(spark, str(tmp_path / "none")).count() == 0


def test_thousands_of_tickers_side_by_side(spark, tmp_path):
    tickers, days = [f"T{i}" for i in range(5000)], 20
    heads = [",".join(["Price", *["Close"] * 5000, *["Volume"] * 5000]), ",".join(["Ticker", *tickers, *tickers])]
    rows = [",".join([f"2020-01-{d + 1:02}", *[str(i + d) for i in range(5000)], *["1"] * 5000]) for d in range(days)]
    (tmp_path / "wide.csv").write_text("\n".join([*heads, *rows]))
    found = R.read_wide(spark, str(tmp_path / "wide.csv"))
    total = found.agg(F.count("*"), F.sum("Close"), F.sum("Volume"), F.count_distinct("Ticker")).first()
    assert tuple(total) == (100_000, float(sum(i + d for d in range(days) for i in range(5000))), 100_000.0, 5000)
