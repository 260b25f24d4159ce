import pandas as pd
from pyspark.sql import functions as F

from barsmith.operators.bars import build_bars
from barsmith.operators.features import add_features
from barsmith.plans.upkeep import read_features
from barsmith.sources import store as P
from barsmith.streaming.ingest import dropped, rebuild_bars, stream_bars, stream_ingest, stream_ticks
from helpers import same, to_spark, walk

LAYOUT = P.Layout(buckets=2)


def land(spark, frame: pd.DataFrame, path: str) -> None:
    to_spark(spark, frame).select(
        F.date_format("timestamp", "yyyy-MM-dd").alias("Date"),
        *[F.col(c).alias(c.capitalize()) for c in ["open", "high", "low", "close", "volume"]],
        F.col("symbol").alias("Ticker"),
    ).coalesce(1).write.mode("append").json(path)


def test_files_are_taken_once_and_corrections_win(spark, tmp_path):
    landing, base, check = (str(tmp_path / n) for n in ("landing", "store", "check"))

    def ingest():
        stream_ingest(spark, landing, base, check, layout=LAYOUT, ntz=True, files_per_batch=1).awaitTermination()
        return P.read_bars(spark, base, "1d", layout=LAYOUT, ntz=True).toPandas()

    first = walk("A", 40, 1)
    land(spark, pd.concat([first, walk("B", 10, 2)]), landing)
    same(ingest(), pd.concat([first, walk("B", 10, 2)]))
    late = first.head(3).assign(close=1.5)  # old bars, corrected long after
    land(spark, late, landing)
    want = pd.concat([late, first.tail(37), walk("B", 10, 2)])
    same(ingest(), want)
    same(ingest(), want)  # nothing new
    # A new checkpoint replays every file, in the order they arrived.
    check = str(tmp_path / "check2")
    same(ingest(), want)


def test_streamed_bars_equal_batch_bars(spark, tmp_path):
    ticks = spark.range(3000).select(
        F.concat(F.lit("S"), F.col("id") % 3).alias("symbol"),
        F.timestamp_seconds(1_700_000_000 + F.col("id") * 37).alias("timestamp"),
        ((F.col("id") * 7919) % 1000 / 10.0).alias("price"),
        F.lit(2.0).alias("size"),
    )
    path = str(tmp_path / "ticks")
    for part in range(3):
        ticks.where(F.floor(F.col("timestamp").cast("long") / 40_000) % 3 == part).coalesce(1).write.mode("append").parquet(path)
    # In event-time order within what the watermark allows: read all files at once.
    stream = spark.readStream.schema(ticks.schema).parquet(path)
    base = str(tmp_path / "store")
    stream_bars(stream, base, str(tmp_path / "check"), layout=LAYOUT).awaitTermination()
    got = P.read_bars(spark, base, "1h", layout=LAYOUT).toPandas()
    want = build_bars(ticks, "1h").toPandas()
    same(got, want)


def test_late_ticks_are_counted_and_repaired(spark, tmp_path):
    def ticks(*hours):
        return spark.createDataFrame([(h,) for h in hours], "hour int").select(
            F.lit("A").alias("symbol"),
            F.timestamp_seconds(1_700_000_000 + F.col("hour") * 3600).alias("timestamp"),
            (F.col("hour") + 1.0).alias("price"),
            F.lit(1.0).alias("size"),
        ).coalesce(1)

    path, base, check = (str(tmp_path / n) for n in ("ticks", "store", "check"))
    left_out = []
    for hours in ((0, 1, 30), (2, 31)):
        ticks(*hours).write.mode("append").parquet(path)
        stream = spark.readStream.schema(ticks(0).schema).parquet(path)
        query = stream_bars(stream, base, check, layout=LAYOUT)
        query.awaitTermination()
        left_out.append(dropped(query))
    stored = lambda: P.read_bars(spark, base, "1h", layout=LAYOUT).count()
    assert left_out == [0, 1] and stored() == 4
    rebuild_bars(spark.read.parquet(path), base, layout=LAYOUT)
    assert stored() == 5


def test_ticks_are_never_too_late_and_count_once(spark, tmp_path):
    """Files with ever older ticks, then the last file's batch again."""
    ticks = spark.range(2000).select(
        F.concat(F.lit("S"), F.col("id") % 3).alias("symbol"),
        F.timestamp_seconds(1_700_000_000 + F.col("id") * 97).alias("timestamp"),
        ((F.col("id") * 7919) % 1000 / 10.0).alias("price"),
        F.lit(2.0).alias("size"),
    )
    path, base, check = (str(tmp_path / n) for n in ("ticks", "store", "check"))
    features = str(tmp_path / "features")
    for part in (2, 0, 1):
        ticks.where(F.pmod(F.hash("timestamp"), F.lit(3)) == part).coalesce(1).write.mode("append").parquet(path)
        stream = spark.readStream.schema(ticks.schema).parquet(path)
        stream_ticks(stream, base, check, layout=LAYOUT, features=features).awaitTermination()
    bars = P.read_bars(spark, base, "1h", layout=LAYOUT)
    same(bars.toPandas(), build_bars(ticks, "1h").toPandas())
    kept = read_features(spark, features, "1h", LAYOUT).drop("close_t1").toPandas()
    same(kept, add_features(bars).toPandas())
    # the driver dies before the last batch is marked as done
    (commit,) = sorted((tmp_path / "check" / "commits").glob("2"))
    commit.unlink()
    (tmp_path / "check" / "commits" / ".2.crc").unlink(missing_ok=True)
    stream_ticks(spark.readStream.schema(ticks.schema).parquet(path), base, check, layout=LAYOUT).awaitTermination()
    same(P.read_bars(spark, base, "1h", layout=LAYOUT).toPandas(), build_bars(ticks, "1h").toPandas())
