"""The registered queries: every operator over the driver's whole tables.

Bars are derived by Spark from the tables once per session and folder, as a
stored table; the other queries start from there, as they would in use.
"""

from __future__ import annotations

import functools
import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

from barsmith.functions import scalar as S
from barsmith.operators import bars as B, features as X, indicators as I, model as M
from barsmith.operators import normalize as N, select as L, summary as D
from barsmith.operators.series import plan_series
from barsmith.plans.ingest import ingest, ingest_rejects
from barsmith.plans.latest import latest_response as respond, stored_response as respond_from_store
from barsmith.plans.scoring import score_latest as score
from barsmith.plans.sql import register_function, register_views, sync_table
from barsmith.plans.training import report_json, train_report, training_rows
from barsmith.schema import BAR_COLUMNS, FEATURE_COLUMNS, FEATURES, bar_schema, require_columns
from barsmith.session import configure, scratch_path, scratch_table, setting
from barsmith.sources import raw as R, store as P
from barsmith.sources.probe import quarantined, store_stats
from barsmith.sources.snapshots import latest, new_generation
from barsmith.sources.ticks import TRADE_ORDER, readings, trades
from barsmith.plans.upkeep import build_features, read_features
from barsmith.streaming.ingest import rebuild_bars, stream_bars, stream_ingest, stream_ticks

ASOF = "2001-11-04"
BY_SYMBOL = P.Layout(by="symbol")
BY_BUCKET = P.Layout(buckets=4)

QUERIES: dict = {}
_tables: dict = {}


def query(fn):
    """Register a query under its function's name."""

    @functools.wraps(fn)
    def run(spark: SparkSession, folder: str) -> DataFrame:
        return fn(configure(spark), folder)

    QUERIES[fn.__name__] = run
    return run


def once(fn):
    """Derive a table or path once per session and folder."""

    @functools.wraps(fn)
    def get(spark: SparkSession, folder: str):
        key = (fn.__name__, spark.sparkContext.applicationId, folder)
        if key not in _tables:
            _tables[key] = fn(spark, folder)
        return _tables[key]

    return get


def rounded(df: DataFrame, columns, digits: int = 6) -> DataFrame:
    """Rounded so that engines agree: first the noise of sums goes, then the digits."""
    return df.withColumns({c: F.round(F.round(c, digits + 3), digits) for c in columns})


def key_and(df: DataFrame, *columns) -> DataFrame:
    return df.select("symbol", "timestamp", *columns)


# --- derived inputs ---------------------------------------------------------


@once
def daily(spark, folder) -> DataFrame:
    return scratch_table(B.build_bars(trades(spark, folder), "1d", TRADE_ORDER), "daily")


@once
def hourly(spark, folder) -> DataFrame:
    events = spark.read.parquet(f"{folder}/events.parquet")
    return scratch_table(B.build_bars(readings(events), "1h"), "hourly")


@once
def labelled(spark, folder) -> DataFrame:
    return scratch_table(X.labelled_features(daily(spark, folder)), "labelled")


@once
def daily_store(spark, folder) -> str:
    base = scratch_path(spark, "prices_1d")
    P.write_bars(daily(spark, folder), base, "1d", BY_BUCKET)
    return base


@once
def daily_store_by_symbol(spark, folder) -> str:
    base = scratch_path(spark, "prices_1d")
    P.write_bars(daily(spark, folder), base, "1d", BY_SYMBOL)
    return base


def as_raw(bars: DataFrame) -> DataFrame:
    """Daily bars under the provider's column names."""
    return bars.select(
        F.date_format("timestamp", "yyyy-MM-dd").alias("Date"),
        F.col("open").alias("Open"),
        F.col("high").alias("High"),
        F.col("low").alias("Low"),
        F.col("close").alias("Close"),
        F.col("close").alias("Adj Close"),
        F.col("volume").alias("Volume"),
        F.col("symbol").alias("Ticker"),
    )


def land(bars: DataFrame, path: str, fmt: str) -> str:
    """Write bars as the files a provider leaves."""
    bars.write.option("header", True).format(fmt).save(path)
    return path


def stored_until(spark, folder) -> DataFrame:
    return daily(spark, folder).where(F.col("timestamp") <= F.lit("2001-10-01").cast("timestamp_ntz"))


def corrections(spark, folder) -> DataFrame:
    """A batch that overlaps the stored bars and corrects their close."""
    late = daily(spark, folder).where(F.col("timestamp") > F.lit("2001-09-24").cast("timestamp_ntz"))
    return late.withColumn("close", F.col("close") * 1.01)


def universe(spark, folder) -> DataFrame:
    """Brands with at least the average number of parts."""
    parts = spark.read.parquet(f"{folder}/part.parquet")
    per_brand = parts.groupBy("p_brand").count()
    mean = per_brand.agg(F.sum("count") / F.count("*")).first()[0]
    return per_brand.where(F.col("count") >= mean).select(F.col("p_brand").alias("symbol"))


def fixed_models(spark, folder) -> DataFrame:
    """A model for 20 of the brands, its numbers computed from the brand's number."""
    parts = spark.read.parquet(f"{folder}/part.parquet")
    k = F.regexp_extract("symbol", r"(\d+)", 1).cast("int")
    coef = [((k * (i + 1)) % 7 - 3) / F.lit(10.0) for i in range(len(FEATURES))]
    return (
        parts.select(F.col("p_brand").alias("symbol"))
        .distinct()
        .where(k <= 20)
        .select("symbol", F.array(*coef).alias("coef"), ((k % 5 - 2) / F.lit(10.0)).alias("intercept"))
    )


def scored(spark, folder) -> DataFrame:
    return M.with_signal(M.predict_proba(labelled(spark, folder), fixed_models(spark, folder)))


# --- sources and sinks ------------------------------------------------------


@query
def raw_scan_daily(spark, folder):
    path = land(as_raw(daily(spark, folder)), scratch_path(spark, "landing"), "csv")
    return R.raw_bars(spark, path, "csv", "1d", ntz=True)


@query
def raw_scan_hourly(spark, folder):
    path = scratch_path(spark, "landing")
    hourly(spark, folder).select(
        F.date_format("timestamp", "yyyy-MM-dd HH:mm:ss").alias("Datetime"),
        *[F.col(c).alias(c.capitalize()) for c in ["open", "high", "low", "close", "volume"]],
        F.col("symbol").alias("Ticker"),
    ).write.json(path)
    return R.raw_bars(spark, path, "json", "1h", ntz=True)


@query
def store_scan(spark, folder):
    return P.read_bars(spark, daily_store(spark, folder), "1d", layout=BY_BUCKET, ntz=True)


@query
def store_scan_pruned(spark, folder):
    base = daily_store(spark, folder)
    wanted = ["Brand#3", "Brand#14"]
    return P.read_bars(spark, base, "1d", wanted, "1998-02-10", "2000-06-15", BY_BUCKET, ntz=True)


@query
def recent_bars(spark, folder):
    return P.recent_bars(spark, daily_store(spark, folder), "1d", ASOF, 12, layout=BY_BUCKET, ntz=True)


@query
def read_latest(spark, folder):
    return P.read_latest(spark, daily_store(spark, folder), "1d", 120, asof=ASOF, layout=BY_BUCKET, ntz=True)


@query
def touched_partitions(spark, folder):
    return P.touched_partitions(corrections(spark, folder), "1d", BY_SYMBOL)


@query
def touched_rows(spark, folder):
    base = daily_store_by_symbol(spark, folder)
    return P.read_touched(spark, base, corrections(spark, folder), "1d", BY_SYMBOL, ntz=True)


@query
def recent_files(spark, folder):
    """The files of the last write into a folder of bars."""
    base = scratch_path(spark, "files")
    stored_until(spark, folder).write.parquet(base)
    corrections(spark, folder).repartition(4).write.mode("append").parquet(base)
    return R.read_recent_files(spark, base, 4, bar_schema(ntz=True))


@query
def fallback_source(spark, folder):
    primary = B.resample(hourly(spark, folder))
    second = primary.withColumn("close", F.col("close") * 2).unionByName(daily(spark, folder))
    return R.with_fallback(primary, second)


@query
def write_read_daily(spark, folder):
    base = daily_store_by_symbol(spark, folder)
    return P.read_bars(spark, base, "1d", layout=BY_SYMBOL, ntz=True)


@query
def write_read_hourly(spark, folder):
    base = scratch_path(spark, "prices_1h")
    P.write_bars(hourly(spark, folder), base, "1h", BY_SYMBOL)
    return P.read_bars(spark, base, "1h", layout=BY_SYMBOL, ntz=True)


@query
def upsert(spark, folder):
    base = scratch_path(spark, "prices_1d")
    P.write_bars(stored_until(spark, folder), base, "1d", BY_BUCKET)
    P.upsert_bars(spark, base, corrections(spark, folder), "1d", BY_BUCKET, ntz=True)
    return P.read_bars(spark, base, "1d", layout=BY_BUCKET, ntz=True)


@query
def ingest_update(spark, folder):
    base = scratch_path(spark, "prices_1d")
    P.write_bars(stored_until(spark, folder), base, "1d", BY_BUCKET)
    landing = land(as_raw(corrections(spark, folder)), scratch_path(spark, "landing"), "csv")
    ingest(spark, landing, base, "1d", layout=BY_BUCKET, ntz=True)
    return P.read_bars(spark, base, "1d", layout=BY_BUCKET, ntz=True)


@query
def ingest_backfill(spark, folder):
    base = scratch_path(spark, "prices_1d")
    landing = land(as_raw(daily(spark, folder)), scratch_path(spark, "landing"), "json")
    ingest(spark, landing, base, "1d", "backfill", asof=ASOF, fmt="json", layout=BY_BUCKET, ntz=True)
    return P.read_bars(spark, base, "1d", layout=BY_BUCKET, ntz=True)


@query
def dry_run(spark, folder):
    return P.plan_write(corrections(spark, folder))


@query
def write_summary(spark, folder):
    return P.write_summary(spark, daily_store_by_symbol(spark, folder), "1d", BY_SYMBOL, ntz=True)


@query
def retention(spark, folder):
    return P.expire_bars(daily(spark, folder), ASOF, 365)


@query
def expire_store(spark, folder):
    base = scratch_path(spark, "prices_1d")
    P.write_bars(daily(spark, folder), base, "1d", BY_BUCKET)
    P.expire_store(spark, base, "1d", ASOF, 365, BY_BUCKET)
    return P.read_bars(spark, base, "1d", layout=BY_BUCKET, ntz=True)


@query
def models_roundtrip(spark, folder):
    path = scratch_path(spark, "models")
    M.save_models(fixed_models(spark, folder), path)
    return M.load_models(spark, path).select("symbol", "intercept", F.posexplode("coef").alias("position", "coef"))


# --- normalisation ----------------------------------------------------------


@query
def normalize_raw(spark, folder):
    return N.normalize(as_raw(daily(spark, folder)), "1d", ntz=True)


@query
def wide_to_long(spark, folder):
    """Bars of all brands side by side, as a download of many tickers has them."""
    fields = ["open", "high", "low", "close", "volume"]
    wide = daily(spark, folder).groupBy(F.col("timestamp").alias("Date")).pivot("symbol").agg(
        *[F.first(c).alias(c.capitalize()) for c in fields]
    )
    # Pivot names columns `TICKER_Field`; a download names them `Field_TICKER`.
    pairs = [name.rsplit("_", 1) for name in wide.columns[1:]]
    wide = wide.toDF("Date", *[f"{field}_{ticker}" for ticker, field in pairs])
    tickers = list(dict.fromkeys(ticker for ticker, _ in pairs))
    return N.normalize(N.wide_to_long(wide, tickers), "1d", ntz=True)


@query
def to_utc(spark, folder):
    events = spark.read.parquet(f"{folder}/events.parquet")
    text = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss")
    both = events.select(
        "event_id", text.alias("naive"), F.concat(text, F.lit("+02:00")).alias("aware")
    )
    return N.to_utc(N.to_utc(both, "naive", ntz=True), "aware", ntz=True)


@query
def partition_columns(spark, folder):
    return N.with_partitions(hourly(spark, folder).select("symbol", "timestamp"), "1h")


@query
def candles(spark, folder):
    return D.to_candles(hourly(spark, folder))


@query
def latest_nested(spark, folder):
    nested = D.latest_nested(hourly(spark, folder))
    return nested.select("symbol", "interval", F.posexplode("candles").alias("position", "candle")).select(
        "symbol", "interval", "position", "candle.*"
    )


@query
def latest_response(spark, folder):
    """Every symbol of both bar sets asked for; stored are the hourly ones, by day."""
    stored = B.resample(hourly(spark, folder))
    asked = stored.select("symbol").unionByName(daily(spark, folder).select("symbol"))
    known = universe(spark, folder).unionByName(stored.select("symbol").distinct())
    answer = respond(asked, known, stored, daily(spark, folder), "1d", 20)
    return answer.select("symbol", "interval", "error", F.inline_outer("candles"))


@query
def parse_symbols(spark, folder):
    parts = spark.read.parquet(f"{folder}/part.parquet")
    text = F.concat_ws(" ,, ", "p_brand", "p_type", F.lit(" "))
    return (
        parts.select(F.explode(S.parse_symbols(text)).alias("symbol"))
        .groupBy("symbol")
        .agg(F.count("*").alias("requests"))
    )


# --- selection --------------------------------------------------------------


@query
def allow_symbols(spark, folder):
    return L.allow_symbols(daily(spark, folder), universe(spark, folder)).select(*BAR_COLUMNS)


@query
def reject_symbols(spark, folder):
    asked = B.resample(hourly(spark, folder)).unionByName(daily(spark, folder))
    return L.reject_symbols(asked.groupBy("symbol").agg(F.count("*").alias("requests")), universe(spark, folder))


@query
def last_months(spark, folder):
    return L.last_months(daily(spark, folder), ASOF, 12)


@query
def last_hours(spark, folder):
    return L.last_hours(hourly(spark, folder), 12)


@query
def last_period_days(spark, folder):
    return L.last_period(hourly(spark, folder), "5d")


@query
def last_period_months(spark, folder):
    return L.last_period(daily(spark, folder), "6mo", ASOF)


@query
def min_history(spark, folder):
    return L.min_history(L.last_months(daily(spark, folder), ASOF, 12), 200).select(*BAR_COLUMNS)


@query
def drop_incomplete(spark, folder):
    """Bars with the next bar's close attached; the last of each symbol lacks it."""
    return X.drop_incomplete(X.next_close(daily(spark, folder)))


@query
def time_split(spark, folder):
    return key_and(L.time_split(labelled(spark, folder), 90), "split")


@query
def require_both_splits(spark, folder):
    split = L.time_split(labelled(spark, folder), 2455)
    return key_and(L.require_both_splits(split), "split")


@query
def symbol_filter(spark, folder):
    return L.of_symbol(daily(spark, folder), "Brand#13", "1d")


@query
def latest_n(spark, folder):
    return L.latest_n(daily(spark, folder), 120)


@query
def latest_features(spark, folder):
    newest = L.latest_row(X.add_features(daily(spark, folder)))
    return rounded(key_and(newest, *FEATURE_COLUMNS), FEATURE_COLUMNS)


@query
def data_range(spark, folder):
    return L.data_range(hourly(spark, folder)).drop("interval")


@query
def max_timestamp(spark, folder):
    return L.max_timestamp(daily(spark, folder)).drop("interval")


# --- bars -------------------------------------------------------------------


@query
def hourly_bars(spark, folder):
    return B.build_bars(readings(spark.read.parquet(f"{folder}/events.parquet")), "1h")


@query
def daily_bars(spark, folder):
    return B.build_bars(trades(spark, folder), "1d", TRADE_ORDER)


@query
def resample_daily(spark, folder):
    return B.resample(hourly(spark, folder), "1d")


@query
def union_bars(spark, folder):
    return B.union_bars(stored_until(spark, folder), corrections(spark, folder))


@query
def dedupe_keep_last(spark, folder):
    both = B.union_bars(stored_until(spark, folder), corrections(spark, folder))
    return B.dedupe_keep_last(both).select(*BAR_COLUMNS)


@query
def merge_stats(spark, folder):
    return B.merge_stats(stored_until(spark, folder), corrections(spark, folder)).drop("interval")


# --- features ---------------------------------------------------------------


@query
def returns(spark, folder):
    names = ["ret1", "ret5", "ret10"]
    return rounded(key_and(X.returns(daily(spark, folder)), *names), names)


@query
def sma(spark, folder):
    names = ["sma5", "sma10", "sma20"]
    return rounded(key_and(X.sma(daily(spark, folder)), *names), names)


@query
def dist_sma(spark, folder):
    names = ["dist_sma5", "dist_sma10", "dist_sma20"]
    return rounded(key_and(X.dist_sma(daily(spark, folder)), *names), names)


@query
def volatility(spark, folder):
    return rounded(key_and(X.volatility(daily(spark, folder)), "vol10"), ["vol10"])


@query
def features(spark, folder):
    return rounded(X.add_features(daily(spark, folder)), FEATURE_COLUMNS)


@query
def next_close(spark, folder):
    return key_and(X.next_close(daily(spark, folder)), "close", "close_t1")


@query
def labels(spark, folder):
    return rounded(X.labelled_features(daily(spark, folder)), FEATURE_COLUMNS)


@query
def features_split_series(spark, folder):
    """The same feature rows with every symbol cut into blocks of some 100 bars."""
    bars = daily(spark, folder)
    return rounded(X.labelled_features(bars, plan_series(bars, max_rows=100)), FEATURE_COLUMNS)


@query
def rsi(spark, folder):
    return rounded(key_and(I.rsi(daily(spark, folder)), "rsi"), ["rsi"])


@query
def bollinger(spark, folder):
    names = ["bb_middle", "bb_upper", "bb_lower"]
    return rounded(key_and(I.bollinger(daily(spark, folder)), *names), names, 4)


@query
def price_position(spark, folder):
    return rounded(key_and(I.price_position(daily(spark, folder)), "price_position"), ["price_position"])


@query
def volume_profile(spark, folder):
    return rounded(I.volume_profile(daily(spark, folder)).drop("interval"), ["price_from"])


@query
def momentum(spark, folder):
    return rounded(key_and(I.momentum(daily(spark, folder), 12), "momentum12"), ["momentum12"])


# --- models -----------------------------------------------------------------


@query
def feature_array(spark, folder):
    rows = M.feature_array(labelled(spark, folder))
    return rounded(key_and(rows, F.posexplode("features").alias("position", "value")), ["value"])


@query
def train_models(spark, folder):
    return M.train_models(labelled(spark, folder))


@query
def train_large_models(spark, folder):
    """The same models, each symbol trained by aggregation instead of as a group."""
    return M.train_models(labelled(spark, folder), max_rows=1)


@query
def train_models_optimal(spark, folder):
    """What must hold for trained models: no gradient left, and both ways of training agree.

    `gradient` is the largest derivative of the objective at the model, `gap` the
    largest difference of a coefficient between the two ways.
    """
    rows = labelled(spark, folder)
    models = scratch_table(M.train_models(rows), "models")
    large = M.train_models(rows, max_rows=1).select("symbol", F.col("coef").alias("other"))
    miss = F.col("prob_up") - F.col("label")
    sums = M.predict_proba(rows, models).groupBy("symbol").agg(
        F.array(*[F.sum(miss * F.col(c)) for c in FEATURES]).alias("sums"), F.abs(F.sum(miss)).alias("free")
    )
    gradient = F.array_max(F.zip_with("sums", "coef", lambda s, c: F.abs(s + c)))
    gap = F.array_max(F.zip_with("coef", "other", lambda a, b: F.abs(a - b)))
    checked = models.join(sums, "symbol").join(large, "symbol").select(
        "symbol", "n_train", "status", F.greatest(gradient, "free").alias("gradient"), gap.alias("gap")
    )
    return rounded(checked, ["gradient", "gap"], 3)


@query
def predict_proba_fixed(spark, folder):
    scores = M.predict_proba(labelled(spark, folder), fixed_models(spark, folder))
    return rounded(key_and(scores, "prob_up"), ["prob_up"])


@query
def predict_class(spark, folder):
    return key_and(M.predict_class(labelled(spark, folder), fixed_models(spark, folder)), "predicted")


@query
def predict_default(spark, folder):
    return rounded(key_and(scored(spark, folder), "prob_up", "signal", "status"), ["prob_up"])


@query
def signals(spark, folder):
    return key_and(scored(spark, folder), "signal")


@query
def signals_doc(spark, folder):
    rows = scored(spark, folder)
    return key_and(rows.withColumn("signal", S.signal_strict(F.col("prob_up"))), "signal")


@query
def confidence(spark, folder):
    rows = scored(spark, folder)
    return key_and(rows.withColumn("confidence", S.confidence(F.col("prob_up"))), "confidence")


@query
def eval_metrics(spark, folder):
    scores = M.evaluate(labelled(spark, folder), fixed_models(spark, folder))
    return rounded(scores, ["accuracy", "f1"])


@query
def evaluate(spark, folder):
    """Hold-out metrics of trained models."""
    rows = L.require_both_splits(L.time_split(labelled(spark, folder), 90))
    models = scratch_table(M.train_models(rows.where("split = 'train'")), "models")
    return M.evaluate(rows.where("split = 'test'"), models)


@query
def score_latest(spark, folder):
    scores = score(daily(spark, folder), fixed_models(spark, folder), ASOF)
    return rounded(scores, ["prob_up"])


@query
def score_latest_trained(spark, folder):
    models = scratch_table(M.train_models(labelled(spark, folder)), "models")
    return score(daily(spark, folder), models, ASOF)


@query
def training_split(spark, folder):
    return key_and(training_rows(daily(spark, folder), ASOF), "label", "split")


@query
def training_report(spark, folder):
    return report_json(train_report(daily(spark, folder), ASOF)[1])


@query
def cv_folds(spark, folder):
    return key_and(M.cv_folds(labelled(spark, folder), 5), "tile")


@query
def cv_folds_split_series(spark, folder):
    rows = labelled(spark, folder)
    return key_and(M.cv_folds(rows, 5, plan_series(rows, max_rows=100)), "tile")


@query
def cv_report(spark, folder):
    return M.cv_report(labelled(spark, folder), 5)


# --- display ----------------------------------------------------------------


@query
def market_summary(spark, folder):
    return rounded(D.market_summary(daily(spark, folder)), ["change_pct"]).drop("interval")


@query
def price_card(spark, folder):
    return D.price_card(D.market_summary(daily(spark, folder)))


@query
def signal_card(spark, folder):
    return D.signal_card(L.latest_row(scored(spark, folder)))


@query
def format_compact(spark, folder):
    turnover = F.col("close") * F.col("volume")
    return key_and(daily(spark, folder), S.format_compact(turnover).alias("turnover"))


@query
def format_usd(spark, folder):
    moved = F.col("close") - F.col("open")
    return key_and(daily(spark, folder), S.format_usd(moved).alias("moved"))


@query
def format_pct(spark, folder):
    percent = (F.col("close") - F.col("open")) / F.col("open") * 100
    return key_and(daily(spark, folder), S.format_pct(percent).alias("moved"))


@query
def sql_latest(spark, folder):
    register_views(spark, {"1d": daily_store(spark, folder)}, layout=BY_BUCKET, ntz=True)
    return spark.sql(
        """
        SELECT symbol, timestamp, close, volume FROM (
            SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY timestamp DESC) AS n
            FROM bars_1d)
        WHERE n <= 5
        """
    )


# --- streams ----------------------------------------------------------------


@query
def stream_upsert(spark, folder):
    """Corrections arrive as landing files, in two streaming batches."""
    base, landing = scratch_path(spark, "prices_1d"), scratch_path(spark, "landing")
    P.write_bars(stored_until(spark, folder), base, "1d", BY_BUCKET)
    land(as_raw(corrections(spark, folder)).repartition(2, "Ticker"), landing, "json")
    stream_ingest(
        spark, landing, base, scratch_path(spark, "checkpoint"), "1d", "json", BY_BUCKET,
        ntz=True, files_per_batch=1,
    ).awaitTermination()
    return P.read_bars(spark, base, "1d", layout=BY_BUCKET, ntz=True)


@query
def stream_hourly_bars(spark, folder):
    base = scratch_path(spark, "prices_1h")
    file = f"{folder}/events.parquet"
    events = (
        spark.readStream.schema(spark.read.parquet(file).schema)
        .option("pathGlobFilter", "events.parquet")
        .parquet(folder)
        .withColumn("ts", F.col("ts").cast("timestamp"))
    )
    # A stream keeps one state store per shuffle partition; some suffice here.
    with setting(spark, "spark.sql.shuffle.partitions", 8):
        stream_bars(
            readings(events), base, scratch_path(spark, "checkpoint"), layout=BY_BUCKET, ntz=True
        ).awaitTermination()
    return P.read_bars(spark, base, "1h", layout=BY_BUCKET, ntz=True)


# --- as of a past day, after a crash, with bad rows, and hourly -------------

PAST = "1999-06-15"


@query
def last_months_past(spark, folder):
    return L.last_months(daily(spark, folder), PAST, 12)


@query
def recent_bars_past(spark, folder):
    return P.recent_bars(spark, daily_store(spark, folder), "1d", PAST, 12, layout=BY_BUCKET, ntz=True)


@query
def score_latest_past(spark, folder):
    return rounded(score(daily(spark, folder), fixed_models(spark, folder), PAST), ["prob_up"])


@query
def training_split_past(spark, folder):
    return key_and(training_rows(daily(spark, folder), PAST), "label", "split")


@query
def upsert_after_crash(spark, folder):
    """A first upsert of other values is written in full, and dies before it counts; the next one is whole."""
    base = scratch_path(spark, "prices_1d")
    P.write_bars(stored_until(spark, folder), base, "1d", BY_BUCKET)
    wrong = corrections(spark, folder).withColumn("close", F.lit(0.0))
    dead = f"{base}/gen={new_generation(latest(spark, base))}"
    BY_BUCKET.place(wrong, "1d").write.partitionBy(*BY_BUCKET.columns("1d")).parquet(dead)
    P.upsert_bars(spark, base, corrections(spark, folder), "1d", BY_BUCKET, ntz=True)
    return P.read_bars(spark, base, "1d", layout=BY_BUCKET, ntz=True)


@query
def rejected_bars(spark, folder):
    """Landed bars of the 13th have no closing price, those of the 14th no readable date."""
    raw = as_raw(daily(spark, folder))
    day = F.substring("Date", 9, 2)
    raw = raw.withColumn("Close", F.when(day != "13", F.col("Close")))
    raw = raw.withColumn("Date", F.when(day == "14", "unknown").otherwise(F.col("Date")))
    landing = land(raw, scratch_path(spark, "landing"), "csv")
    found = ingest_rejects(spark, landing, "1d", "csv", ntz=True)
    return found.groupBy("symbol", "reason").agg(F.count("*").alias("bars"))


def land_hourly(spark, folder):
    times = hourly(spark, folder).select(F.date_format("timestamp", "yyyy-MM-dd HH:mm:ss").alias("Datetime"), "*")
    raw = times.select(
        "Datetime",
        *[F.col(c).alias(c.capitalize()) for c in ("open", "high", "low", "close")],
        F.col("close").alias("Adj Close"),
        F.col("volume").alias("Volume"),
        F.col("symbol").alias("Ticker"),
    )
    return land(raw, scratch_path(spark, "landing"), "csv")


@query
def ingest_backfill_hourly(spark, folder):
    base = scratch_path(spark, "prices_1h")
    ingest(spark, land_hourly(spark, folder), base, "1h", "backfill", layout=BY_BUCKET, ntz=True)
    return P.read_bars(spark, base, "1h", layout=BY_BUCKET, ntz=True)


@query
def ingest_update_hourly(spark, folder):
    base = scratch_path(spark, "prices_1h")
    ingest(spark, land_hourly(spark, folder), base, "1h", "update", layout=BY_BUCKET, ntz=True)
    return P.read_bars(spark, base, "1h", layout=BY_BUCKET, ntz=True)


@query
def latest_n_of_both_intervals(spark, folder):
    bars = hourly(spark, folder)
    return L.latest_n(bars.unionByName(B.resample(bars, "1d").select(*bars.columns)), 4)


# --- the rest of the sources and checks --------------------------------------


@query
def two_level_columns(spark, folder):
    """Bars under names of two levels, of which the time has only the second."""
    raw = as_raw(daily(spark, folder))
    raw = raw.toDF(*[f"('', '{c}')" if c == "Date" else f"('{c}', 'ALL')" for c in raw.columns])
    return N.normalize(raw, "1d", ntz=True)


@query
def lower_columns(spark, folder):
    """Bars whose time column is found by its name among names in lower case."""
    raw = N.lower_columns(as_raw(daily(spark, folder))).withColumnRenamed("ticker", "symbol")
    named = raw.select("symbol", *raw.columns[:-1]).withColumnRenamed(N.find_timestamp_col(raw), "timestamp")
    return N.select_bars(N.to_utc(N.tag(named, interval="1d"), ntz=True))


@query
def required_columns(spark, folder):
    return require_columns(daily(spark, folder), BAR_COLUMNS)


@query
def corrupt_files(spark, folder):
    """A store in which a file of each month is no Parquet file."""
    base = scratch_path(spark, "prices_1d")
    P.write_bars(daily(spark, folder), base, "1d", BY_BUCKET)
    months = daily(spark, folder).select(
        F.lit("no bars").alias("value"), F.lit("1d").alias("interval"),
        F.year("timestamp").alias("year"), F.month("timestamp").alias("month"), F.lit(0).alias("bucket"),
    ).distinct()
    months.write.mode("append").partitionBy("interval", "year", "month", "bucket").text(P.tree(spark, base))
    return P.read_bars(spark, base, "1d", layout=BY_BUCKET, ntz=True, ignore_corrupt=True)


@query
def missing_sources(spark, folder):
    """Neither a store nor a landing folder that is not there adds a bar."""
    none = scratch_path(spark, "none")
    stored = P.read_bars(spark, none, "1d", ntz=True)
    return daily(spark, folder).unionByName(stored).unionByName(R.raw_bars(spark, none, "csv", "1d", ntz=True))


@query
def broken_predictions(spark, folder):
    """Scores of the 13th are no probabilities, signals of the 14th none of the three."""
    day = F.dayofmonth("timestamp")
    broken = scored(spark, folder).withColumns(
        {
            "prob_up": F.when(day == 13, 1.5).otherwise(F.col("prob_up")),
            "signal": F.when(day == 14, "wait").otherwise(F.col("signal")),
        }
    )
    return key_and(M.check_predictions(broken))


@query
def repeated_batch(spark, folder):
    """A batch that comes again under its id, as a restarted stream sends it."""
    base = scratch_path(spark, "prices_1d")
    P.write_bars(stored_until(spark, folder), base, "1d", BY_BUCKET)
    for _ in range(2):
        P.upsert_bars(spark, base, corrections(spark, folder), "1d", BY_BUCKET, ntz=True, batch_id="stream-0")
    return P.read_bars(spark, base, "1d", layout=BY_BUCKET, ntz=True)


@query
def rebuilt_bars(spark, folder):
    """Bars of every second reading, repaired from all of them."""
    base = scratch_path(spark, "prices_1h")
    events = spark.read.parquet(f"{folder}/events.parquet")
    for some in (events.where(F.col("event_id") % 2 == 0), events):
        rebuild_bars(readings(some), base, layout=BY_BUCKET, ntz=True)
    return P.read_bars(spark, base, "1h", layout=BY_BUCKET, ntz=True)


@query
def stored_response(spark, folder):
    """Every brand asked for, answered from the store."""
    asked = daily(spark, folder).select("symbol")
    answer = respond_from_store(
        spark, asked, universe(spark, folder), daily_store(spark, folder), interval="1d", n=20,
        asof=ASOF, layout=BY_BUCKET, ntz=True,
    )
    return answer.select("symbol", "interval", "error", F.inline_outer("candles"))


@query
def sql_month(spark, folder):
    """One month by SQL; the other folders stay closed."""
    register_views(spark, {"1d": daily_store(spark, folder)}, layout=BY_BUCKET, ntz=True)
    return spark.sql("SELECT symbol, timestamp, close FROM bars_1d WHERE year = 2000 AND month = 3")


# --- what holds for trained models whatever their numbers --------------------


def within(*shares):
    """Whether all given shares lie between 0 and 1; those of no model are missing."""
    fine = F.lit(True)
    for share in shares:
        fine = fine & F.col(share).between(0.0, 1.0)
    return fine


@query
def training_report_facts(spark, folder):
    report = train_report(daily(spark, folder), ASOF)[1]
    return report.select(
        "symbol", "model_path", "n_train", "n_test", "status", within("metrics.accuracy", "metrics.f1").alias("within")
    )


@query
def cv_report_facts(spark, folder):
    report = M.cv_report(labelled(spark, folder), 5)
    return report.select("symbol", "fold", "n_train", "n_test", "status", within("accuracy", "f1").alias("within"))


@query
def score_latest_trained_facts(spark, folder):
    """Every symbol once, with a probability and the signal that follows from it."""
    scores = score_latest_trained(spark, folder)
    follows = F.col("signal") == S.signal(F.col("prob_up"))
    return scores.select("symbol", "asof", "status", (within("prob_up") & follows).alias("within"))


@query
def evaluate_facts(spark, folder):
    return evaluate(spark, folder).select("symbol", "n_test", within("accuracy", "f1").alias("within"))


# --- readers beside writers, kept features, recursive averages, kept models ---


@query
def upsert_while_reading(spark, folder):
    """What a reader that began before an upsert sees, and what one that begins after it sees."""
    base = scratch_path(spark, "prices_1d")
    P.write_bars(stored_until(spark, folder), base, "1d", BY_BUCKET)
    before = P.read_bars(spark, base, "1d", layout=BY_BUCKET, ntz=True)
    P.upsert_bars(spark, base, corrections(spark, folder), "1d", BY_BUCKET, ntz=True)
    after = P.read_bars(spark, base, "1d", layout=BY_BUCKET, ntz=True)
    return before.withColumn("reader", F.lit("before")).unionByName(after.withColumn("reader", F.lit("after")))


@query
def features_after_corrections(spark, folder):
    """Stored features and next closes after a streamed batch of new and corrected bars."""
    bars, kept = scratch_path(spark, "prices_1d"), scratch_path(spark, "features_1d")
    P.write_bars(stored_until(spark, folder), bars, "1d", BY_BUCKET)
    build_features(spark, bars, kept, "1d", BY_BUCKET, ntz=True)
    landing = land(as_raw(corrections(spark, folder)), scratch_path(spark, "landing"), "json")
    stream_ingest(
        spark, landing, bars, scratch_path(spark, "checkpoint"), layout=BY_BUCKET, ntz=True, features=kept
    ).awaitTermination()
    return rounded(read_features(spark, kept, "1d", BY_BUCKET, ntz=True), [*FEATURE_COLUMNS, "close_t1"])


@query
def stream_late_ticks(spark, folder):
    """Readings that come in three parts, each with readings from before the last one's end."""
    events = spark.read.parquet(f"{folder}/events.parquet").withColumn("ts", F.col("ts").cast("timestamp"))
    path, base = scratch_path(spark, "ticks"), scratch_path(spark, "prices_1h")
    checkpoint = scratch_path(spark, "checkpoint")
    for part in range(3):
        events.where(F.col("event_id") % 3 == part).write.mode("append").parquet(path)
        stream = spark.readStream.schema(events.schema).parquet(path)
        stream_ticks(readings(stream), base, checkpoint, layout=BY_BUCKET, ntz=True).awaitTermination()
    return P.read_bars(spark, base, "1h", layout=BY_BUCKET, ntz=True)


@query
def rsi_wilder(spark, folder):
    return rounded(key_and(I.rsi_wilder(daily(spark, folder)), "rsi_wilder"), ["rsi_wilder"])


@query
def rsi_wilder_split_series(spark, folder):
    """The same values with every symbol cut into blocks of some 100 bars, and those into chunks of 64."""
    bars = daily(spark, folder)
    found = I.rsi_wilder(bars, plan=plan_series(bars, max_rows=100), chunk=64)
    return rounded(key_and(found, "rsi_wilder"), ["rsi_wilder"])


def model_versions(spark, folder) -> DataFrame:
    """The models of 20 brands, trained anew each year: the intercept tells the year."""
    path = scratch_path(spark, "versions")
    models = fixed_models(spark, folder)
    for year in range(1996, 2002):
        shifted = models.withColumn("intercept", F.col("intercept") + (year - 1997) / 10.0)
        M.save_version(shifted, path, f"{year}-07-01 00:00:00")
    return M.load_versions(spark, path)


@query
def score_asof_trained_versions(spark, folder):
    """Each bar scored by the model that was known then."""
    scored = M.predict_proba_asof(labelled(spark, folder), model_versions(spark, folder))
    return rounded(key_and(scored, M.TRAINED, "prob_up"), ["prob_up"])


@query
def score_latest_of_versions(spark, folder):
    """A past day's scores by the versions of that time."""
    return rounded(score(daily(spark, folder), model_versions(spark, folder), PAST), ["prob_up"])


def both_intervals(spark, folder) -> DataFrame:
    """Hourly and daily bars of the same symbols in one frame."""
    bars = hourly(spark, folder)
    return bars.unionByName(B.resample(bars))


@query
def volume_profile_of_both_intervals(spark, folder):
    return rounded(I.volume_profile(both_intervals(spark, folder)), ["price_from"])


@query
def resample_of_both_intervals(spark, folder):
    return B.resample(both_intervals(spark, folder))


# --- the catalog --------------------------------------------------------------


def catalog_table(spark, base: str) -> str:
    """The name of a new table that shows the store of daily bars."""
    name = f"prices_{uuid.uuid4().hex}"
    sync_table(spark, name, base, "1d", BY_BUCKET, ntz=True)
    return name


@query
def sql_table_after_upsert(spark, folder):
    """The catalog's table, made before an upsert and brought up to date after it."""
    base = scratch_path(spark, "prices_1d")
    P.write_bars(stored_until(spark, folder), base, "1d", BY_BUCKET)
    name = catalog_table(spark, base)
    P.upsert_bars(spark, base, corrections(spark, folder), "1d", BY_BUCKET, ntz=True)
    sync_table(spark, name, base, "1d", BY_BUCKET, ntz=True)
    return spark.sql(f"SELECT {', '.join(BAR_COLUMNS)} FROM {name}")


@query
def sql_table_function(spark, folder):
    name = catalog_table(spark, daily_store(spark, folder))
    register_function(spark, {"1d": name}, BY_BUCKET, ntz=True)
    return spark.sql(
        """
        SELECT symbol, year(timestamp) AS year, count(*) AS bars, max(high) AS high
        FROM bars('1d', array('Brand#3', 'Brand#14'), TIMESTAMP_NTZ '1998-02-10', TIMESTAMP_NTZ '2000-06-15')
        GROUP BY ALL
        """
    )


# --- wide text files, files that cannot be read -------------------------------


@query
def wide_text_files(spark, folder):
    """Bars of all brands side by side in text files with two header lines."""
    fields = ["Open", "High", "Low", "Close", "Volume"]
    wide = daily(spark, folder).groupBy(F.date_format("timestamp", "yyyy-MM-dd").alias("Date")).pivot("symbol").agg(
        *[F.first(f.lower()).alias(f) for f in fields]
    )
    pairs = [name.rsplit("_", 1) for name in wide.columns[1:]]
    heads = [["Price", *[f for _, f in pairs]], ["Ticker", *[t for t, _ in pairs]], ["Date", *["" for _ in pairs]]]
    heads = spark.createDataFrame([(i, ",".join(line)) for i, line in enumerate(heads)], "place int, value string")
    cells = [F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")) for c in wide.columns]
    path = scratch_path(spark, "landing")
    for year in ("1995", "1996-2001"):
        some = wide.where((F.substring("Date", 1, 4) == "1995") == F.lit(year == "1995"))
        lines = heads.unionByName(some.select(F.lit(9).alias("place"), F.concat_ws(",", *cells).alias("value")))
        lines.repartition(1).sortWithinPartitions("place").select("value").write.mode("append").text(path)
    return R.raw_bars(spark, path, "wide", "1d", ntz=True)


@query
def quarantined_files(spark, folder):
    """A store in which a file of each month is no Parquet file."""
    base = scratch_path(spark, "prices_1d")
    P.write_bars(daily(spark, folder), base, "1d", BY_BUCKET)
    months = daily(spark, folder).select(
        F.lit("no bars at all").alias("value"), F.lit("1d").alias("interval"),
        F.year("timestamp").alias("year"), F.month("timestamp").alias("month"), F.lit(0).alias("bucket"),
    ).distinct()
    months.write.mode("append").partitionBy("interval", "year", "month", "bucket").text(P.tree(spark, base))
    of = [F.regexp_extract("path", f"/{part}=([0-9]+)/", 1).cast("int").alias(part) for part in ("year", "month", "bucket")]
    return quarantined(spark, base).select(*of, "bytes", "reason")


@query
def store_stats_by_symbol(spark, folder):
    """Rows and time range of each symbol from the files' footers."""
    found = store_stats(spark, daily_store_by_symbol(spark, folder), ("symbol",))
    return found.select("symbol", "rows", "first_timestamp", "last_timestamp", "unreadable")


@query
def store_stats_by_month(spark, folder):
    """Rows of each month after an upsert: what was replaced does not count."""
    base = scratch_path(spark, "prices_1d")
    P.write_bars(stored_until(spark, folder), base, "1d", BY_BUCKET)
    P.upsert_bars(spark, base, corrections(spark, folder), "1d", BY_BUCKET, ntz=True)
    return store_stats(spark, base).select("year", "month", "rows", "first_timestamp", "last_timestamp")
