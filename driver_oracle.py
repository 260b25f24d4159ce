"""SQL twins of the registered queries, for DuckDB on the same tables."""

from __future__ import annotations

# Daily bars per brand from order lines; the row value ranks a day's trades.
DAILY = """
    trade AS (
        SELECT p_brand AS symbol, l_shipdate AS ts, l_extendedprice / l_quantity AS price,
               l_quantity AS size,
               row(l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_quantity) AS k
        FROM lineitem JOIN part ON l_partkey = p_partkey),
    daily AS (
        SELECT CAST(date_trunc('day', ts) AS TIMESTAMP) AS "timestamp",
               arg_min(price, k) AS open, max(price) AS high, min(price) AS low,
               arg_max(price, k) AS close, CAST(sum(size) AS DOUBLE) AS volume,
               symbol, '1d' AS "interval"
        FROM trade GROUP BY symbol, date_trunc('day', ts))
"""
# Hourly bars per event type.
HOURLY = """
    hourly AS (
        SELECT CAST(date_trunc('hour', ts) AS TIMESTAMP) AS "timestamp",
               arg_min(value, ts) AS open, max(value) AS high, min(value) AS low,
               arg_max(value, ts) AS close, CAST(count(*) AS DOUBLE) AS volume,
               event_type AS symbol, '1h' AS "interval"
        FROM events GROUP BY event_type, date_trunc('hour', ts))
"""
RESAMPLED = """
    resampled AS (
        SELECT CAST(date_trunc('day', "timestamp") AS TIMESTAMP) AS "timestamp",
               arg_min(open, "timestamp") AS open, max(high) AS high, min(low) AS low,
               arg_max(close, "timestamp") AS close, sum(volume) AS volume,
               symbol, '1d' AS "interval"
        FROM hourly GROUP BY symbol, date_trunc('day', "timestamp"))
"""
UPSERT = """
    stored AS (SELECT * FROM daily WHERE "timestamp" <= TIMESTAMP '2001-10-01'),
    batch AS (
        SELECT * REPLACE (close * 1.01::DOUBLE AS close) FROM daily
        WHERE "timestamp" > TIMESTAMP '2001-09-24')
"""
MERGED = """
    merged AS (
        SELECT * FROM batch
        UNION ALL
        SELECT * FROM stored
        WHERE NOT EXISTS (SELECT 1 FROM batch
                          WHERE batch.symbol = stored.symbol AND batch."timestamp" = stored."timestamp"))
"""
UNIVERSE = """
    universe AS (
        SELECT p_brand AS symbol FROM part GROUP BY p_brand
        HAVING count(*) >= (SELECT count(*) / count(DISTINCT p_brand) FROM part))
"""
FEATURES = """
    step AS (
        SELECT *,
               close / nullif(lag(close, 1) OVER w, 0) - 1 AS ret1,
               close / nullif(lag(close, 5) OVER w, 0) - 1 AS ret5,
               close / nullif(lag(close, 10) OVER w, 0) - 1 AS ret10,
               CASE WHEN count(close) OVER w5 = 5 THEN avg(close) OVER w5 END AS sma5,
               CASE WHEN count(close) OVER w10 = 10 THEN avg(close) OVER w10 END AS sma10,
               CASE WHEN count(close) OVER w20 = 20 THEN avg(close) OVER w20 END AS sma20
        FROM daily
        WINDOW w AS (PARTITION BY symbol ORDER BY "timestamp"),
               w5 AS (PARTITION BY symbol ORDER BY "timestamp" ROWS 4 PRECEDING),
               w10 AS (PARTITION BY symbol ORDER BY "timestamp" ROWS 9 PRECEDING),
               w20 AS (PARTITION BY symbol ORDER BY "timestamp" ROWS 19 PRECEDING)),
    rolled AS (
        SELECT *,
               close / nullif(sma5, 0) - 1 AS dist_sma5,
               close / nullif(sma10, 0) - 1 AS dist_sma10,
               close / nullif(sma20, 0) - 1 AS dist_sma20,
               CASE WHEN count(ret1) OVER w10 = 10 THEN stddev_samp(ret1) OVER w10 END AS vol10
        FROM step
        WINDOW w10 AS (PARTITION BY symbol ORDER BY "timestamp" ROWS 9 PRECEDING)),
    feature AS (
        SELECT * FROM rolled
        WHERE ret1 IS NOT NULL AND ret5 IS NOT NULL AND ret10 IS NOT NULL
          AND dist_sma20 IS NOT NULL AND dist_sma10 IS NOT NULL AND dist_sma5 IS NOT NULL
          AND vol10 IS NOT NULL)
"""
LABELS = """
    ahead AS (
        SELECT *, lead(close) OVER (PARTITION BY symbol ORDER BY "timestamp") AS close_t1 FROM feature),
    labelled AS (
        SELECT *, CAST(close_t1 > close AS INTEGER) AS label FROM ahead WHERE close_t1 IS NOT NULL)
"""
MODELS = """
    brand AS (
        SELECT DISTINCT p_brand AS symbol, CAST(replace(p_brand, 'Brand#', '') AS INTEGER) AS k FROM part),
    model AS (
        SELECT symbol, (k % 5 - 2) / 10.0::DOUBLE AS intercept,
               [((k * i) % 7 - 3) / 10.0::DOUBLE FOR i IN [1, 2, 3, 4, 5, 6, 7]] AS coef
        FROM brand WHERE k <= 20)
"""


def probability(rows: str) -> str:
    return f"""
        SELECT r.*, 1 / (1 + exp(-(intercept + coef[1] * ret1 + coef[2] * ret5 + coef[3] * ret10
               + coef[4] * dist_sma5 + coef[5] * dist_sma10 + coef[6] * dist_sma20
               + coef[7] * vol10))) AS p
        FROM {rows} r LEFT JOIN model USING (symbol)
"""


SIGNAL = "CASE WHEN {p} >= 0.6 THEN 'buy' WHEN {p} <= 0.4 THEN 'sell' ELSE 'hold' END"
SCORED = f"""
    probable AS ({probability("labelled")}),
    scored AS (
        SELECT *, coalesce(p, 0.5) AS prob_up, {SIGNAL.format(p="coalesce(p, 0.5)")} AS signal,
               CASE WHEN p IS NULL THEN 'no_model' ELSE 'ok' END AS status
        FROM probable)
"""


def rounded(value: str, digits: int = 6) -> str:
    """Rounded as the queries do it, in decimals: ties go away from zero."""
    return f"CAST(CAST(CAST({value} AS DECIMAL(30, {digits + 3})) AS DECIMAL(30, {digits})) AS DOUBLE)"


ALL_FEATURES = ", ".join(
    f"{rounded(c)} AS {c}"
    for c in ["ret1", "ret5", "ret10", "sma5", "sma10", "sma20", "dist_sma5", "dist_sma10", "dist_sma20", "vol10"]
)
BAR = '"timestamp", open, high, low, close, volume, symbol, "interval"'

F = [DAILY, FEATURES]
L = [DAILY, FEATURES, LABELS]
S = [DAILY, FEATURES, LABELS, MODELS, SCORED]


def sql(parts: list[str], body: str) -> str:
    return "WITH " + ",".join(parts) + body


ALL_DAILY = sql([DAILY], f"SELECT {BAR} FROM daily")
ALL_HOURLY = sql([HOURLY], f"SELECT {BAR} FROM hourly")
ALL_MERGED = sql([DAILY, UPSERT, MERGED], f"SELECT {BAR} FROM merged")
ALL_LABELS = sql(
    L, f'SELECT {BAR}, {ALL_FEATURES}, close_t1, label FROM labelled'
)
NEWEST = 'row_number() OVER (PARTITION BY symbol ORDER BY "timestamp" DESC)'
TILES = sql(
    L,
    'SELECT symbol, "timestamp", CAST(ntile(6) OVER (PARTITION BY symbol ORDER BY "timestamp") AS INTEGER) AS tile FROM labelled',
)


def split(days: int) -> str:
    return f"""
    edge AS (SELECT symbol, max("timestamp") - INTERVAL {days} DAY AS cutoff FROM labelled GROUP BY symbol),
    split AS (
        SELECT labelled.*, CASE WHEN "timestamp" <= cutoff THEN 'train' ELSE 'test' END AS split
        FROM labelled JOIN edge USING (symbol))
"""


BOTH = "symbol IN (SELECT symbol FROM split GROUP BY symbol HAVING count(DISTINCT split) = 2)"


def rolling(columns: str, frames: str = "", digits: int = 6) -> str:
    return sql([DAILY], f'SELECT symbol, "timestamp", {columns} FROM daily WINDOW w AS (PARTITION BY symbol ORDER BY "timestamp"){frames}')


def frame(n: int) -> str:
    return f', w{n} AS (PARTITION BY symbol ORDER BY "timestamp" ROWS {n - 1} PRECEDING)'


def full(aggregate: str, n: int) -> str:
    return f"CASE WHEN count(close) OVER w{n} = {n} THEN {aggregate}(close) OVER w{n} END"


FRAMES = frame(5) + frame(10) + frame(20)
RECENT = """
    recent AS (
        SELECT * FROM daily WHERE "timestamp" >= TIMESTAMP '2001-11-04' - INTERVAL 12 MONTH),
    enough AS (
        SELECT * FROM recent WHERE symbol IN (SELECT symbol FROM recent GROUP BY symbol HAVING count(*) >= 200))
"""


def bands() -> str:
    return sql(
        [DAILY],
        f"""SELECT symbol, "timestamp", close, {full("avg", 20)} AS mid, {full("stddev_pop", 20)} AS dev
        FROM daily WINDOW w20 AS (PARTITION BY symbol ORDER BY "timestamp" ROWS 19 PRECEDING)""",
    )


def usd(value: str) -> str:
    return f"CASE WHEN {value} < 0 THEN '-' ELSE '' END || '$' || format('{{:,.2f}}', abs({value}))"


def compact(value: str) -> str:
    def scaled(unit: str, suffix: str) -> str:
        # Half up, as the display rule has it; printf alone rounds ties to even.
        return f"printf('%.1f{suffix}', floor({value} / {unit} * 10 + 0.5) / 10)"

    return f"""CASE WHEN {value} >= 1e9 THEN {scaled("1e9", "B")} WHEN {value} >= 1e6 THEN {scaled("1e6", "M")}
        WHEN {value} >= 1e3 THEN {scaled("1e3", "K")} ELSE printf('%.2f', {value}) END"""


def percent(value: str) -> str:
    return f"printf('%+.2f%%', {value})"


SUMMARY = f"""
    shown AS (SELECT *, {NEWEST} AS n FROM daily QUALIFY n <= 120),
    summary AS (
        SELECT symbol, count(*) AS bars, max(close) FILTER (n = 1) AS last_price,
               coalesce(max(close) FILTER (n = 2), max(close) FILTER (n = 1)) AS before,
               sum(coalesce(volume, 0)) AS total_volume
        FROM shown GROUP BY symbol),
    changed AS (
        SELECT *, coalesce((last_price - before) / nullif(before, 0) * 100, 0) AS change_pct FROM summary)
"""

SQL = {
    "raw_scan_daily": ALL_DAILY,
    "raw_scan_hourly": ALL_HOURLY,
    "store_scan": ALL_DAILY,
    "store_scan_pruned": sql(
        [DAILY],
        f"""SELECT {BAR} FROM daily WHERE symbol IN ('Brand#3', 'Brand#14')
        AND "timestamp" >= TIMESTAMP '1998-02-10' AND "timestamp" < TIMESTAMP '2000-06-15'""",
    ),
    "recent_bars": sql([DAILY, RECENT], f"SELECT {BAR} FROM recent"),
    "read_latest": sql([DAILY], f"SELECT {BAR} FROM daily QUALIFY {NEWEST} <= 120"),
    "touched_partitions": sql(
        [DAILY, UPSERT],
        """SELECT DISTINCT "interval", symbol, CAST(year("timestamp") AS INTEGER) AS year,
        CAST(month("timestamp") AS INTEGER) AS month FROM batch""",
    ),
    "touched_rows": sql(
        [DAILY, UPSERT],
        f"""SELECT {BAR} FROM daily WHERE EXISTS (
            SELECT 1 FROM batch WHERE batch.symbol = daily.symbol
            AND date_trunc('month', batch."timestamp") = date_trunc('month', daily."timestamp"))""",
    ),
    "fallback_source": sql(
        [DAILY, HOURLY, RESAMPLED],
        f"SELECT {BAR} FROM resampled UNION ALL SELECT {BAR} FROM daily",
    ),
    "write_read_daily": ALL_DAILY,
    "write_read_hourly": ALL_HOURLY,
    "upsert": ALL_MERGED,
    "stream_upsert": ALL_MERGED,
    "ingest_update": sql(
        [DAILY,
         UPSERT.replace("batch AS", "landed AS") + """,
    batch AS (
        SELECT * FROM landed QUALIFY dense_rank() OVER (
            PARTITION BY symbol ORDER BY CAST("timestamp" AS DATE) DESC) <= 2)""",
         MERGED],
        f"SELECT {BAR} FROM merged",
    ),
    "ingest_backfill": sql(
        [DAILY],
        f"""SELECT {BAR} FROM daily WHERE "timestamp" >= TIMESTAMP '2001-11-04' - INTERVAL 2 YEAR""",
    ),
    "dry_run": sql([DAILY, UPSERT], "SELECT symbol, count(*) AS rows FROM batch GROUP BY symbol"),
    "write_summary": sql(
        [DAILY],
        """SELECT symbol, count(*) AS rows, count(DISTINCT date_trunc('month', "timestamp")) AS files
        FROM daily GROUP BY symbol""",
    ),
    "retention": sql(
        [DAILY],
        f"""SELECT {BAR} FROM daily WHERE "timestamp" >= TIMESTAMP '2001-11-04' - INTERVAL 365 DAY""",
    ),
    "expire_store": sql(
        [DAILY],
        f"""SELECT {BAR} FROM daily
        WHERE "timestamp" >= date_trunc('month', TIMESTAMP '2001-11-04' - INTERVAL 365 DAY)""",
    ),
    "models_roundtrip": sql(
        [MODELS],
        """SELECT symbol, intercept, CAST(i - 1 AS INTEGER) AS position, coef[i] AS coef
        FROM model, (SELECT unnest([1, 2, 3, 4, 5, 6, 7]) AS i)""",
    ),
    "normalize_raw": ALL_DAILY,
    "wide_to_long": ALL_DAILY,
    "to_utc": """SELECT event_id, CAST(date_trunc('second', ts) AS TIMESTAMP) AS naive,
        CAST(date_trunc('second', ts) - INTERVAL 2 HOUR AS TIMESTAMP) AS aware FROM events""",
    "partition_columns": sql(
        [HOURLY],
        """SELECT symbol, "timestamp", CAST(year("timestamp") AS INTEGER) AS year,
        CAST(month("timestamp") AS INTEGER) AS month, CAST(day("timestamp") AS INTEGER) AS day FROM hourly""",
    ),
    "candles": sql(
        [HOURLY],
        """SELECT symbol, "interval", strftime("timestamp", '%Y-%m-%dT%H:%M:%S') || '+00:00' AS "timestamp",
        open, high, low, close, volume FROM hourly""",
    ),
    "recent_files": sql([DAILY, UPSERT], f"SELECT {BAR} FROM batch"),
    "latest_nested": sql(
        [HOURLY],
        f"""SELECT symbol, "interval", strftime("timestamp", '%Y-%m-%dT%H:%M:%S') || '+00:00' AS "timestamp",
        open, high, low, close, volume,
        CAST(row_number() OVER (PARTITION BY symbol ORDER BY "timestamp") - 1 AS INTEGER) AS position
        FROM (SELECT * FROM hourly QUALIFY {NEWEST} <= 120)""",
    ),
    "feature_array": sql(
        L,
        f"""SELECT symbol, "timestamp", CAST(i - 1 AS INTEGER) AS position, {rounded("inputs[i]")} AS value
        FROM (SELECT *, [ret1, ret5, ret10, dist_sma5, dist_sma10, dist_sma20, vol10] AS inputs FROM labelled),
             (SELECT unnest([1, 2, 3, 4, 5, 6, 7]) AS i)""",
    ),
    "latest_response": sql(
        [DAILY, HOURLY, RESAMPLED, UNIVERSE],
        f"""SELECT symbol, '1d' AS "interval", NULL::VARCHAR AS error,
        strftime("timestamp", '%Y-%m-%dT%H:%M:%S') || '+00:00' AS "timestamp", open, high, low, close, volume
        FROM (SELECT * FROM resampled
              UNION ALL SELECT * FROM daily WHERE symbol IN (SELECT symbol FROM universe))
        QUALIFY {NEWEST} <= 20
        UNION ALL
        SELECT DISTINCT symbol, '1d', 'symbol not allowed', NULL, NULL::DOUBLE, NULL::DOUBLE, NULL::DOUBLE,
               NULL::DOUBLE, NULL::DOUBLE
        FROM daily WHERE symbol NOT IN (SELECT symbol FROM universe)""",
    ),
    "parse_symbols": """SELECT trim(s) AS symbol, count(*) AS requests FROM (
        SELECT unnest(string_split(p_brand || ' ,, ' || p_type || ' ,,  ', ',')) AS s FROM part)
        WHERE trim(s) <> '' GROUP BY trim(s)""",
    "allow_symbols": sql(
        [DAILY, UNIVERSE], f"SELECT {BAR} FROM daily WHERE symbol IN (SELECT symbol FROM universe)"
    ),
    "reject_symbols": sql(
        [DAILY, HOURLY, RESAMPLED, UNIVERSE],
        """SELECT symbol, count(*) AS requests, 'symbol not allowed' AS error
        FROM (SELECT symbol FROM daily UNION ALL SELECT symbol FROM resampled)
        WHERE symbol NOT IN (SELECT symbol FROM universe) GROUP BY symbol""",
    ),
    "last_months": sql([DAILY, RECENT], f"SELECT {BAR} FROM recent"),
    "last_hours": sql(
        [HOURLY],
        f"""SELECT {BAR} FROM hourly JOIN (
            SELECT symbol, max("timestamp") AS newest FROM hourly GROUP BY symbol) USING (symbol)
        WHERE "timestamp" > newest - INTERVAL 12 HOUR""",
    ),
    "last_period_days": sql(
        [HOURLY],
        f"""SELECT {BAR} FROM hourly QUALIFY dense_rank() OVER (
            PARTITION BY symbol ORDER BY CAST("timestamp" AS DATE) DESC) <= 5""",
    ),
    "last_period_months": sql(
        [DAILY],
        f"""SELECT {BAR} FROM daily WHERE "timestamp" >= TIMESTAMP '2001-11-04' - INTERVAL 6 MONTH""",
    ),
    "min_history": sql([DAILY, RECENT], f"SELECT {BAR} FROM enough"),
    "drop_incomplete": sql(
        [DAILY],
        f"""SELECT {BAR}, lead(close) OVER (PARTITION BY symbol ORDER BY "timestamp") AS close_t1
        FROM daily QUALIFY close_t1 IS NOT NULL""",
    ),
    "time_split": sql(L + [split(90)], 'SELECT symbol, "timestamp", split FROM split'),
    "require_both_splits": sql(
        L + [split(2455)], f'SELECT symbol, "timestamp", split FROM split WHERE {BOTH}'
    ),
    "symbol_filter": sql(
        [DAILY], f"""SELECT {BAR} FROM daily WHERE symbol = 'Brand#13' AND "interval" = '1d'"""
    ),
    "latest_n": sql([DAILY], f"SELECT {BAR} FROM daily QUALIFY {NEWEST} <= 120"),
    "latest_features": sql(
        F, f'SELECT symbol, "timestamp", {ALL_FEATURES} FROM (SELECT * FROM feature QUALIFY {NEWEST} = 1)'
    ),
    "data_range": sql(
        [HOURLY],
        """SELECT symbol, count(*) AS rows, min("timestamp") AS first_timestamp,
        max("timestamp") AS last_timestamp FROM hourly GROUP BY symbol""",
    ),
    "max_timestamp": sql(
        [DAILY], 'SELECT symbol, max("timestamp") AS max_timestamp FROM daily GROUP BY symbol'
    ),
    "hourly_bars": ALL_HOURLY,
    "stream_hourly_bars": ALL_HOURLY,
    "daily_bars": ALL_DAILY,
    "resample_daily": sql([HOURLY, RESAMPLED], f"SELECT {BAR} FROM resampled"),
    "union_bars": sql(
        [DAILY, UPSERT],
        f"""SELECT {BAR}, CAST(0 AS BIGINT) AS ingest_seq FROM stored
        UNION ALL SELECT {BAR}, CAST(1 AS BIGINT) AS ingest_seq FROM batch""",
    ),
    "dedupe_keep_last": ALL_MERGED,
    "merge_stats": sql(
        [DAILY, UPSERT],
        """SELECT symbol, count(s) AS existing_rows, count(b) AS new_rows,
        count(*) FILTER (s IS NOT NULL AND b IS NOT NULL) AS replaced_rows,
        count(*) FILTER (s IS NULL) AS inserted_rows, count(*) AS merged_rows
        FROM (SELECT symbol, "timestamp", 1 AS s FROM stored) AS o
        FULL JOIN (SELECT symbol, "timestamp", 1 AS b FROM batch) AS n USING (symbol, "timestamp")
        GROUP BY symbol""",
    ),
    "returns": rolling(
        ", ".join(f"CAST(CAST(CAST(close / nullif(lag(close, {n}) OVER w, 0) - 1 AS DECIMAL(30, 9)) AS DECIMAL(30, 6)) AS DOUBLE) AS ret{n}" for n in (1, 5, 10))
    ),
    "sma": rolling(", ".join(f"{rounded(full('avg', n))} AS sma{n}" for n in (5, 10, 20)), FRAMES),
    "dist_sma": rolling(
        ", ".join(f"CAST(CAST(CAST(close / nullif({full('avg', n)}, 0) - 1 AS DECIMAL(30, 9)) AS DECIMAL(30, 6)) AS DOUBLE) AS dist_sma{n}" for n in (5, 10, 20)),
        FRAMES,
    ),
    "volatility": sql(
        [DAILY, FEATURES], 'SELECT symbol, "timestamp", CAST(CAST(CAST(vol10 AS DECIMAL(30, 9)) AS DECIMAL(30, 6)) AS DOUBLE) AS vol10 FROM rolled'
    ),
    "features": sql(F, f"SELECT {BAR}, {ALL_FEATURES} FROM feature"),
    "next_close": rolling("close, lead(close) OVER w AS close_t1"),
    "labels": ALL_LABELS,
    "features_split_series": ALL_LABELS,
    "rsi": sql(
        [DAILY],
        """SELECT symbol, "timestamp", CAST(CAST(CAST(100 * up / nullif(up + down, 0) AS DECIMAL(30, 9)) AS DECIMAL(30, 6)) AS DOUBLE) AS rsi FROM (
            SELECT symbol, "timestamp",
                   CASE WHEN count(move) OVER w14 = 14 THEN avg(greatest(move, 0)) OVER w14 END AS up,
                   CASE WHEN count(move) OVER w14 = 14 THEN avg(greatest(-move, 0)) OVER w14 END AS down
            FROM (SELECT symbol, "timestamp",
                         close - lag(close) OVER (PARTITION BY symbol ORDER BY "timestamp") AS move FROM daily)
            WINDOW w14 AS (PARTITION BY symbol ORDER BY "timestamp" ROWS 13 PRECEDING))""",
    ),
    "bollinger": f"""SELECT symbol, "timestamp", CAST(CAST(CAST(mid AS DECIMAL(30, 7)) AS DECIMAL(30, 4)) AS DOUBLE) AS bb_middle,
        CAST(CAST(CAST(mid + 2 * dev AS DECIMAL(30, 7)) AS DECIMAL(30, 4)) AS DOUBLE) AS bb_upper, CAST(CAST(CAST(mid - 2 * dev AS DECIMAL(30, 7)) AS DECIMAL(30, 4)) AS DOUBLE) AS bb_lower FROM ({bands()})""",
    "price_position": f"""SELECT symbol, "timestamp",
        CAST(CAST(CAST((close - (mid - 2 * dev)) / nullif((mid + 2 * dev) - (mid - 2 * dev), 0) AS DECIMAL(30, 9)) AS DECIMAL(30, 6)) AS DOUBLE) AS price_position
        FROM ({bands()})""",
    "volume_profile": sql(
        [DAILY],
        """SELECT symbol, bucket, CAST(CAST(CAST(lo + bucket * width AS DECIMAL(30, 9)) AS DECIMAL(30, 6)) AS DOUBLE) AS price_from, sum(volume) AS volume, count(*) AS bars
        FROM (SELECT symbol, lo, width, volume,
                     CAST(least(floor(coalesce((close - lo) / nullif(width, 0), 0)), 9) AS INTEGER) AS bucket
              FROM daily JOIN (SELECT symbol, min(close) AS lo, (max(close) - min(close)) / 10 AS width
                               FROM daily GROUP BY symbol) USING (symbol))
        GROUP BY symbol, bucket, lo, width""",
    ),
    "momentum": rolling("CAST(CAST(CAST(close / nullif(lag(close, 12) OVER w, 0) - 1 AS DECIMAL(30, 9)) AS DECIMAL(30, 6)) AS DOUBLE) AS momentum12"),
    "train_models_optimal": sql(
        L,
        """SELECT symbol, count(*) AS n_train,
        CASE WHEN min(label) = max(label) THEN 'single_class' ELSE 'ok' END AS status,
        CASE WHEN min(label) < max(label) THEN 0.0::DOUBLE END AS gradient,
        CASE WHEN min(label) < max(label) THEN 0.0::DOUBLE END AS gap
        FROM labelled GROUP BY symbol""",
    ),
    "predict_proba_fixed": sql(S, 'SELECT symbol, "timestamp", CAST(CAST(CAST(p AS DECIMAL(30, 9)) AS DECIMAL(30, 6)) AS DOUBLE) AS prob_up FROM scored'),
    "predict_class": sql(S, 'SELECT symbol, "timestamp", CAST(p > 0.5 AS INTEGER) AS predicted FROM scored'),
    "predict_default": sql(
        S, 'SELECT symbol, "timestamp", CAST(CAST(CAST(prob_up AS DECIMAL(30, 9)) AS DECIMAL(30, 6)) AS DOUBLE) AS prob_up, signal, status FROM scored'
    ),
    "signals": sql(S, 'SELECT symbol, "timestamp", signal FROM scored'),
    "signals_doc": sql(
        S,
        """SELECT symbol, "timestamp",
        CASE WHEN prob_up > 0.7 THEN 'buy' WHEN prob_up < 0.3 THEN 'sell' ELSE 'hold' END AS signal FROM scored""",
    ),
    "confidence": sql(
        S,
        """SELECT symbol, "timestamp", CASE WHEN prob_up > 0.7 OR prob_up < 0.3 THEN 'high'
        WHEN prob_up >= 0.6 OR prob_up <= 0.4 THEN 'medium' ELSE 'low' END AS confidence FROM scored""",
    ),
    "eval_metrics": sql(
        S,
        """SELECT symbol, CAST(CAST(CAST(avg(CAST(said = label AS INTEGER)) AS DECIMAL(30, 9)) AS DECIMAL(30, 6)) AS DOUBLE) AS accuracy,
        CAST(CAST(CAST(coalesce(2.0 * sum(said * label) / nullif(sum(said) + sum(label), 0), 0) AS DECIMAL(30, 9)) AS DECIMAL(30, 6)) AS DOUBLE) AS f1,
        count(*) AS n_test
        FROM (SELECT symbol, label, CAST(p > 0.5 AS INTEGER) AS said FROM scored WHERE p IS NOT NULL)
        GROUP BY symbol""",
    ),
    "score_latest": sql(
        [
            """recent_trade AS (SELECT 1)""",
            DAILY.replace("daily AS", "every AS"),
            """daily AS (SELECT * FROM every WHERE "timestamp" >= TIMESTAMP '2001-11-04' - INTERVAL 2 MONTH)""",
            FEATURES,
            MODELS,
            f"newest AS (SELECT * FROM feature QUALIFY {NEWEST} = 1)",
            f"probable AS ({probability('newest')})",
        ],
        f"""SELECT d.symbol, CAST(CAST(CAST(coalesce(p, 0.5) AS DECIMAL(30, 9)) AS DECIMAL(30, 6)) AS DOUBLE) AS prob_up,
        {SIGNAL.format(p="coalesce(p, 0.5)")} AS signal, '2001-11-04T00:00:00+00:00' AS asof,
        CASE WHEN p IS NOT NULL THEN 'ok' WHEN model.symbol IS NULL THEN 'no_model'
             ELSE 'insufficient_history' END AS status
        FROM (SELECT DISTINCT symbol FROM daily) AS d
        LEFT JOIN probable USING (symbol) LEFT JOIN model USING (symbol)""",
    ),
    "training_split": sql(
        [DAILY.replace("daily AS", "every AS"), RECENT.replace("FROM daily", "FROM every"),
         "daily AS (SELECT * FROM enough)", FEATURES, LABELS, split(90)],
        f'SELECT symbol, "timestamp", label, split FROM split WHERE {BOTH}',
    ),
    "cv_folds": TILES,
    "cv_folds_split_series": TILES,
    "market_summary": sql(
        [DAILY, SUMMARY],
        """SELECT symbol, bars, last_price, CAST(CAST(CAST(change_pct AS DECIMAL(30, 9)) AS DECIMAL(30, 6)) AS DOUBLE) AS change_pct, total_volume FROM changed""",
    ),
    "price_card": sql(
        [DAILY, SUMMARY],
        f"""SELECT symbol, {usd("last_price")} AS price, {percent("change_pct")} AS change,
        {compact("total_volume")} AS volume FROM changed""",
    ),
    "signal_card": sql(
        S,
        f"""SELECT symbol, upper(signal) AS signal,
        printf('%d%%', CAST(floor(prob_up * 100 + 0.5) AS BIGINT)) AS confidence,
        printf('%.1f%%', prob_up * 100) AS confidence_detail,
        signal = 'buy' OR prob_up * 100 > 60 AS positive
        FROM (SELECT * FROM scored QUALIFY {NEWEST} = 1)""",
    ),
    "format_compact": sql(
        [DAILY], f'SELECT symbol, "timestamp", {compact("close * volume")} AS turnover FROM daily'
    ),
    "format_usd": sql([DAILY], f'SELECT symbol, "timestamp", {usd("(close - open)")} AS moved FROM daily'),
    "format_pct": sql(
        [DAILY], f'SELECT symbol, "timestamp", {percent("(close - open) / open * 100")} AS moved FROM daily'
    ),
    "sql_latest": sql(
        [DAILY], f'SELECT symbol, "timestamp", close, volume FROM daily QUALIFY {NEWEST} <= 5'
    ),
}


def past(name: str) -> str:
    """A twin as of an earlier day, with no trade after it."""
    cut = "FROM trade WHERE ts <= TIMESTAMP '1999-06-15' GROUP BY symbol"
    return SQL[name].replace("2001-11-04", "1999-06-15").replace("FROM trade GROUP BY symbol", cut)


SQL |= {f"{name}_past": past(name) for name in ("last_months", "recent_bars", "score_latest", "training_split")}
SQL |= {
    "upsert_after_crash": ALL_MERGED,
    "rejected_bars": sql(
        [DAILY],
        """SELECT symbol, CASE WHEN day("timestamp") = 13 THEN 'unreadable price'
            ELSE 'no time, symbol or interval' END AS reason, count(*) AS bars
        FROM daily WHERE day("timestamp") IN (13, 14) GROUP BY ALL""",
    ),
    "ingest_backfill_hourly": sql(
        [HOURLY],
        f"""SELECT {BAR} FROM hourly QUALIFY dense_rank() OVER (
            PARTITION BY symbol ORDER BY CAST("timestamp" AS DATE) DESC) <= 30""",
    ),
    "ingest_update_hourly": sql(
        [HOURLY],
        f"""SELECT {BAR} FROM hourly JOIN (
            SELECT symbol, max("timestamp") AS newest FROM hourly GROUP BY symbol) USING (symbol)
        WHERE "timestamp" > newest - INTERVAL 12 HOUR AND CAST("timestamp" AS DATE) = CAST(newest AS DATE)""",
    ),
    "latest_n_of_both_intervals": sql(
        [HOURLY, RESAMPLED],
        f"""SELECT {BAR} FROM (SELECT * FROM hourly UNION ALL SELECT * FROM resampled)
        QUALIFY row_number() OVER (PARTITION BY symbol, "interval" ORDER BY "timestamp" DESC) <= 4""",
    ),
}
SQL |= {name: ALL_DAILY for name in ("two_level_columns", "lower_columns", "required_columns", "corrupt_files", "missing_sources")}
SQL |= {
    "broken_predictions": sql(S, 'SELECT symbol, "timestamp" FROM scored WHERE day("timestamp") IN (13, 14)'),
    "repeated_batch": ALL_MERGED,
    "rebuilt_bars": ALL_HOURLY,
    "stored_response": sql(
        [DAILY, UNIVERSE],
        f"""SELECT symbol, '1d' AS "interval", NULL::VARCHAR AS error,
        strftime("timestamp", '%Y-%m-%dT%H:%M:%S') || '+00:00' AS "timestamp", open, high, low, close, volume
        FROM daily WHERE symbol IN (SELECT symbol FROM universe) QUALIFY {NEWEST} <= 20
        UNION ALL
        SELECT DISTINCT symbol, '1d', 'symbol not allowed', NULL, NULL::DOUBLE, NULL::DOUBLE, NULL::DOUBLE,
               NULL::DOUBLE, NULL::DOUBLE
        FROM daily WHERE symbol NOT IN (SELECT symbol FROM universe)""",
    ),
    "sql_month": sql(
        [DAILY],
        """SELECT symbol, "timestamp", close FROM daily
        WHERE "timestamp" >= TIMESTAMP '2000-03-01' AND "timestamp" < TIMESTAMP '2000-04-01'""",
    ),
}


def facts(keys: str, train: str, test: str) -> str:
    """Counts and status of models trained on some rows and tested on others."""
    one_class = f"min(label) FILTER ({train}) = max(label) FILTER ({train})"
    return f"""{keys}, count(*) FILTER ({train}) AS n_train,
        CASE WHEN {one_class} THEN NULL ELSE nullif(count(*) FILTER ({test}), 0) END AS n_test,
        CASE WHEN {one_class} THEN 'single_class' ELSE 'ok' END AS status,
        CASE WHEN NOT {one_class} AND count(*) FILTER ({test}) > 0 THEN true END AS "within" """


SQL |= {
    "training_report_facts": SQL["training_split"].replace(
        'SELECT symbol, "timestamp", label, split FROM split',
        f"""SELECT {facts("symbol, 'models/symbol=' || symbol AS model_path", "split = 'train'", "split = 'test'")} FROM split""",
    ) + " GROUP BY symbol",
    "cv_report_facts": sql(
        [*L, """
    tiled AS (SELECT symbol, label, ntile(6) OVER (PARTITION BY symbol ORDER BY "timestamp") AS tile FROM labelled)"""],
        f"""SELECT {facts("symbol, CAST(fold AS INTEGER) AS fold", "tile <= fold", "tile = fold + 1")}
        FROM tiled, range(1, 6) AS f(fold) GROUP BY symbol, fold HAVING n_train > 0""",
    ),
    "score_latest_trained_facts": sql(
        [DAILY.replace("daily AS", "every AS"), "daily AS (SELECT * FROM every)", FEATURES, LABELS,
         "model AS (SELECT symbol FROM labelled GROUP BY symbol HAVING min(label) < max(label))",
         """recent AS (SELECT symbol, count(*) AS bars FROM every
            WHERE "timestamp" >= TIMESTAMP '2001-11-04' - INTERVAL 2 MONTH GROUP BY symbol)"""],
        """SELECT r.symbol, '2001-11-04T00:00:00+00:00' AS asof, true AS "within",
        CASE WHEN m.symbol IS NULL THEN 'no_model' WHEN bars < 20 THEN 'insufficient_history' ELSE 'ok' END AS status
        FROM recent AS r LEFT JOIN model AS m USING (symbol)""",
    ),
}
SQL["evaluate_facts"] = sql(
    [*L, split(90)],
    f"""SELECT symbol, count(*) FILTER (split = 'test') AS n_test, true AS "within" FROM split WHERE {BOTH}
    GROUP BY symbol HAVING min(label) FILTER (split = 'train') < max(label) FILTER (split = 'train')""",
)

VERSIONS = """
    version AS (
        SELECT symbol, make_timestamp(y, 7, 1, 0, 0, 0.0) AS trained_asof,
               intercept + (y - 1997) / 10.0::DOUBLE AS intercept, coef
        FROM model, range(1996, 2002) AS years(y))
"""
WILDER = """WITH RECURSIVE """ + DAILY + """,
    numbered AS (
        SELECT symbol, "timestamp", close - lag(close) OVER w AS move, row_number() OVER w - 1 AS n
        FROM daily WINDOW w AS (PARTITION BY symbol ORDER BY "timestamp")),
    moves AS (SELECT symbol, n, greatest(move, 0) AS up, greatest(-move, 0) AS down FROM numbered WHERE n > 0),
    averages AS (
        SELECT symbol, 14::BIGINT AS n, avg(up) AS up, avg(down) AS down FROM moves WHERE n <= 14
        GROUP BY symbol HAVING count(*) = 14
        UNION ALL
        SELECT m.symbol, m.n, a.up + (m.up - a.up) / 14, a.down + (m.down - a.down) / 14
        FROM averages AS a JOIN moves AS m ON m.symbol = a.symbol AND m.n = a.n + 1)
    SELECT symbol, "timestamp", """ + rounded("100 * up / nullif(up + down, 0)") + """ AS rsi_wilder
    FROM numbered LEFT JOIN averages USING (symbol, n)"""
BOTH_INTERVALS = "daily AS (SELECT * FROM hourly UNION ALL SELECT * FROM resampled)"
SQL |= {
    "upsert_while_reading": sql(
        [DAILY, UPSERT, MERGED],
        f"SELECT {BAR}, 'before' AS reader FROM stored UNION ALL SELECT {BAR}, 'after' AS reader FROM merged",
    ),
    "features_after_corrections": sql(
        [DAILY.replace("daily AS", "every AS"), UPSERT.replace("FROM daily", "FROM every"), MERGED,
         "daily AS (SELECT * FROM merged)", FEATURES, LABELS],
        f"SELECT {BAR}, {ALL_FEATURES}, {rounded('close_t1')} AS close_t1 FROM ahead",
    ),
    "stream_late_ticks": ALL_HOURLY,
    "rsi_wilder": WILDER,
    "rsi_wilder_split_series": WILDER,
    "score_asof_trained_versions": sql(
        [*L, MODELS, VERSIONS],
        f"""SELECT r.symbol, r."timestamp", trained_asof,
        {rounded("1 / (1 + exp(-(intercept + coef[1] * ret1 + coef[2] * ret5 + coef[3] * ret10 + coef[4] * dist_sma5 + coef[5] * dist_sma10 + coef[6] * dist_sma20 + coef[7] * vol10)))")} AS prob_up
        FROM labelled AS r ASOF LEFT JOIN version AS v ON r.symbol = v.symbol AND r."timestamp" >= v.trained_asof""",
    ),
    "score_latest_of_versions": SQL["score_latest_past"].replace("AS intercept", "+ 0.1::DOUBLE AS intercept"),
    "volume_profile_of_both_intervals": sql(
        [HOURLY, RESAMPLED, BOTH_INTERVALS],
        f"""SELECT symbol, "interval", bucket, {rounded("lo + bucket * width")} AS price_from, sum(volume) AS volume, count(*) AS bars
        FROM (SELECT symbol, "interval", lo, width, volume,
                     CAST(least(floor(coalesce((close - lo) / nullif(width, 0), 0)), 9) AS INTEGER) AS bucket
              FROM daily JOIN (SELECT symbol, "interval", min(close) AS lo, (max(close) - min(close)) / 10 AS width
                               FROM daily GROUP BY ALL) USING (symbol, "interval"))
        GROUP BY symbol, "interval", bucket, lo, width""",
    ),
    "resample_of_both_intervals": sql([HOURLY, RESAMPLED], f"SELECT {BAR} FROM resampled"),
}
SQL |= {
    "sql_table_after_upsert": ALL_MERGED,
    "sql_table_function": sql(
        [DAILY],
        """SELECT symbol, CAST(year("timestamp") AS INTEGER) AS year, count(*) AS bars, max(high) AS high FROM daily
        WHERE symbol IN ('Brand#3', 'Brand#14') AND "timestamp" >= TIMESTAMP '1998-02-10'
          AND "timestamp" < TIMESTAMP '2000-06-15' GROUP BY ALL""",
    ),
}
SQL |= {
    "wide_text_files": ALL_DAILY,
    "quarantined_files": sql(
        [DAILY],
        """SELECT DISTINCT CAST(year("timestamp") AS INTEGER) AS year, CAST(month("timestamp") AS INTEGER) AS month, 0::INTEGER AS bucket,
        15::BIGINT AS bytes, 'not a Parquet file' AS reason FROM daily""",
    ),
}
RANGE = """CAST(count(*) AS BIGINT) AS "rows", min("timestamp") AS first_timestamp, max("timestamp") AS last_timestamp"""
SQL |= {
    "store_stats_by_symbol": sql([DAILY], f"SELECT symbol, {RANGE}, 0::BIGINT AS unreadable FROM daily GROUP BY symbol"),
    "store_stats_by_month": sql(
        [DAILY],
        f"""SELECT CAST(year("timestamp") AS INTEGER) AS year, CAST(month("timestamp") AS INTEGER) AS month, {RANGE}
        FROM daily GROUP BY ALL""",
    ),
}
