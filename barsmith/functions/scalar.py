"""Column expressions: parsing, formats, signals. All stay in the JVM."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def parse_symbols(text: Column) -> Column:
    """Comma-separated text to an array of trimmed, non-blank symbols."""
    parts = F.transform(F.split(text, ","), lambda s: F.trim(s))
    return F.filter(parts, lambda s: s != "")


def parse_utc(text: Column, zone: str | None = None) -> Column:
    """Timestamp of ISO text. An offset in the text wins over `zone` (UTC if none)."""
    parsed = F.try_to_timestamp(text)
    if zone is None:
        return parsed
    offset = F.rlike(text, F.lit(r"\d{2}:\d{2}.*(Z|[+-]\d{2}(:?\d{2})?)$"))
    return F.when(offset, parsed).otherwise(F.to_utc_timestamp(parsed, zone))


def iso_utc(stamp: Column) -> Column:
    """ISO-8601 with the offset written out, e.g. 2025-10-07T15:30:00+00:00."""
    return F.date_format(stamp.cast("timestamp"), "yyyy-MM-dd'T'HH:mm:ssxxx")


def format_compact(value: Column, decimals: int = 2) -> Column:
    """1.2B, 3.4M, 5.6K; smaller numbers with fixed decimals."""

    def scaled(unit: float, suffix: str) -> Column:
        return F.format_string(f"%.1f{suffix}", value / F.lit(unit))

    return (
        F.when(value.isNull(), F.lit(None))
        .when(value >= 1e9, scaled(1e9, "B"))
        .when(value >= 1e6, scaled(1e6, "M"))
        .when(value >= 1e3, scaled(1e3, "K"))
        .otherwise(F.format_string(f"%.{decimals}f", value))
    )


def format_usd(value: Column) -> Column:
    """$1,234.50; the sign of a negative amount stands before the dollar."""
    amount = F.concat(F.lit("$"), F.format_number(F.abs(value), 2))
    return F.when(value < 0, F.concat(F.lit("-"), amount)).otherwise(amount)


def format_pct(value: Column) -> Column:
    """Signed percent with two decimals; zero counts as positive."""
    return F.when(value.isNotNull(), F.format_string("%+.2f%%", value))


def signal(p: Column, buy: float = 0.6, sell: float = 0.4) -> Column:
    """buy at or above one threshold, sell at or below the other, else hold."""
    return F.when(p >= buy, "buy").when(p <= sell, "sell").otherwise("hold")


def signal_strict(p: Column, buy: float = 0.7, sell: float = 0.3) -> Column:
    """The documented rule: strictly above 0.7 buys, strictly below 0.3 sells."""
    return F.when(p > buy, "buy").when(p < sell, "sell").otherwise("hold")


def confidence(p: Column) -> Column:
    """high outside [0.3, 0.7], medium from 0.6 up or 0.4 down, else low."""
    return (
        F.when((p > 0.7) | (p < 0.3), "high")
        .when((p >= 0.6) | (p <= 0.4), "medium")
        .otherwise("low")
    )


def sigmoid(z: Column) -> Column:
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-z))
