"""Where patterns match in a text, with DataFrame functions only."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """`use(value)`, with the value computed once."""
    return F.element_at(F.transform(F.array(value), use), 1)


def matches(text: Column, pattern: str, group: int = 0) -> Column:
    """An array of (start, end, value, part) of a pattern's matches, from left to right.

    start and end are code points, end exclusive; value is the match, part one of its groups.
    The text is split at the matches, and lengths add up to places.
    """
    found = F.struct(
        F.split(text, pattern, -1).alias("between"),
        F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("value"),
        F.regexp_extract_all(text, F.lit(pattern), F.lit(group)).alias("part"),
    )
    none = F.array().cast("array<struct<start:bigint,end:bigint,value:string,part:string>>")

    def add(state: Column, m: Column) -> Column:
        start = state["at"] + F.length(m["between"])
        end = start + F.length(m["value"])
        span = F.struct(start.alias("start"), end.alias("end"), m["value"].alias("value"), m["part"].alias("part"))
        return F.struct(end.alias("at"), F.concat(state["spans"], F.array(span)).alias("spans"))

    def placed(f: Column) -> Column:
        n = F.size(f["value"])
        pairs = F.zip_with(f["value"], f["part"], lambda v, p: F.struct(v.alias("value"), p.alias("part")))
        named = F.zip_with(
            F.slice(f["between"], 1, n),
            pairs,
            lambda b, m: F.struct(b.alias("between"), m["value"].alias("value"), m["part"].alias("part")),
        )
        start = F.struct(F.lit(0).cast("bigint").alias("at"), none.alias("spans"))
        return F.when(n == 0, none).otherwise(F.aggregate(named, start, add, lambda s: s["spans"]))

    return let(found, placed)


def digest(spans: Column) -> Column:
    """Lower-case hex SHA-256 of a text of spans."""
    return F.sha2(spans.cast("binary"), 256)
