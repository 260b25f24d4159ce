"""Personal data by bootstrapped contextual extraction.

Seeds are entities that a pattern and a check prove: mail addresses, IP addresses, payment cards
(Luhn) and phone numbers. Tokens with digits that no seed covers, and runs of such tokens with one
blank between them, are open instances, of whatever length. The words
around an instance are lexical patterns: the two words before it, and the word on each side.

Spark scores the graph of patterns and instances in rounds. A pattern's confidence for a kind is
the confidence of its instances for it, summed, over one more than its number of instances; it
needs the weight of `SUPPORT` instances. An open instance's confidence is that of at least
one of its patterns being right, 1 - prod(1 - confidence); from `ACCEPT` on it is an entity
and lends its weight to its patterns in the next round. When a round accepts nothing new, every mention of an
accepted instance within an accepting pattern is a span, besides those of the seeds.

Only DataFrame functions are used. Instances and patterns are grouped with partial aggregation;
no group is gathered.

A null text counts as empty and has no spans. Spans are code points, ends exclusive.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barsmith.llm.common import fresh
from barsmith.llm.spans import digest, let, matches
from barsmith.session import scratch_table

KINDS = ("email", "ip", "card", "phone")
SUPPORT, ACCEPT, DIGITS = 3.0, 0.75, 6

# Each search begins at the start of a run or where the last match ended, and never goes
# back into a run: long runs cost their length.
_LOCAL = "[A-Za-z0-9._%+-]"
EMAIL = f"(?:\\G|(?<!{_LOCAL})){_LOCAL}++@[A-Za-z0-9-]++(?:\\.[A-Za-z0-9-]++)++"
IP = "(?:\\G|(?<![0-9]))[0-9]++\\.[0-9]++\\.[0-9]++\\.[0-9]++"
CARD = "[0-9](?:[\\x20-]?[0-9])++"
PHONE = "\\+[0-9][\\x20().0-9-]+[0-9]"
OPEN = "(?:\\G|(?<!\\S))[^\\s0-9]*+[0-9]\\S*+"
OPEN_RUN = OPEN + "(?:\\x20[^\\s0-9]*+[0-9]\\S*+)++"
_BYTE = "0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]{1,2})"

SPAN = "array<struct<start:bigint,end:bigint,value:string,kind:string>>"


def digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def luhn(number: Column) -> Column:
    def part(c: Column, i: Column) -> Column:
        d = c.cast("int")
        doubled = F.when(d > 4, 2 * d - 9).otherwise(2 * d)
        return F.when(i % 2 == 1, doubled).otherwise(d)

    reversed_digits = F.filter(F.split(F.reverse(number), ""), lambda c: c != "")
    return F.aggregate(F.transform(reversed_digits, part), F.lit(0), lambda a, x: a + x) % 10 == 0


def _kind(text: Column, kind: str, pattern: str, possible: Column, check=None) -> Column:
    spans = matches(text, pattern)
    if check:
        spans = F.filter(spans, lambda s: check(s["value"]))
    named = F.transform(
        spans,
        lambda s: F.struct(
            s["start"].alias("start"), s["end"].alias("end"), s["value"].alias("value"), F.lit(kind).alias("kind")
        ),
    )
    return F.when(possible, named).otherwise(F.array().cast(SPAN))


def seeds(text: Column) -> Column:
    """An array of (start, end, value, kind), by kind and start."""
    return F.concat(
        _kind(text, "email", EMAIL, text.contains("@")),
        _kind(text, "ip", IP, text.rlike("[0-9]\\.[0-9]"), lambda v: v.rlike(f"^{_BYTE}(?:\\.{_BYTE}){{3}}$")),
        _kind(
            text, "card", CARD, text.rlike("[0-9](?:[\\x20-]?[0-9]){15}"),
            lambda v: let(digits(v), lambda d: F.when(F.length(d).between(16, 19), luhn(d)).otherwise(False)),
        ),
        _kind(text, "phone", PHONE, text.rlike("\\+[0-9]"), lambda v: F.length(digits(v)).between(8, 15)),
    )


def opened(text: Column, known: Column) -> Column:
    """Tokens with digits and runs of them that overlap no seed, without punctuation at their ends."""
    tokens = F.concat(
        _kind(text, "", OPEN, text.rlike("[0-9]")), _kind(text, "", OPEN_RUN, text.rlike("[0-9]\\S*\\x20[^\\s0-9]*+[0-9]"))
    )
    bare = F.transform(
        tokens,
        lambda s: let(
            F.struct(
                F.length(F.regexp_extract(s["value"], "^[^\\p{L}\\p{N}]*", 0)).alias("skip"),
                F.regexp_replace(s["value"], "^[^\\p{L}\\p{N}]+|[^\\p{L}\\p{N}]+$", "").alias("value"),
            ),
            lambda b: F.struct(
                (s["start"] + b["skip"]).alias("start"),
                (s["start"] + b["skip"] + F.length(b["value"])).alias("end"),
                b["value"].alias("value"),
                F.lit("").alias("kind"),
            ),
        ),
    )
    return F.filter(
        bare,
        lambda s: ~F.exists(known, lambda k: (k["start"] < s["end"]) & (s["start"] < k["end"])),
    )


def in_context(text: Column, spans: Column) -> Column:
    """The spans with their patterns (null where the words are missing)."""

    def clean(words: Column) -> Column:
        return F.lower(F.regexp_replace(words, "[^\\p{L}\\p{N}\\s]+", ""))

    def one(s: Column) -> Column:
        from_ = F.greatest(s["start"] - 63, F.lit(1))
        before = F.substr(text, from_.cast("int"), (s["start"] + 1 - from_).cast("int"))
        after = F.substr(text, (s["end"] + 1).cast("int"), F.lit(48))
        return let(
            F.struct(
                F.filter(F.split(clean(before), "\\s+"), lambda w: w != "").alias("l"),
                F.filter(F.split(clean(after), "\\s+"), lambda w: w != "").alias("r"),
            ),
            lambda c: F.struct(
                s["start"].alias("start"),
                s["end"].alias("end"),
                F.lower(s["value"]).alias("value"),
                s["kind"].alias("kind"),
                F.when(
                    F.size(c["l"]) >= 2, F.concat_ws(" ", F.lit("<<"), F.element_at(c["l"], -2), F.element_at(c["l"], -1))
                ).alias("left"),
                F.when(
                    (F.size(c["l"]) >= 1) & (F.size(c["r"]) >= 1),
                    F.concat_ws(" ", F.lit("<>"), F.element_at(c["l"], -1), F.element_at(c["r"], 1)),
                ).alias("around"),
            ),
        )

    return F.transform(spans, one)


def mentions(docs: DataFrame) -> DataFrame:
    """doc_id, text_hash, row, spans: seeds and open instances of every document."""
    text = F.coalesce(F.col("text"), F.lit(""))
    known = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), text.alias("text")).withColumn(
        "known", seeds(F.col("text"))
    )
    spans = F.when(
        (F.size("known") > 0) | F.col("text").rlike("[0-9]"),
        in_context(F.col("text"), F.concat("known", opened(F.col("text"), F.col("known")))),
    )
    return known.select("doc_id", "text_hash", spans.alias("spans")).withColumn("row", F.monotonically_increasing_id())


def bootstrap(edges: DataFrame) -> DataFrame:
    """(value, kind, conf, pattern) of open instances that are accepted, and the patterns that do so.

    edges: pattern, value, kind ("" of an open instance). The rounds end when no confidence moves any
    more, in its first `DIGITS` digits: a pattern may gain for some rounds before it accepts
    another instance.
    """
    edges = scratch_table(edges.distinct(), "edges")
    sizes = edges.groupBy("pattern").agg(F.countDistinct("value").alias("n"))
    sure = edges.where("kind <> ''").select("value", "kind", F.lit(1.0).alias("conf")).distinct()
    open_edges = edges.where("kind = ''").select("pattern", "value")
    believed, mark, before = sure, (0, None), None
    while mark != before:
        weights = (
            edges.select("pattern", "value").distinct().join(believed, "value")
            .groupBy("pattern", "kind").agg(F.sum("conf").alias("weight"))
            .where(F.col("weight") >= SUPPORT)
        )
        patterns = weights.join(sizes, "pattern").select("pattern", "kind", (F.col("weight") / (F.col("n") + 1)).alias("conf"))
        patterns = scratch_table(patterns, "patterns")
        met = open_edges.join(patterns, "pattern")
        instances = (
            met.groupBy("value", "kind")
            .agg((1 - F.exp(F.sum(F.log(1 - F.col("conf"))))).alias("conf"))
            .where(F.col("conf") >= ACCEPT)
        )
        accepted = scratch_table(instances, "accepted")
        held = F.round("conf", DIGITS).cast("decimal(20, 10)")
        before, mark = mark, tuple(accepted.agg(F.count("*"), F.sum(held)).first())
        believed = sure.unionByName(accepted.join(sure.select("value", "kind"), ["value", "kind"], "left_anti"))
    return met.select("value", "kind", "pattern").join(accepted, ["value", "kind"])


def entities(docs: DataFrame) -> DataFrame:
    """doc_id, text_hash, found: an array of (rank of the kind, start, end), seeds first within
    equal places; known: the seeds among them."""
    table = scratch_table(mentions(docs), "mentions")
    each = table.select("row", F.explode("spans").alias("s")).select("row", "s.*")
    patterns = each.select("row", "start", "end", "value", "kind", F.explode(F.array("left", "around")).alias("pattern"))
    patterns = patterns.where("pattern is not null")
    accepted = bootstrap(patterns.select("pattern", "value", "kind"))
    # of several kinds the more confident one, then the first of the list
    listed = F.array_position(F.array(*[F.lit(k) for k in KINDS]), F.col("kind")).cast("int")
    first = F.min(F.struct((-F.col("conf")).alias("less"), listed.alias("rank")))
    best = accepted.groupBy("value", "pattern").agg(first.alias("first"))
    rank = F.col("first.rank")
    new = (
        patterns.where("kind = ''")
        .join(best, ["value", "pattern"])
        .groupBy("row", "start", "end").agg(F.min(rank).alias("rank"))
        .groupBy("row")
        .agg(F.collect_list(F.struct("rank", "start", "end")).alias("new"))
    )
    place = F.array(*[F.lit(k) for k in KINDS])
    known = F.transform(
        F.filter(F.coalesce("spans", F.array()), lambda s: s["kind"] != ""),
        lambda s: F.struct(
            F.array_position(place, s["kind"]).cast("int").alias("rank"), s["start"].alias("start"), s["end"].alias("end")
        ),
    )
    none = F.array().cast("array<struct<rank:int,start:bigint,end:bigint>>")
    return (
        table.join(new, "row", "left")
        .withColumn("known", F.array_sort(known))
        .select(
            "doc_id",
            "text_hash",
            "known",
            F.array_sort(F.concat("known", F.coalesce("new", none))).alias("found"),
        )
    )


def shown(found: Column) -> Column:
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(
        F.transform(
            found,
            lambda f: F.concat_ws(":", F.element_at(names, f["rank"]), f["start"].cast("string"), f["end"].cast("string")),
        ),
        ",",
    )


def report() -> list[Column]:
    def count(i: int) -> Column:
        return F.size(F.filter("known", lambda f: f["rank"] == i + 1)).cast("bigint").alias(f"n_{KINDS[i]}")

    counts = [count(i) for i in range(len(KINDS))]
    return [*counts, digest(shown(F.col("known"))).alias("base_sha256"), shown(F.col("found")).alias("spans")]


def masked(text: Column, found: Column) -> Column:
    """The text with each span replaced by its kind in brackets; overlapping spans by the first."""
    names = F.array(*[F.lit(k.upper()) for k in KINDS])
    ordered = F.array_sort(
        F.transform(found, lambda f: F.struct(f["start"].alias("start"), f["end"].alias("end"), f["rank"].alias("rank")))
    )
    begin = F.struct(F.lit(0).cast("bigint").alias("at"), F.lit("").alias("out"))

    def step(state: Column, f: Column) -> Column:
        length = F.greatest(f["start"] - state["at"], F.lit(0))
        kept = F.substr(text, (state["at"] + 1).cast("int"), length.cast("int"))
        tag = F.when(f["start"] >= state["at"], F.concat(F.lit("["), F.element_at(names, f["rank"]), F.lit("]"))).otherwise("")
        return F.struct(F.greatest(f["end"], state["at"]).alias("at"), F.concat(state["out"], kept, tag).alias("out"))

    def finish(state: Column) -> Column:
        return F.concat(state["out"], F.substr(text, (state["at"] + 1).cast("int"), F.lit(2**31 - 1)))

    return F.aggregate(ordered, begin, step, finish)


def redacted(docs: DataFrame) -> DataFrame:
    """The documents with personal data masked in `text`, and `n_chars` (if there) counted anew.

    Spans are found as by `entities` and joined to the documents by id and text; documents
    without spans keep their text.
    """
    key, hashed, spans = fresh(docs, "of", "text_hash_of", "found_spans")
    found = entities(docs).where(F.size("found") > 0)
    found = found.select(F.col("doc_id").alias(key), F.col("text_hash").alias(hashed), F.col("found").alias(spans))
    found = scratch_table(found.dropDuplicates([key, hashed]), "spans")
    text_hash = F.xxhash64(docs["text"])
    joined = docs.join(found.hint("shuffle_hash"), docs["doc_id"].eqNullSafe(F.col(key)) & (text_hash == F.col(hashed)), "left")
    text = F.when(F.col(spans).isNotNull(), masked(docs["text"], F.col(spans))).otherwise(docs["text"])
    columns = [text.alias(c) if c == "text" else docs[c] for c in docs.columns]
    out = joined.select(*columns)
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return out
