"""Quotation linking: who answers whom, read from what messages quote.

A message's lines have a quote level, the number of `>` in front. Lines of one level, up to a
blank line, are a passage. Passages are normalised (lower case, letters and digits only, one
blank between words), so that a client's wrapping does not matter, and hashed. The own passages
(level 0) of all messages are the originals. A quoted passage is linked to the latest message of
the thread that wrote it, earlier than the one that quotes; a message answers the latest message
so linked to its passages of the lowest linked level. Conversations are the
trees of these links, in reply order, with quotes and their introductions removed.

Originals and quotes are ordered by thread, hash and position and each quote looks back (`as_of`), so
that a passage written and quoted a thousand times makes two thousand rows. Roots and depths are found by doubling the links' reach.

Defined cases: a null text counts as empty; it quotes nothing. A message without a linked quote
begins a conversation. Messages of one thread at the same position count as one node, which
answers the earliest of their answers. Messages with a null thread or position are kept and
link to nothing.
"""

from __future__ import annotations

import re

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barsmith.llm.common import fresh, ship
from barsmith.session import scratch_table, sized_side

ship(__name__)

MARKS = re.compile(r"[ \t]{0,3}((?:>[ \t]?)*)")
INTRODUCTION = re.compile(r"^(?:On|Am|Le|El)\b.{0,200}:\s*$")
WORD = re.compile(r"[^\W_]+")


def passages(text: str) -> tuple[str, list[int], list[list[int]]]:
    """(own text, hashes of own passages, [hashes quoted at level 1, 2, ...])."""
    lines = []
    for line in text.split("\n"):
        marks = MARKS.match(line)
        level = marks.group(1).count(">")
        lines.append((level, line[marks.end() :] if level else line))
    own: list[str] = []
    for i, (level, line) in enumerate(lines):
        if level == 0 and not (i + 1 < len(lines) and lines[i + 1][0] > 0 and INTRODUCTION.match(line)):
            own.append(line)
        elif level == 0:
            lines[i] = (0, "")
    runs: list[tuple[int, list[str]]] = []
    open_level = None
    for level, line in lines:
        if not line.strip():
            open_level = None
        elif level == open_level:
            runs[-1][1].append(line)
        else:
            runs.append((level, [line]))
            open_level = level
    hashes: dict[int, list[int]] = {}
    for level, part in runs:
        normal = " ".join(WORD.findall(" ".join(part).lower()))
        if normal:
            h = xxhash.xxh64_intdigest(normal.encode("utf-8", "surrogatepass"))
            hashes.setdefault(level, []).append(h - (h >> 63 << 64))
    quoted = [sorted(set(hashes.get(k, []))) for k in range(1, max(hashes, default=0) + 1)]
    return "\n".join(own).strip("\n"), sorted(set(hashes.get(0, []))), quoted


def linked(messages: DataFrame, thread: str, position: str, text: str) -> DataFrame:
    """The messages' thread, position and other columns (without the text), with parent, root, depth, quoted (number
    of quoted passages), found (of them linked) and own (the text without quotes).
    A clash of names gives the new column an underscore."""

    def parse(batches):
        for b in batches:
            got = [passages(t or "") for t in b.column(b.schema.get_field_index("__text")).to_pylist()]
            columns = [
                pa.array([g[0] for g in got], pa.string()),
                pa.array([g[1] for g in got], pa.list_(pa.int64())),
                pa.array([g[2] for g in got], pa.list_(pa.list_(pa.int64()))),
            ]
            yield pa.RecordBatch.from_arrays(
                [*b.columns[:-1], *columns], names=[*b.schema.names[:-1], "__own", "__wrote", "__quoted"]
            )

    kept = messages.drop(text)
    parent, root, depth, n_quoted, n_found, own = fresh(kept, "parent", "root", "depth", "quoted", "found", "own")
    rest = F.struct(*[kept[c] for c in kept.columns]) if kept.columns else F.struct()
    plain = messages.select(
        rest.alias("__rest"),
        F.col(thread).cast("string").alias("__thread"),
        F.col(position).cast("bigint").alias("__at"),
        F.col(text).alias("__text"),
    )
    added = T._parse_datatype_string("__own string, __wrote array<bigint>, __quoted array<array<bigint>>")
    parsed = scratch_table(
        plain.mapInArrow(parse, T.StructType([*plain.schema.fields[:-1], *added.fields])).withColumn("__row", F.monotonically_increasing_id()),
        "messages",
    )
    placed = parsed.where("__thread is not null and __at is not null")
    originals = placed.select("__thread", "__at", F.explode("__wrote").alias("hash")).distinct()
    quotes = placed.select("__row", "__thread", "__at", F.posexplode("__quoted").alias("level", "hashes"))
    quoted = (
        as_of(originals, quotes.select("__row", "__thread", "__at", "level", F.explode("hashes").alias("hash")))
        .groupBy("__row", "__thread", "__at")
        .agg(
            F.count("*").alias("found"),
            F.min(F.struct("level", (-F.col("wrote_at")).alias("minus"))).alias("answer"),
        )
        .select("__row", "__thread", "__at", "found", (-F.col("answer.minus")).alias("parent"))
    )
    answers = scratch_table(quoted, "answers")
    reached = reach(answers.groupBy("__thread", "__at").agg(F.min("parent").alias("parent")))
    mine = answers.select("__row", F.col("found").alias("__found"), F.col("parent").alias("__parent"))
    roots = reached.select("__thread", "__at", F.col("root").alias("__root"), F.col("depth").alias("__depth"))
    return (
        parsed.join(mine, "__row", "left")
        .join(roots, ["__thread", "__at"], "left")
        .select(
            "__rest.*",
            F.col("__parent").alias(parent),
            F.coalesce("__root", "__at").alias(root),
            F.coalesce("__depth", F.lit(0).cast("bigint")).alias(depth),
            F.aggregate("__quoted", F.lit(0), lambda n, x: n + F.size(x)).cast("bigint").alias(n_quoted),
            F.coalesce("__found", F.lit(0).cast("bigint")).alias(n_found),
            F.col("__own").alias(own),
        )
    )


def as_of(originals: DataFrame, quotes: DataFrame) -> DataFrame:
    """The quotes with wrote_at, the greatest position below their own at which the thread has an original of
    their hash; quotes without one are left out.

    Rows are cut into parts by ranges of (thread, hash, position), so that a passage of very many
    messages is several parts. Of the few passages that lie in more than one, each part
    is given the last original of the parts before it.
    """
    rows = quotes.withColumn("wrote_at", F.lit(None).cast("bigint")).unionByName(
        originals.withColumn("wrote_at", F.col("__at")), allowMissingColumns=True
    )
    rows = rows.repartitionByRange("__thread", "hash", "__at").withColumn("part", F.spark_partition_id())
    rows = scratch_table(rows, "passages")
    key = ["__thread", "hash"]
    cut = rows.groupBy(*key).agg(F.min("part").alias("low"), F.max("part").alias("high")).where("low < high")
    lasts = rows.join(sized_side(cut.select(*key)), key, "left_semi").groupBy(*key, "part").agg(F.max("wrote_at").alias("last"))
    before = Window.partitionBy(*key).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    carried = lasts.withColumn("carried", F.max("last").over(before)).drop("last")
    # of one position, quotes come before originals
    back = Window.partitionBy("part", *key).orderBy("__at", F.col("wrote_at").isNotNull()).rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    return (
        rows.withColumn("latest", F.max("wrote_at").over(back))
        .where("wrote_at is null")
        .join(sized_side(carried), [*key, "part"], "left")
        .withColumn("wrote_at", F.coalesce("latest", "carried"))
        .where("wrote_at is not null")
        .select("__row", "__thread", "__at", "level", "wrote_at")
    )


def reach(answers: DataFrame) -> DataFrame:
    """__thread, __at, root, depth of all messages that answer another one.

    Each round doubles how far up a row looks; a chain of n answers takes log2(n) rounds, each
    a join on (thread, position) of small rows. Rows that have seen their root drop out, so
    that a round joins only what is deeper than the rounds before have reached.
    """
    open_rows = scratch_table(
        answers.select("__thread", "__at", F.col("parent").alias("root"), F.lit(1).cast("bigint").alias("depth")), "reach"
    )
    done = open_rows.limit(0)
    while not open_rows.isEmpty():
        marked = open_rows.withColumn("final", F.lit(False)).unionByName(done.withColumn("final", F.lit(True)))
        up = marked.select(
            "__thread", F.col("__at").alias("root"), F.col("root").alias("further"), F.col("depth").alias("more"), "final"
        )
        grown = open_rows.join(up, ["__thread", "root"], "left").select(
            "__thread",
            "__at",
            F.coalesce("further", "root").alias("root"),
            (F.col("depth") + F.coalesce("more", F.lit(0))).alias("depth"),
            F.coalesce("final", F.lit(True)).alias("final"),
        )
        grown = scratch_table(grown, "reach")
        done = done.unionByName(grown.where("final").drop("final"))
        open_rows = grown.where("not final").drop("final")
    return done


def as_mail(turns: DataFrame) -> DataFrame:
    """Turns of a conversation as mail: each quotes the turn before it in full, and within
    that, the one before, one level deeper. Columns conv_id, turn, role, text.

    A turn that is there several times is quoted once, by its smallest text.
    """
    once = turns.where("conv_id is not null and turn is not null").groupBy("conv_id", "turn").agg(
        F.min(F.struct(F.coalesce("text", F.lit("")).alias("text"), F.coalesce("role", F.lit("")).alias("role"))).alias("said")
    )
    once = scratch_table(once, "turns")

    def before(k: int) -> DataFrame:
        return once.select(F.col("conv_id"), (F.col("turn") + k).alias("turn"), F.col("said").alias(f"said{k}"))

    def quote(text, marks: str):
        return F.concat(F.lit(marks), F.regexp_replace(text, "\n", "\n" + marks))

    joined = turns.join(before(1), ["conv_id", "turn"], "left").join(before(2), ["conv_id", "turn"], "left")
    deeper = F.when(
        F.col("said2").isNotNull(),
        F.concat(F.lit("> "), F.col("said2.role"), F.lit(" said:\n"), quote(F.col("said2.text"), "> > "), F.lit("\n>\n")),
    ).otherwise("")
    head = F.concat(
        F.lit("On turn "), (F.col("turn") - 1).cast("string"), F.lit(" "), F.col("said1.role"), F.lit(" wrote:\n"),
        deeper, quote(F.col("said1.text"), "> "), F.lit("\n\n"),
    )
    own = F.coalesce("text", F.lit(""))
    return joined.select(
        "conv_id", "turn", "role", F.concat(F.when(F.col("said1").isNotNull(), head).otherwise(""), own).alias("text")
    )


def conversations(turns: DataFrame) -> DataFrame:
    """Conversations rebuilt from their mail form, one row a message; in reply order if sorted
    by (conv_id, root, depth, turn)."""
    return linked(as_mail(turns), "conv_id", "turn", "text")
