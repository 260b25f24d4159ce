"""Mixing sources to target weights by temperature.

The weight of a source is its share of the tokens to the power of an exponent, normalised. The
exponent lies between 0 (all sources alike) and 1 (as they are) and is bisected to meet a target:
an entropy of the weights, as a part of the largest possible one, or a limit on how often a
source is repeated. `SECTIONS` exponents are tried in one aggregation, that is several
bisections a job; the sources are never collected.

The weights times the budget are tokens per source. They are realised by block permutations:
a source's documents are dealt into blocks of about `BLOCK` by hash; whole epochs repeat all
of them, and the last, partial epoch takes blocks in the order of that epoch's hashes as long
as the budget lasts, and of the block where it ends, documents in the order of theirs. So a
source's realised tokens are below its budget by less than one document. Sorting the result by
(slot, place) gives the training order: the blocks of all sources permuted, and the documents
within each.

Only a table of one row per source is joined to the documents.

Tokens are runs of other than white space (blank, 09 to 0D). A null text has none. Null is a
source of its own. A source without tokens gets no weight and is left out. Equal rows stand at
the same place, in or out together. A small source may be repeated very often, if the target is one of
entropy: its copies are made by many tasks, `COPIES` of a document at a time; a limit on
repetition is the other target.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barsmith.llm.common import fresh
from barsmith.session import scratch_table, sized_side

BLOCK, SECTIONS, ROUNDS, PLACES = 1024, 16, 8, 9
# Copies of a document that one task makes; more are dealt over tasks.
COPIES = 4096


def tokens(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit("[^\\x20\\x09-\\x0D]+")).cast("bigint"), F.lit(0).cast("bigint"))


def hashed(*parts: Column) -> Column:
    """The first 60 bits of the MD5 of the parts, with colons between."""
    text = F.concat_ws(":", *[F.coalesce(p.cast("string"), F.lit("null")) for p in parts])
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 15), 16, 10).cast("bigint")


def exponent(totals: DataFrame, budget: float, entropy: float | None, repeats: float | None) -> float:
    """The exponent that meets the target; the nearest end of 0 to 1 if none does.

    totals: source, tokens (more than none), share. Both measures fall or rise steadily with
    the exponent: entropy falls from the largest, repeats fall to those of plain sampling.
    """
    n, total = totals.agg(F.count("*"), F.sum("tokens")).first()
    if n < 2:
        return 1.0
    goal = entropy * totals.agg(F.log(F.count("*").cast("double"))).first()[0] if entropy is not None else None
    low, high = 0.0, 1.0
    for _ in range(ROUNDS):
        tried = [low + (high - low) * i / SECTIONS for i in range(SECTIONS + 1)]
        a = F.explode(F.array(*[F.lit(x) for x in tried]))
        powers = totals.select("tokens", "share", a.alias("a")).withColumn("p", F.pow("share", "a"))
        sums = powers.groupBy("a").agg(
            F.sum("p").alias("z"),
            F.sum(F.col("p") * F.log("p")).alias("plogp"),
            F.max(F.col("p") / F.col("tokens")).alias("most"),
        )
        if goal is not None:  # H(w) = log z - sum(p log p) / z
            met = (F.log("z") - F.col("plogp") / F.col("z")) >= goal
            holds = sums.where(met).agg(F.max("a")).first()[0]
            if holds is None:
                return 0.0
            low, high = holds, min([x for x in tried if x > holds], default=high)
        else:
            met = F.col("most") / F.col("z") * budget <= repeats
            holds = sums.where(met).agg(F.min("a")).first()[0]
            if holds is None:
                return 1.0
            low, high = max([x for x in tried if x < holds], default=low), holds
    return low if goal is not None else high


def plan(
    docs: DataFrame, budget: float = 1.0, entropy: float | None = 0.95, repeats: float | None = None, seed: int = 7
) -> DataFrame:
    """One row per source: source, tokens, weight, budget, epochs, blocks and the last epoch's cut.

    docs: source, n (tokens), id_hash. budget: in units of all tokens.
    """
    totals = docs.groupBy("source").agg(F.sum("n").alias("tokens"), F.count("*").alias("docs")).where("tokens > 0")
    totals = scratch_table(totals, "totals")
    total = totals.agg(F.sum("tokens")).first()[0] or 0
    shares = totals.withColumn("share", F.col("tokens") / F.lit(float(total or 1)))
    tau = round(exponent(shares, budget * total, entropy, repeats), PLACES)
    norm = shares.agg(F.sum(F.pow("share", F.lit(tau)))).first()[0] or 1.0
    # rounded to so many digits after the first, however small: no source vanishes by rounding
    weight = F.pow("share", F.lit(tau)) / F.lit(norm)
    scale = F.pow(F.lit(10.0), F.floor(-F.log10(weight)))
    weight = F.round(weight * scale, PLACES) / scale
    sources = (
        shares.withColumn("weight", weight)
        .withColumn("budget", F.floor(F.col("weight") * F.lit(budget * total)).cast("bigint"))
        .withColumn("epochs", F.floor(F.col("budget") / F.col("tokens")).cast("bigint"))
        .withColumn("rest", F.expr("budget - epochs * tokens"))
        .withColumn("blocks", F.ceil(F.col("docs") / BLOCK).cast("bigint"))
        .drop("share", "docs")
    )
    sources = scratch_table(sources, "sources")
    side = sources.select(F.col("source").alias("of"), "epochs", "rest", "blocks")
    dealt = docs.join(side, docs.source.eqNullSafe(side.of)).select(
        "source", "n", "rest", "id_hash", "epochs", block("id_hash").alias("block"), slot("epochs", seed).alias("slot")
    )
    # one row a block; then, of one block a source, one row a document
    sums = dealt.groupBy("source", "rest", "slot", "block").agg(F.sum("n").alias("n"))
    run = Window.partitionBy("source").orderBy("slot", "block")
    cut = scratch_table(
        sums.withColumn("to", F.sum("n").over(run)).where("to > rest").groupBy("source").agg(
            F.min(F.struct("slot", "block", (F.col("rest") - F.col("to") + F.col("n")).alias("left"))).alias("cut")
        ),
        "cuts",
    )
    ends = cut.select(F.col("source").alias("of"), "cut")
    inside = dealt.join(
        ends, dealt.source.eqNullSafe(ends.of) & (dealt.slot == ends.cut.slot) & (dealt.block == ends.cut.block)
    ).select("source", "n", place("id_hash", "epochs").alias("place"), "cut.left")
    inside = inside.groupBy("source", "left", "place").agg(F.sum("n").alias("n"))
    run = Window.partitionBy("source").orderBy("place")
    last = (
        inside.withColumn("to", F.sum("n").over(run)).where("to <= left").groupBy("source").agg(F.max("place").alias("last"))
    )
    ends = cut.select(F.col("source").alias("of"), "cut.slot", "cut.block")
    last = last.withColumnRenamed("source", "of2")
    return sized_side(
        sources.join(ends, sources.source.eqNullSafe(ends.of), "left")
        .join(last, sources.source.eqNullSafe(last.of2), "left")
        .select(
            "source", "tokens", "weight", "budget", "epochs", "blocks",
            F.col("slot").alias("cut_slot"), F.col("block").alias("cut_block"), F.col("last").alias("cut_place"),
        )
    )


def block(id_hash: str) -> Column:
    return F.pmod(F.col(id_hash), F.col("blocks"))


def slot(epoch: str, seed: int) -> Column:
    return hashed(F.lit(seed), F.col("source"), F.col("block") if epoch == "epoch" else block("id_hash"), F.col(epoch))


def place(id_hash: str, epoch: str) -> Column:
    return hashed(F.col(id_hash), F.col(epoch))


def mixture(
    docs: DataFrame, budget: float = 1.0, entropy: float | None = 0.95, repeats: float | None = None, seed: int = 7
) -> DataFrame:
    """The documents as often as they are used, with their columns and epoch, slot, place.

    Where the documents have columns of these names already, the new ones get an underscore.
    """
    n, key, of, times, at_block = fresh(docs, "n", "id_hash", "of", "times", "block_of")
    epoch_name, slot_name, place_name = fresh(docs, "epoch", "slot", "place")
    small = docs.select("source", tokens(F.col("text")).alias("n"), hashed(F.col("doc_id"), F.col("text")).alias("id_hash"))
    sources = plan(scratch_table(small, "keys"), budget, entropy, repeats, seed)
    side = sources.select(F.struct("source", "epochs", "blocks", "cut_slot", "cut_block", "cut_place").alias(of))
    used = docs.withColumn(key, hashed(F.col("doc_id"), F.col("text")))
    used = used.join(side, used.source.eqNullSafe(F.col(f"{of}.source")))
    blocked = F.pmod(F.col(key), F.col(f"{of}.blocks"))
    in_slot = hashed(F.lit(seed), F.col(f"{of}.source"), blocked, F.col(f"{of}.epochs"))
    in_place = hashed(F.col(key), F.col(f"{of}.epochs"))
    before = F.struct(in_slot, blocked) < F.struct(F.col(f"{of}.cut_slot"), F.col(f"{of}.cut_block"))
    at = (in_slot == F.col(f"{of}.cut_slot")) & (blocked == F.col(f"{of}.cut_block"))
    partial = F.col(f"{of}.cut_slot").isNull() | before | (at & F.coalesce(in_place <= F.col(f"{of}.cut_place"), F.lit(False)))
    count = F.col(f"{of}.epochs") + partial.cast("bigint")
    own = [F.col(f"`{c}`") for c in docs.columns]
    repeated = used.select(*own, key, count.alias(times), blocked.alias(at_block)).where(F.col(times) > 0)
    most = sources.agg(F.max("epochs")).first()[0] or 0
    zero, first, last = F.lit(0).cast("bigint"), F.lit(0).cast("bigint"), F.col(times) - 1
    if most >= COPIES:
        (share,) = fresh(repeated, "share_of_copies")
        repeated = repeated.withColumn(share, F.explode(F.sequence(zero, F.expr(f"(`{times}` - 1) div {COPIES}"))))
        repeated = repeated.repartition(key, share)
        first = F.col(share) * COPIES
        last = F.least(last, first + COPIES - 1)
    repeated = repeated.withColumn(epoch_name, F.explode(F.sequence(first, last)))
    return repeated.select(
        *own,
        epoch_name,
        hashed(F.lit(seed), F.col("source"), F.col(at_block), F.col(epoch_name)).alias(slot_name),
        hashed(F.col(key), F.col(epoch_name)).alias(place_name),
    )
