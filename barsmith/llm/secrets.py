"""Secret scans with an incremental ledger of blobs.

Every version of every path is addressed by the SHA-256 of its content (a blob). The ledger, two
Parquet folders, says which blob has been scanned with which version of which rule, and what was
found. A run scans only the (blob, rule version) pairs the ledger does not have, each blob
once however many paths hold it, and joins all findings back to all paths.

Findings are written before the pairs are marked as scanned: a run that ends in between is
repeated, and repeated findings count once. A rule whose pattern changes needs a new version.
One run at a time per ledger.

Only DataFrame functions are used. Per distinct blob the text is shuffled once, to the path that
stands for it; hot blobs are reduced to one row before that.

A null text counts as empty. Spans are code points, ends exclusive.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barsmith.llm.common import fresh
from barsmith.llm.spans import digest, matches
from barsmith.session import scratch_table
from barsmith.sources.paths import exists


@dataclass(frozen=True)
class Rule:
    """A kind of secret. needs: texts without any of these cannot match. part: the least
    length of a group (0: of the whole match); shorter matches are dropped."""

    kind: str
    pattern: str
    needs: tuple[str, ...] = ()
    group: int = 0
    least: int = 1
    version: int = 1


BASE = (
    Rule(
        "assign",
        "(?i)(password|passwd|secret|token|api_?key)[\"']?\\x20*[:=]\\x20*[\"']?([A-Za-z0-9+/_.=-]+)",
        ("=", ":"),
        group=2,
        least=6,
    ),
    Rule("access", "AKIA[A-Z0-9]+", ("AKIA",), least=20),
    Rule("hex", "[0-9a-f]{24,}"),  # a maximal run, as [0-9a-f]+ matches it
)
MORE = (
    Rule("github", "gh[pousr]_[A-Za-z0-9]{36,}", ("ghp_", "gho_", "ghu_", "ghs_", "ghr_")),
    Rule("slack", "xox[abprs]-[A-Za-z0-9-]{10,}", ("xox",)),
    Rule("jwt", "eyJ[A-Za-z0-9_-]{8,}\\.[A-Za-z0-9_-]{8,}\\.[A-Za-z0-9_-]{8,}", ("eyJ",)),
    Rule("pem", "-----BEGIN [A-Z ]{0,40}PRIVATE KEY-----", ("PRIVATE KEY-----",)),
    Rule("url", "://[^\\s/:@]{1,256}:[^\\s/:@]{1,256}@", ("://",)),
)
RULES = BASE + MORE


def blob(text: Column) -> Column:
    return F.unhex(F.sha2(F.coalesce(text, F.lit("")).cast("binary"), 256))


def found_by(rule: Rule, text: Column) -> Column:
    """An array of (kind, version, start, end)."""
    none = F.array().cast("array<struct<kind:string,version:int,start:bigint,end:bigint>>")
    spans = matches(text, rule.pattern, rule.group)
    if rule.least > 1:
        spans = F.filter(spans, lambda s: F.length(s["part"]) >= rule.least)
    named = F.transform(
        spans,
        lambda s: F.struct(
            F.lit(rule.kind).alias("kind"), F.lit(rule.version).alias("version"), s["start"].alias("start"), s["end"].alias("end")
        ),
    )
    possible = F.lit(False)
    for part in rule.needs:
        possible = possible | text.contains(part)
    if not rule.needs:
        possible = text.rlike(rule.pattern)
    return F.when(possible, named).otherwise(none)


def scan(versions: DataFrame, ledger: str, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Bring the ledger up to date with all versions; the findings of each path.

    versions: any columns, among them `text`. Returns them without the text, and found: an
    array of (start, rank of the rule, end, kind) in that order. A clash of names gives the
    new column an underscore.
    """
    spark = versions.sparkSession
    out = fresh(versions, "found")[0]
    paths = [c for c in versions.columns if c.lower() != "text"]
    plain = versions.select(
        F.struct(*[versions[c] for c in paths]).alias("path"), F.coalesce("text", F.lit("")).alias("text")
    ).withColumn("blob", blob(F.col("text")))
    names = F.array(*[F.lit(f"{r.kind}@{r.version}") for r in rules])
    row = F.xxhash64(*[F.to_json(F.struct("path"))])
    stands = plain.select("blob", row.alias("row")).groupBy("blob").agg(F.min("row").alias("row"))
    if exists(spark, f"{ledger}/scanned"):
        seen = spark.read.parquet(f"{ledger}/scanned").select("blob", F.explode("rules").alias("rule")).distinct()
        pending = (
            stands.select("blob", "row", F.explode(names).alias("rule"))
            .join(seen, ["blob", "rule"], "left_anti")
            .groupBy("blob", "row")
            .agg(F.collect_set("rule").alias("rules"))
        )
    else:
        pending = stands.withColumn("rules", names)
    # written, so that the scan stays behind the join: each blob is scanned at one path only
    pending = scratch_table(pending, "pending")
    texts = plain.select("blob", row.alias("row"), "text").join(pending.hint("shuffle_hash"), ["blob", "row"])
    every = [
        F.when(F.array_contains("rules", f"{r.kind}@{r.version}"), found_by(r, F.col("text"))).otherwise(
            F.array().cast("array<struct<kind:string,version:int,start:bigint,end:bigint>>")
        )
        for r in rules
    ]
    run = texts.select("blob", F.concat(*every).alias("found")).where(F.size("found") > 0)
    run.write.mode("append").parquet(f"{ledger}/findings")
    pending.select("blob", "rules").write.mode("append").parquet(f"{ledger}/scanned")

    rank = F.array(*[F.lit(f"{r.kind}@{r.version}") for r in rules])
    known = (
        spark.read.schema(run.schema)
        .parquet(f"{ledger}/findings")
        .select("blob", F.explode("found").alias("f"))
        .select(
            "blob",
            F.struct(
                F.col("f.start").alias("start"),
                F.array_position(rank, F.concat_ws("@", "f.kind", "f.version")).cast("int").alias("rank"),
                F.col("f.end").alias("end"),
                F.col("f.kind").alias("kind"),
            ).alias("f"),
        )
        .where("f.rank > 0")
        .groupBy("blob")
        .agg(F.array_sort(F.collect_set("f")).alias("found"))
    )
    empty = F.array().cast("array<struct<start:bigint,rank:int,end:bigint,kind:string>>")
    return (
        plain.select("path", "blob")
        .join(known, "blob", "left")
        .select("path.*", F.coalesce("found", empty).alias(out))
    )


def shown(found: Column) -> Column:
    return F.array_join(
        F.transform(found, lambda f: F.concat_ws(":", f["kind"], f["start"].cast("string"), f["end"].cast("string"))), ","
    )


def report(found: Column) -> list[Column]:
    """Counts of the base kinds, the digest of the base spans, and all spans."""
    base = F.filter(found, lambda f: f["rank"] <= len(BASE))

    def count(kind: str) -> Column:
        return F.size(F.filter(found, lambda f: f["kind"] == kind)).cast("bigint").alias(f"n_{kind}")

    counts = [count(r.kind) for r in BASE]
    return [*counts, digest(shown(base)).alias("base_sha256"), shown(found).alias("spans")]
