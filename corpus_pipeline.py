"""From documents to a training mixture: five stages, each written and read again.

Every stage works on all that the one before has kept, and all but the last return the columns
of `documents`. Rows are told apart by (doc_id, hash of the text), null ids included; extra
columns are carried along.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barsmith.llm import mixing, private, simhash, spaced_seeds, toxicity
from barsmith.llm.common import fresh, table
from barsmith.session import scratch_path, scratch_table, sized_side
from barsmith.sources.paths import delete


def _columns(docs: DataFrame) -> list:
    return [docs[f"`{c}`"] for c in docs.columns]


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of a score under 0.5."""
    (name,) = fresh(docs, "score")
    classifiers = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    return toxicity.score(docs, classifiers, name).where(F.col(name) < 0.5).drop(name)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates the document of the smallest id (null ids last); of
    rows with the same id, the one whose text has the smallest hash; of equal rows, one."""
    plain = docs.select("doc_id", "text")
    prints = scratch_table(simhash.fingerprints(plain, with_text_hash=True), "prints")
    groups = simhash.groups(prints)
    first = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "text_hash")
    of_print = prints.groupBy("fp").agg(F.min(first).alias("first")).join(groups.select("fp", "root"), "fp")
    keep = of_print.groupBy("root").agg(F.min("first").alias("first")).select("first.doc_id", "first.text_hash")
    rows = prints.groupBy(F.col("doc_id").alias("id"), F.col("text_hash").alias("hash")).agg(F.count("*").alias("n"))
    key, hashed, copies = fresh(docs, "of", "text_hash", "copies")
    keep = keep.withColumnsRenamed({"doc_id": key, "text_hash": hashed})
    keep = scratch_table(
        keep.join(rows, F.col(key).eqNullSafe(rows.id) & (F.col(hashed) == rows.hash)).select(
            key, hashed, F.col("n").alias(copies)
        ),
        "keep",
    )
    kept = docs.join(
        keep.hint("shuffle_hash"),
        docs["doc_id"].eqNullSafe(F.col(key)) & F.xxhash64(docs["text"]).eqNullSafe(F.col(hashed)),
    )
    once = kept.where(F.col(copies) == 1).select(*_columns(docs))
    if keep.where(F.col(copies) > 1).isEmpty():
        return once
    return once.unionByName(
        kept.where(F.col(copies) > 1).dropDuplicates([key, hashed]).select(*[F.col(f"`{c}`") for c in docs.columns])
    )


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark."""
    key, hashed = fresh(docs, "of", "text_hash")
    found = spaced_seeds.overlaps(docs.select("doc_id", "text"), table(spark, sf_dir, "benchmark"))
    found = found.select(F.col("doc_id").alias(key), F.col("text_hash").alias(hashed)).distinct()
    return docs.join(
        sized_side(found),
        docs["doc_id"].eqNullSafe(F.col(key)) & (F.xxhash64(docs["text"]) == F.col(hashed)),
        "left_anti",
    )


def mask_private(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with personal data masked in their texts."""
    return private.redacted(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents as often as the mixture uses them, with epoch, slot and place."""
    return mixing.mixture(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_benchmark),
    ("private_data", mask_private),
    ("mixing", mix_sources),
]
#: The classifier of the first stage is trained; tests hold run() against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The mixture made from the whole documents table. A stage's table goes when the next one is written."""
    docs, before = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES:
        path = scratch_path(spark, f"stage-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
        if before is not None:
            delete(spark, before)
        before = path
    return docs
