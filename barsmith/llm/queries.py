"""One query for each operator, over its whole table with production parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barsmith.llm import (
    lexical,
    licenses,
    lm,
    mixing,
    order_minhash,
    private,
    quotes,
    secrets,
    simhash,
    spaced_seeds,
    toxicity,
    twins,
    variants,
    warc,
)
from barsmith.llm.common import fold, table
from barsmith.session import scratch_path


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    classifiers = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    return toxicity.score(docs, classifiers).select(
        "doc_id",
        (fold("doc_id", toxicity.FOLDS) == 0).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


def op2_order_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return order_minhash.compared(table(spark, sf_dir, "documents"))


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    return mixing.mixture(docs).drop("text")


def op4_quotation_linking(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All turns as mail, in which each quotes the two before it, and back."""
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return quotes.conversations(turns)


def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", simhash.shown("fp").alias("fingerprint"), "component_id")


def op6_attention(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.scores(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op7_spaced_seeds(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return spaced_seeds.overlaps(docs, table(spark, sf_dir, "benchmark")).drop("text_hash")


def op8_secret_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = secrets.scan(docs, scratch_path(spark, "ledger"))
    return found.select("doc_id", *secrets.report(F.col("found")))


def op9_private(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return private.entities(docs).select("doc_id", *private.report())


def op10_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.findings(table(spark, sf_dir, "documents"))


def op11_warc_zip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages into ZIP packages of WARC records, and back by their indexes."""
    manifest = warc.write(table(spark, sf_dir, "pages"), scratch_path(spark, "packages"))
    return warc.pages(warc.records(warc.ranges(manifest)))


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return variants.variants(table(spark, sf_dir, "documents"))


def op13_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.ranked(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_toxicity,
        op2_order_minhash,
        op3_mixing,
        op4_quotation_linking,
        op5_simhash,
        op6_attention,
        op7_spaced_seeds,
        op8_secret_ledger,
        op9_private,
        op10_licenses,
        op11_warc_zip,
        op12_spelling_variants,
        op13_lexical_search,
    )
}
SQL = twins.SQL
