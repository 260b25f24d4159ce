"""Document fingerprints by order MinHash, a sketch sensitive to edit distance.

A text is the sequence of its k-mers (`K` code points), each numbered by how often it has
occurred before, so that repeats count. Every numbered k-mer is hashed to a point on a circle. A
lane of the fingerprint looks at the `TUPLE` points that follow its own place on the circle (the
minimal k-mers of that lane), puts them back into the order in which they stand in the text,
and hashes that tuple. Two texts agree in a lane if they share the minimal k-mers and their
order. The likeness of two fingerprints is their share of equal lanes.

Defined cases: a null text counts as empty; an empty text has the fingerprint of all zeros, like
only to itself. A text shorter than a k-mer is one k-mer, filled up with zeros.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barsmith.llm.common import ship, width

ship(__name__)

K, TUPLE, LANES = 6, 2, 64
LOW = -(2**63)


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x81DADEF4BC2DD44D)
    return x ^ (x >> np.uint64(33))


def fingerprint(text: str, k: int = K, size: int = TUPLE, lanes: int = LANES) -> np.ndarray:
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    if not codes.size:
        return np.zeros(lanes, np.uint16)
    if codes.size < k:
        codes = np.concatenate([codes, np.zeros(k - codes.size, np.uint32)])
    n = codes.size - k + 1
    kmers = codes[:n].astype(np.uint64)
    for i in range(1, k):
        kmers = kmers * np.uint64(0x9E3779B97F4A7C15) + codes[i : n + i]
    kmers = mixed(kmers)

    bits = np.uint64(max(1, (n - 1).bit_length()))
    places = np.uint64((1 << int(bits)) - 1)
    order = (kmers & ~places) | np.arange(n, dtype=np.uint64)
    order.sort()  # equal k-mers stand together, in text order
    at = order & places
    first = np.ones(n, bool)
    first[1:] = (order[1:] >> bits) != (order[:-1] >> bits)
    index = np.arange(n)
    occurrence = (index - np.maximum.accumulate(np.where(first, index, 0))).astype(np.uint64)
    numbered = np.empty(n, np.uint64)
    numbered[at] = mixed(kmers[at] + occurrence * np.uint64(0xD1B54A32D192ED03))

    circle = (numbered & ~places) | np.arange(n, dtype=np.uint64)
    circle.sort()
    size = min(size, n)
    begin = np.searchsorted(circle, np.arange(lanes, dtype=np.uint64) * np.uint64(2**64 // lanes))
    chosen = np.sort(circle[(begin[:, None] + np.arange(size)) % n] & places, axis=1)
    out = numbered[chosen[:, 0]]
    for j in range(1, size):
        out = mixed(out * np.uint64(0xA0761D6478BD642F) + numbered[chosen[:, j]])
    return (out >> np.uint64(48)).astype(np.uint16)


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    if not a.any() or not b.any():
        return float(not a.any() and not b.any())
    return float((a == b).mean())


def shown(f: np.ndarray) -> str:
    return f.astype(">u2").tobytes().hex()


def edited(text: str, following: str) -> str:
    """The last quarter of a text replaced by as much of the beginning of another."""
    n = len(text) // 4
    return text[: len(text) - n] + following[:n]


def with_next(docs: DataFrame) -> DataFrame:
    """doc_id, text, in ranges of ids: (part, extra, doc_id, text), one partition a part.

    Each part is a range of ids, with, as an extra row, the first document of the range after
    it (after the last: the first). The bounds are quantiles of the ids and go through the
    driver, two numbers a partition; the texts are shuffled once.
    """
    spark = docs.sparkSession
    parts = width(spark)
    keyed = docs.select(
        "doc_id",
        F.coalesce("text", F.lit("")).alias("text"),
        F.coalesce(F.col("doc_id").cast("bigint"), F.lit(LOW)).alias("key"),
    )
    cuts = sorted(
        set(
            keyed.agg(F.percentile_approx("key", [i / parts for i in range(1, parts)] or [0.5], 10000)).first()[0] or []
        )
    )
    bounds = F.array(*[F.lit(c) for c in cuts]) if cuts else F.array().cast("array<bigint>")
    part = F.size(F.filter(bounds, lambda c: c <= F.col("key")))
    keyed = keyed.withColumn("part", part)
    heads = sorted(tuple(r) for r in keyed.groupBy("part").agg(F.min("key")).collect())
    target = {heads[i][1]: heads[i - 1][0] for i in range(len(heads))}
    if target:
        targets = F.create_map(*[F.lit(x) for pair in target.items() for x in pair])
        extra = F.when(F.col("key").isin(*target), F.element_at(targets, F.col("key")))
    else:
        extra = F.lit(None).cast("int")
    both = F.array(
        F.struct(F.col("part").alias("part"), F.lit(0).alias("extra")),
        F.struct(extra.alias("part"), F.lit(1).alias("extra")),
    )
    return (
        keyed.withColumn("to", F.explode(both))
        .where("to.part is not null")
        .select("to.part", "to.extra", "key", "doc_id", "text")
        .repartitionById(len(cuts) + 1, F.col("part"))
        .sortWithinPartitions("part", "extra", "key", "text")
    )


OUT = (
    "doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, "
    "near_edited double, near_next double"
)
COLUMNS = [c.split()[0] for c in OUT.split(", ")]


def compared(docs: DataFrame) -> DataFrame:
    """Each document's fingerprint next to those of its edited text and of the next document.

    Documents are ordered by id, a null id first; rows with the same id by their text.
    """

    def run(batches):
        def finish(row, following, print_of_next):
            text, own = row[1], row[2]
            other = edited(text, following)
            changed = fingerprint(other)
            return (
                row[0],
                len(text),
                hashlib.sha256(other.encode("utf-8", "surrogatepass")).hexdigest(),
                shown(own),
                shown(changed),
                likeness(own, changed),
                likeness(own, print_of_next),
            )

        held, part, closed = None, None, False
        for batch in batches:
            out = []
            for p, extra, _, doc_id, text in zip(*(c.to_pylist() for c in batch.columns)):
                if p != part:
                    held, part, closed = None, p, False
                if closed:
                    continue  # another row with the id of the next part's first
                own = fingerprint(text)
                if held is not None:
                    out.append(finish(held, text, own))
                held, closed = (doc_id, text, own), bool(extra)
            if out:
                yield pa.RecordBatch.from_pydict(
                    dict(zip(COLUMNS, map(list, zip(*out)))),
                    schema=pa.schema(
                        [
                            ("doc_id", pa.int64()),
                            ("n_chars", pa.int64()),
                            *((c, pa.string()) for c in COLUMNS[2:5]),
                            *((c, pa.float64()) for c in COLUMNS[5:]),
                        ]
                    ),
                )

    return with_next(docs).mapInArrow(run, OUT)
