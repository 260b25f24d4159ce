"""Ranked lexical search: the exact top documents of each item, by blocks of similar documents.

Terms are the longest runs of ASCII letters and digits and of characters beyond ASCII; only A-Z
are lower-cased. A document's score for an item is the sum, over the item's different terms, of
the term's weight by the document's impact, all in whole numbers (see `weight`, `impacts`).

Documents are dealt into shards of bounded size. In a shard the posting list of a term is
clustered by document similarity: some of its documents are seeds, and each document joins the
most similar one (random projections of the weighted vectors). A block keeps the coordinatewise
maximum of its documents' vectors. Lists are read from the heaviest term to the lightest. The
documents of a list that are still open hold none of the item's earlier terms, or were in a block
that failed; so a block's bound is the item's weights times its summary, from this term on. A block
is skipped only if that bound is below the item's k-th best score so far; else its documents
are scored in full. Hence no result is lost, whatever the clustering.

A pass over the texts serves up to `ITEMS` items: their terms travel with the tasks. It writes the
documents' vectors over these terms; frequencies and lengths count all documents. The shards
are then searched from that table, each task returns at most k documents an item, and a ranking
within each item ends the pass. More items take more passes.

Odd cases: a null or empty text has no term, is no result, and as an item finds nothing. Null ids
of documents come last among equal scores. Each row of a repeated document is a result of
its own, equal ones in any order. Items equal in id and text are one item; others are
ranked apart, also under one id. Empty tables give no rows. Extra columns are ignored. Texts of any
length are read whole.
"""

from __future__ import annotations

import math
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from barsmith.llm.common import ship
from barsmith.session import scratch_table

ship(__name__)

TOP = 10
ITEMS = 256
# documents in a shard, at most, and numbers in a shard's matrix of documents and terms
SHARD, CELLS = 2048, 1 << 23
# documents a seed of a block gathers on average; directions that similarity is measured along
BLOCK, DIRECTIONS = 32, 32

# Bytes that separate terms become blanks, A-Z lower case; bytes of longer characters stay.
_BYTES = bytes(
    c + 32 if 65 <= c <= 90 else c if c >= 128 or chr(c).isalnum() else 32 for c in range(256)
)


def terms(raw: bytes) -> list[bytes]:
    """The terms of a text in UTF-8, repeats included."""
    return raw.translate(_BYTES).split()


def weight(documents: int, holding: int) -> int:
    """A term's weight; `documents` have terms at all, `holding` have this one."""
    return math.floor(1000 * math.log((2 * documents + 2) / (2 * holding + 1)))


def impacts(tf: np.ndarray, n: np.ndarray, documents: int, length: int) -> np.ndarray:
    """What a term that occurs `tf` times adds by weight in a document of n terms.

    `length` counts the terms of all documents.
    """
    m = 100 - 90 + (90 * n * documents) // length
    return (1_000_000_000 * tf) // (1000 * tf + 8 * m)


def vectors(docs: DataFrame, vocabulary: list[bytes]) -> DataFrame:
    """doc_id, n (its terms) and, for the terms of `vocabulary` it has, their places and counts."""

    def run(batches):
        place = {term: i for i, term in enumerate(vocabulary)}
        for batch in batches:
            lengths, ends, places, counts = [], [0], [], []
            for text in batch.column(1):
                found = terms(text.as_py() or b"")
                lengths.append(len(found))
                held = Counter(map(place.get, found))
                held.pop(None, None)
                places += held.keys()
                counts += held.values()
                ends.append(len(places))
            lists = [pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(x, pa.int32())) for x in (places, counts)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(lengths, pa.int64()), *lists], names=["doc_id", "n", "terms", "counts"]
            )

    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("binary").alias("text"))
    return texts.mapInArrow(run, "doc_id bigint, n bigint, terms array<int>, counts array<int>")


class Best:
    """The best k documents of one item so far: score, whether the id is null, and id."""

    def __init__(self, k: int):
        self.k, self.rows = k, np.zeros((0, 3), np.int64)

    def floor(self) -> int:
        """No document of a lower score can be a result."""
        return int(self.rows[-1, 0]) if len(self.rows) == self.k else 1

    def add(self, scores: np.ndarray, ids: np.ndarray) -> None:
        keep = scores >= self.floor()
        if keep.any():
            rows = np.concatenate([self.rows, np.column_stack([scores[keep], ids[keep]])])
            self.rows = rows[np.lexsort((rows[:, 2], rows[:, 1], -rows[:, 0]))][: self.k]


def blocks(members: np.ndarray, directions: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The members of a list ordered by block, and where each block starts."""
    seeds = members[:: BLOCK]
    if seeds.size == 1:
        return members, np.zeros(1, np.int64)
    nearest = (directions[members] @ directions[seeds].T).argmax(axis=1)
    order = np.argsort(nearest, kind="stable")
    starts = np.flatnonzero(np.diff(nearest[order], prepend=-1))
    return members[order], starts


class Search:
    """Searches shards one after the other for all items.

    weights: of each term, falling; items: the places of each item's terms, rising.
    """

    def __init__(self, weights: np.ndarray, items: list[np.ndarray], k: int = TOP):
        self.weights, self.items = weights, items
        self.best = [Best(k) for _ in items]
        self.asking = [[] for _ in weights]
        for i, places in enumerate(items):
            for t in places:
                self.asking[t].append(i)
        signs = np.random.default_rng(7).integers(0, 2, (weights.size, DIRECTIONS)) * 2 - 1
        self.signs = (signs * weights[:, None]).astype(np.float32)
        self.scored = 0

    def shard(self, ids: np.ndarray, matrix: np.ndarray) -> None:
        """ids: (null, id) of each document; matrix: impacts by document and term."""
        top = matrix.max(axis=0).astype(np.float64) * self.weights
        directions = matrix.astype(np.float32) @ self.signs
        directions /= np.maximum(np.linalg.norm(directions, axis=1, keepdims=True), 1e-9)
        open_ = np.ones((len(self.items), len(ids)), bool)
        # the most that an item's terms from the j-th on can give in this shard
        rest = [np.append(np.cumsum(top[places][::-1])[::-1], 0.0) for places in self.items]
        step = [0] * len(self.items)
        for t in np.flatnonzero(top):
            asking = []
            for i in self.asking[t]:
                j = step[i] = int(np.searchsorted(self.items[i], t))
                if rest[i][j] * (1 + 1e-9) >= self.best[i].floor():
                    asking.append(i)
            if not asking:
                continue
            members, starts = blocks(np.flatnonzero(matrix[:, t]), directions)
            summary = np.maximum.reduceat(matrix[members, t:], starts, axis=0)
            block = np.repeat(np.arange(starts.size), np.diff(np.append(starts, members.size)))
            for i in asking:
                places = self.items[i][step[i] :]
                bound = summary[:, places - t].astype(np.float64) @ self.weights[places]
                held = bound * (1 + 1e-9) >= self.best[i].floor()  # a bound may not fall short by rounding
                taken = members[held[block]]
                taken = taken[open_[i, taken]]
                open_[i, taken] = False
                self.scored += taken.size
                places = self.items[i]
                self.best[i].add(matrix[np.ix_(taken, places)].astype(np.int64) @ self.weights[places], ids[taken])


def _searched(batches, documents: int, length: int, weights: np.ndarray, place: np.ndarray, items, k: int):
    """A task's best documents. place: of a term of the vectors among `weights`, -1 if of no weight."""
    search = Search(weights, items, k)
    rows = max(64, min(SHARD, CELLS // max(weights.size, 1)))
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            part = batch.slice(at, rows)
            n = part.column("n").to_numpy()
            lists = part.column("terms")
            sizes = np.diff(lists.offsets.to_numpy())
            doc = np.repeat(np.arange(part.num_rows), sizes)
            t = place[lists.flatten().to_numpy()]
            value = impacts(part.column("counts").flatten().to_numpy().astype(np.int64), n[doc], documents, length)
            matrix = np.zeros((part.num_rows, weights.size), np.int32)
            matrix[doc[t >= 0], t[t >= 0]] = value[t >= 0]
            ids = part.column("doc_id")
            null = ids.is_null().to_numpy(zero_copy_only=False)
            search.shard(np.column_stack([null, ids.fill_null(0).to_numpy()]).astype(np.int64), matrix)
    for i, best in enumerate(search.best):
        if len(best.rows):
            null = best.rows[:, 1] == 1
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.full(len(best.rows), i, np.int32)),
                    pa.array(best.rows[:, 2], pa.int64(), mask=null),
                    pa.array(best.rows[:, 0]),
                ],
                names=["item", "doc_id", "score"],
            )


def ranked(docs: DataFrame, items: DataFrame, k: int = TOP, items_a_pass: int = ITEMS) -> DataFrame:
    """item_id, rank (from 1), doc_id, score: the k best documents of each item.

    docs: doc_id, text; items: item_id, text.
    """
    spark = docs.sparkSession
    kind = items.schema["item_id"].dataType
    items = scratch_table(items.select("item_id", "text").where("text is not null").distinct(), "items")
    passes = math.ceil(items.count() / items_a_pass)
    found = spark.createDataFrame([], f"item_id {kind.simpleString()}, rank int, doc_id bigint, score bigint")
    share = F.pmod(F.xxhash64("item_id", "text"), F.lit(max(passes, 1)))
    for number in range(passes):
        asked = [(r.item_id, r.raw) for r in items.where(share == number).select("item_id", F.col("text").cast("binary").alias("raw")).collect()]
        if asked:
            found = found.unionByName(_pass(docs, asked, kind, k))
    return found


def _pass(docs: DataFrame, asked: list[tuple], kind, k: int) -> DataFrame:
    spark = docs.sparkSession
    held = [set(terms(bytes(raw))) for _, raw in asked]
    vocabulary = sorted(set().union(*held))
    rows = scratch_table(vectors(docs, vocabulary), "vectors")
    documents, length = rows.agg(F.count_if(F.col("n") > 0), F.coalesce(F.sum("n"), F.lit(0))).first()
    holding = rows.select(F.explode("terms").alias("term")).groupBy("term").count()
    weights = {r["term"]: weight(documents, r["count"]) for r in holding.collect()}
    order = sorted((t for t, w in weights.items() if w > 0), key=lambda t: (-weights[t], t))
    place = np.full(len(vocabulary), -1, np.int64)
    place[order] = np.arange(len(order))
    at = {vocabulary[t]: i for i, t in enumerate(order)}
    sought = [np.array(sorted(at[t] for t in h if t in at), np.int64) for h in held]
    falling = np.array([weights[t] for t in order], np.int64)
    best = rows.where(F.size("terms") > 0).mapInArrow(
        lambda batches: _searched(batches, documents, length, falling, place, sought, k),
        "item int, doc_id bigint, score bigint",
    )
    within = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    names = spark.createDataFrame([(i, item_id) for i, (item_id, _) in enumerate(asked)], f"item int, item_id {kind.simpleString()}")
    return (
        best.withColumn("rank", F.row_number().over(within))
        .where(F.col("rank") <= k)
        .join(F.broadcast(names), "item")  # at most ITEMS rows
        .select("item_id", "rank", "doc_id", "score")
    )
