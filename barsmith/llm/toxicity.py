"""Toxicity by non-negative positive-unlabelled (PU) learning.

Only documents confirmed as toxic are used as labelled examples; the other class is never
labelled. A classifier is fitted to the risk

    prior * E_p[l(z)] + (1 - prior) / (1 - hidden) * max(0, E_u[l(-z)] - hidden * E_p[l(-z)])

over positives p and unlabelled documents u: the unlabelled set holds hidden positives,
whose part is taken out again, and the estimate of a risk cannot be below zero. Where it is, the
step goes back up that term. The confirmed documents are not in the unlabelled set, so fewer are hidden there
than the class prior says: of a share c of labelled documents, hidden = prior * (1 - c) / (1 - prior * c).
l is the logistic loss, so scores are probabilities among all documents.

`Params.positives` and `Params.unlabelled` bound the sample that is fitted (lowest hashes of
the ids); the prior is counted over all labels, and every whole document is scored.

Defined cases: a null text counts as empty, and an empty text scores as the bias alone. A
null id is held out. A document with several label rows is toxic if one of them says so; null
labels say nothing. Of several rows with one id the text of the smallest hash is learnt from, and each row
is scored. Without a confirmed toxic document every score is 0. `score` needs a column name that the frame
has not; `fresh` makes one.
"""

from __future__ import annotations

import math
import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barsmith.llm.common import fold, ship, with_text_column
from barsmith.session import scratch_table

ship(__name__)

FOLDS = 5
WORD = re.compile(r"[^\W\d_]+")


@dataclass(frozen=True)
class Params:
    """positives, unlabelled: most documents of each kind in the fitted sample. classifiers:
    each sees all the positives and its own part of the unlabelled. vocabulary: words kept by
    a classifier at most, those that tell its two sets apart best, by `apart` standard errors
    or more. l2, steps, rate: of the descent."""

    positives: int = 2000
    unlabelled: int = 12000
    classifiers: int = 4
    vocabulary: int = 1000
    apart: float = 5.0
    l2: float = 2e-4
    steps: int = 400
    rate: float = 0.05


def words(text: str) -> set[str]:
    return set(WORD.findall(text.lower()))


def confirmed(labels: DataFrame) -> DataFrame:
    """doc_id, toxic (0/1) of the labelled documents one may learn from."""
    return (
        labels.select("doc_id", F.col("toxic").cast("int").alias("toxic"))
        .where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull())
        .where(fold("doc_id", FOLDS) != 0)
        .groupBy("doc_id")
        .agg(F.max("toxic").alias("toxic"))
    )


def nnpu(codes: np.ndarray, rows: np.ndarray, positive: np.ndarray, size: int, prior: float, hidden: float, p: Params):
    """Weights and bias of one linear classifier over word presence.

    codes, rows: word and document of each presence; positive: of each document; hidden: the share of
    positives among the others.
    """
    whole = (1 - prior) / (1 - hidden)
    n_pos, n_unl = max(1, positive.sum()), max(1, (~positive).sum())
    w = np.zeros(size + 1)
    w[-1] = math.log(prior / (1 - prior))
    m, v = np.zeros_like(w), np.zeros_like(w)
    for step in range(1, p.steps + 1):
        z = np.bincount(rows, w[codes], positive.size) + w[-1]
        s = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
        loss_neg = np.logaddexp(0, z)
        negative = loss_neg[~positive].mean() - hidden * loss_neg[positive].mean()
        as_pos = np.where(positive, prior * (s - 1) / n_pos, 0)
        as_neg = whole * np.where(positive, -hidden * s / n_pos, s / n_unl)
        g = as_pos + as_neg if negative >= 0 else -as_neg
        grad = np.append(np.bincount(codes, g[rows], size), g.sum())
        grad[:-1] += p.l2 * w[:-1]
        m, v = 0.9 * m + 0.1 * grad, 0.99 * v + 0.01 * grad**2
        w -= p.rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
    return w[:-1], w[-1]


def fit_group(prior: float, hidden: float, p: Params):
    def fit(group: pa.Table) -> pa.Table:
        lists = group["words"].combine_chunks()
        positive = np.asarray(group["positive"].to_numpy(), bool)
        if not positive.any() or positive.all():
            return pa.table({"part": [0], "word": [None], "weight": [-30.0]}, schema=MODEL)
        coded = lists.flatten().dictionary_encode()
        codes = coded.indices.to_numpy()
        rows = np.repeat(np.arange(len(lists)), lists.value_lengths().to_numpy())
        size = len(coded.dictionary)
        in_pos = np.bincount(codes[positive[rows]], minlength=size)
        in_unl = np.bincount(codes[~positive[rows]], minlength=size)
        share_p, share_u = in_pos / positive.sum(), in_unl / (~positive).sum()
        pooled = (in_pos + in_unl) / positive.size
        spread = np.sqrt(pooled * (1 - pooled) * (1 / positive.sum() + 1 / (~positive).sum()))
        apart = np.where(in_pos + in_unl >= 3, np.abs(share_p - share_u) / (spread + 1e-9), 0)
        vocabulary = np.asarray(coded.dictionary.to_pylist(), object)
        kept = np.lexsort((vocabulary, -apart))[: p.vocabulary]
        kept = kept[apart[kept] > p.apart]
        place = np.full(size, -1)
        place[kept] = np.arange(kept.size)
        known = place[codes] >= 0
        weights, bias = nnpu(place[codes[known]], rows[known], positive, kept.size, prior, hidden, p)
        part = group["part"][0].as_py()
        return pa.table(
            {
                "part": [part] * (kept.size + 1),
                "word": [None, *vocabulary[kept]],
                "weight": [bias, *weights],
            },
            schema=MODEL,
        )

    return fit


MODEL = pa.schema([("part", pa.int32()), ("word", pa.string()), ("weight", pa.float64())])


def fit(docs: DataFrame, labels: DataFrame, p: Params = Params()) -> list[tuple[dict, float]]:
    """The classifiers: weights by word, and a bias. Bounded by the parameters alone."""
    known = scratch_table(confirmed(labels), "labels")
    prior = known.agg(F.avg("toxic")).first()[0] or 0.0
    if prior <= 0:
        return []
    prior = min(prior, 0.95)
    learnt = docs.select("doc_id").where(F.col("doc_id").isNotNull() & (fold("doc_id", FOLDS) != 0)).distinct()
    count, labelled = learnt.join(known, "doc_id", "left").agg(F.count("*"), F.count("toxic")).first()
    c = labelled / max(count, 1)
    hidden = prior * (1 - c) / (1 - prior * c)
    positives = (
        known.where("toxic = 1").select("doc_id").orderBy(F.xxhash64("doc_id"), "doc_id").limit(p.positives)
    )
    unlabelled = (
        learnt.join(known.where("toxic = 1"), "doc_id", "left_anti")
        .orderBy(F.xxhash64(F.lit(1), "doc_id"), "doc_id")
        .limit(p.unlabelled)
    )
    parts = F.explode(F.sequence(F.lit(0), F.lit(p.classifiers - 1)))
    sample = scratch_table(
        positives.select(F.col("doc_id").alias("id"), F.lit(True).alias("positive"), parts.alias("part")).unionByName(
            unlabelled.select(
                F.col("doc_id").alias("id"),
                F.lit(False).alias("positive"),
                F.pmod(F.xxhash64(F.lit(2), "doc_id"), F.lit(p.classifiers)).cast("int").alias("part"),
            )
        ),
        "sample",
    )
    ids = F.broadcast(sample.select("id").distinct())  # at most 2,000 + 12,000 rows
    texts = docs.select(F.col("doc_id").alias("id"), "text").join(ids, "id")
    # one text an id, however many rows have it
    texts = texts.groupBy("id").agg(F.min_by("text", F.xxhash64("text")).alias("text"))
    chosen = texts.join(F.broadcast(sample), "id").select("part", "positive", "text")

    def presences(batches):
        for b in batches:
            found = [sorted(words(t or "")) for t in b.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array(found, pa.list_(pa.string()))], names=["part", "positive", "words"]
            )

    fitted = (
        chosen.mapInArrow(presences, "part int, positive boolean, words array<string>")
        .groupBy("part")
        .applyInArrow(fit_group(prior, hidden, p), "part int, word string, weight double")
        .toPandas()
    )
    out = []
    for _, rows in fitted.groupby("part"):
        weights = rows[rows.word.notna()]
        out.append((dict(zip(weights.word, weights.weight)), float(rows[rows.word.isna()].weight.iloc[0])))
    return out


def scorer(classifiers: list[tuple[dict, float]]):
    """A function from a text to the mean probability of the classifiers."""
    vocabulary = sorted({w for weights, _ in classifiers for w in weights})
    rows = {w: np.array([weights.get(w, 0.0) for weights, _ in classifiers]) for w in vocabulary}
    known, biases = frozenset(rows), np.array([b for _, b in classifiers])

    def score(text: str) -> float:
        if not classifiers:
            return 0.0
        z = biases.copy()
        for w in sorted(known.intersection(words(text))):
            z += rows[w]
        return float((1 / (1 + np.exp(-np.clip(z, -500, 500)))).mean())

    return score


def score(docs: DataFrame, classifiers: list[tuple[dict, float]], name: str = "score") -> DataFrame:
    """Add each document's probability of being toxic."""
    return with_text_column(docs, "text", name, "double", lambda: scorer(classifiers))
