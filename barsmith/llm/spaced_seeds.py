"""Benchmark decontamination with spaced seeds.

A seed is a fixed mask over consecutive words: the words at its marked places are hashed, those
at the others ignored. Benchmark and document words are hashed under every mask; the hashes are
joined, and each (document, item) pair that met is verified along the diagonals of its hits: a
stretch counts if every window of `WINDOW` words in it has at least `WINDOW - SUBSTITUTIONS`
equal words. Any such window holds a hit of some mask (tests try all placements), so the join
loses none.

Documents are read once, and each text that meets an item goes through one shuffle, with the numbers of all
its items: a passage that many documents and items share makes many results, not many texts. Hashes that cannot be in the benchmark are left out by a Bloom filter of
fixed size (2 MB, whatever the benchmark's size), so that only hits are shuffled, and only
documents with a hit are written.

Words are runs of letters, digits and underscores, in lower case. An item shorter than a window
must occur whole; items of fewer than `SHORTEST` words prove nothing and are left out. Items
with equal texts count as one, with the smallest id; different texts under one id, or without one, are
items of their own. Null texts have no words. A row of a repeated document counts for itself.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barsmith.llm.common import ship
from barsmith.session import scratch_table

ship(__name__)

WINDOW, SUBSTITUTIONS, SHORTEST = 12, 2, 5
MASKS = ("1111011", "11001111", "110101011")
BLOOM_BITS = 24
# Items' texts travel with the tasks up to so many bytes in all; beyond it a document's items come in shares.
ITEM_BYTES, SHARES = 16 << 20, 64
WORD = re.compile(r"\w+")


class Hashes(dict):
    """XXH64 of words, remembered for as many words as fit."""

    def __missing__(self, word: str) -> int:
        if len(self) > 300_000:
            self.clear()
        value = self[word] = xxhash.xxh64_intdigest(word.encode("utf-8", "surrogatepass"))
        return value


def word_hashes(text: str, cache: Hashes) -> np.ndarray:
    found = WORD.findall(text.lower())
    return np.fromiter(map(cache.__getitem__, found), np.uint64, len(found))


def offsets(short: list[int]) -> list[tuple[int, ...]]:
    """The marked places of each seed; short items are seeds without gaps."""
    return [tuple(i for i, c in enumerate(m) if c == "1") for m in MASKS] + [tuple(range(n)) for n in short]


def seeds(words: np.ndarray, places: tuple[int, ...], number: int) -> np.ndarray:
    n = words.size - places[-1]
    if n <= 0:
        return np.zeros(0, np.uint64)
    h = np.full(n, number + 1, np.uint64)
    for p in places:
        h = (h ^ words[p : p + n]) * np.uint64(0x9E3779B97F4A7C15)
        h ^= h >> np.uint64(32)
    return h


def item_seeds(words: np.ndarray, all_places: list[tuple[int, ...]]) -> list[tuple[int, np.ndarray]]:
    """An item's hashes by seed: the masks, or for a short item the seed of its length."""
    n = words.size
    if n >= WINDOW:
        return [(k, seeds(words, p, k)) for k, p in enumerate(all_places[: len(MASKS)])]
    return [(k, seeds(words, p, k)) for k, p in enumerate(all_places) if k >= len(MASKS) and len(p) == n]


def bloom_places(h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return (h >> np.uint64(64 - BLOOM_BITS)).astype(np.int64), (
        (h >> np.uint64(8)) & np.uint64(2**BLOOM_BITS - 1)
    ).astype(np.int64)


def bloom(hashes: DataFrame) -> np.ndarray:
    """The filter's bytes, put together by Spark; at most 2 ** 18 rows of 64 bits come back."""

    def places(batches):
        for b in batches:
            one, two = bloom_places(b.column(0).to_numpy().view(np.uint64))
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([one, two]))], names=["place"])

    words = (
        hashes.select("hash")
        .mapInArrow(places, "place bigint")
        .groupBy(F.shiftright("place", 6).alias("word"))
        .agg(F.bit_or(F.expr("shiftleft(1L, cast(place & 63 as int))")).alias("bits"))
        .toPandas()
    )
    out = np.zeros(2**BLOOM_BITS // 64, np.int64)
    out[words.word.to_numpy(np.int64)] = words.bits.to_numpy(np.int64)
    return out.view(np.uint8)


def in_bloom(bits: np.ndarray, h: np.ndarray) -> np.ndarray:
    one, two = bloom_places(h)
    return ((bits[one >> 3] >> (one & 7)) & (bits[two >> 3] >> (two & 7)) & 1).astype(bool)


def stretches(equal: np.ndarray, window: int, wrong: int) -> list[tuple[int, int]]:
    """Spans covered by windows with at most `wrong` unequal places, without unequal ends."""
    if equal.size < window:
        return []
    total = np.concatenate([[0], np.cumsum(equal)])
    good = np.flatnonzero(total[window:] - total[:-window] >= window - wrong)
    if not good.size:
        return []
    out = []
    for run in np.split(good, np.flatnonzero(np.diff(good) > window) + 1):
        a, b = int(run[0]), int(run[-1]) + window
        hits = np.flatnonzero(equal[a:b])
        out.append((a + int(hits[0]), a + int(hits[-1]) + 1))
    return out


class Seeds(dict):
    """A text's words, and their hashes under each seed, made when they are asked for."""

    def __init__(self, words: np.ndarray, all_places: list[tuple[int, ...]]):
        self.words, self.all_places = words, all_places

    def __missing__(self, k: int) -> np.ndarray:
        value = self[k] = seeds(self.words, self.all_places[k], k)
        return value


def verified(text: Seeds, item: np.ndarray, all_places: list[tuple[int, ...]]):
    """The best stretch as (doc start, end, item start, end, equal words), and the number of the
    item's words that any stretch covers; None if there is no stretch."""
    doc, window = text.words, min(WINDOW, item.size)
    wrong = SUBSTITUTIONS if item.size >= WINDOW else 0
    diagonals: set[int] = set()
    for k, theirs in item_seeds(item, all_places):
        ours = text[k]
        order = np.argsort(theirs, kind="stable")
        low = np.searchsorted(theirs[order], ours)
        high = np.searchsorted(theirs[order], ours, "right")
        for i in np.flatnonzero(high > low):
            diagonals.update((i - order[low[i] : high[i]]).tolist())
    best, covered = None, np.zeros(item.size, bool)
    for d in sorted(diagonals):
        a, b = max(0, d), min(doc.size, d + item.size)
        equal = doc[a:b] == item[a - d : b - d]
        for s, e in stretches(equal, window, wrong):
            covered[a + s - d : a + e - d] |= equal[s:e]
            found = (int(equal[s:e].sum()), a + s, a + e, a + s - d, a + e - d)
            best = max(best, found, key=lambda x: (x[0], -x[1])) if best else found
    return best and (*best[1:], best[0], int(covered.sum()))


def overlaps(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row for each document and benchmark item that overlap.

    doc_id, text_hash (of the document's text), item_id, the best stretch in words of either
    side (ends exclusive), matched (its equal words) and coverage (share of the item's words
    that some stretch covers).
    """
    items = benchmark.where("text is not null").groupBy("text").agg(F.min(F.col("item_id").cast("bigint")).alias("item_id"))
    # ids may be missing or repeated, so each text gets a number of its own
    items = scratch_table(items.withColumn("item", F.monotonically_increasing_id()), "items")

    def lengths(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays(
                [pa.array([min(WINDOW, len(WORD.findall(t.lower()))) for t in b.column(0).to_pylist()], pa.int32())],
                names=["n"],
            )

    short = sorted(r[0] for r in items.select("text").mapInArrow(lengths, "n int").distinct().collect())
    all_places = offsets([n for n in short if SHORTEST <= n < WINDOW])

    def hashed(batches):
        cache = Hashes()
        for b in batches:
            for item, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                h = [x for _, x in item_seeds(word_hashes(text, cache), all_places)]
                h = np.unique(np.concatenate([np.zeros(0, np.uint64), *h]))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(h.view(np.int64)), pa.array([item] * h.size, pa.int64())], names=["hash", "item"]
                )

    theirs = scratch_table(items.select("item", "text").mapInArrow(hashed, "hash bigint, item bigint"), "item-seeds")
    bits = bloom(theirs)

    def hits(batches):
        cache = Hashes()
        for b in batches:
            kept, found = [], []
            for i, text in enumerate(b.column(1).to_pylist()):
                words = word_hashes(text or "", cache)
                mine = [seeds(words, p, k) for k, p in enumerate(all_places)]
                mine = np.concatenate([h[in_bloom(bits, h)] for h in mine])
                if mine.size:
                    kept.append(i)
                    found.append(np.unique(mine).view(np.int64))
            if kept:
                rows = b.take(pa.array(kept))
                yield pa.RecordBatch.from_arrays(
                    [*rows.columns, pa.array(found, pa.list_(pa.int64()))], names=["doc_id", "text", "hits"]
                )

    met = scratch_table(
        docs.select(F.col("doc_id").cast("bigint"), "text")
        .mapInArrow(hits, "doc_id bigint, text string, hits array<bigint>")
        .withColumn("row", F.monotonically_increasing_id()),
        "hits",
    )
    pairs = met.select("row", F.explode("hits").alias("hash")).join(theirs, "hash").select("row", "item").distinct()
    names = ["doc_id", "text_hash", "item_id", "doc_start", "doc_end", "item_start", "item_end", "matched", "coverage"]
    schema = ", ".join(f"{n} {'double' if n == 'coverage' else 'bigint'}" for n in names)
    size = items.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    known = {r.item: (r.item_id, r.text) for r in items.collect()} if size <= ITEM_BYTES else {}
    # what a document is verified against: numbers of items that travel with the tasks, or else their texts
    asked = F.struct("item")
    if not known:
        pairs = pairs.join(items.select("item", "item_id", F.col("text").alias("item_text")), "item")
        asked = F.struct("item", "item_id", "item_text")
    share = F.pmod(F.xxhash64("item"), F.lit(1 if known else SHARES)).alias("share")
    lists = pairs.groupBy("row", share).agg(F.collect_list(asked).alias("asked")).drop("share")

    def verify(batches):
        """A document's text is hashed once for all its items."""
        cache, held, kinds = Hashes(), {}, [pa.int64()] * 8 + [pa.float64()]
        for b in batches:
            for doc_id, text_hash, text, its_items in zip(*b.columns):
                mine, out = Seeds(word_hashes(text.as_py(), cache), all_places), []
                for one in its_items.as_py():
                    item_id, item = known.get(one["item"]) or (one["item_id"], one["item_text"])
                    words = held.get(one["item"])
                    if words is None:
                        words = word_hashes(item, cache)
                        if known:
                            held[one["item"]] = words
                    found = verified(mine, words, all_places)
                    if found:
                        out.append((doc_id.as_py(), text_hash.as_py(), item_id, *found[:5], found[5] / words.size))
                if out:
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names=names)

    texts = met.select("row", "doc_id", F.xxhash64("text").alias("text_hash"), "text")
    both = texts.join(lists, "row").select("doc_id", "text_hash", "text", "asked")
    return both.mapInArrow(verify, schema)
