"""SimHash near-duplicates, found with pivot distance tables.

A fingerprint's row in the pivot table holds its Hamming distances to `PIVOTS` reference
fingerprints, kept apart for each of `BLOCKS` blocks of bits. If two fingerprints differ in at
most `MAX_BITS` bits, then

* at least `BLOCKS - MAX_BITS` blocks are equal, so all the coordinates of these are: documents
  meet only in groups that agree in the coordinates of so many blocks;
* no coordinate, summed over the blocks, differs by more than `MAX_BITS`: pairs beyond are
  discarded by their largest coordinate difference;
* what survives is verified bit by bit.

Equal fingerprints are one node throughout, however many documents have them. A group of more than
`TILE` fingerprints is cut into tiles, and each pair of tiles is a group of its own; a group
gives back one link for each fingerprint at most, the links of a spanning forest.

Defined cases: a null text counts as empty; an empty text has fingerprint zero and is linked
like any other. Null ids are not counted for a component's smallest id; a component of null
ids only has a null id.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barsmith.llm.common import ship, width
from barsmith.llm.components import components
from barsmith.session import scratch_table

ship(__name__)

SHINGLE, MAX_BITS, SEED = 3, 3, 42
BLOCKS, PIVOTS, TILE = 5, 8, 2048


def simhash(text: str, n: int = SHINGLE) -> int:
    """The fingerprint as an unsigned number."""
    w = text.encode("utf-8", "surrogatepass").lower().split()
    if not w:
        return 0
    if len(w) < n:
        shingles = [b" ".join(w)]
    else:
        shingles = map(b" ".join, zip(*(w[i:] for i in range(n))))
    h, seed = xxhash.xxh64_intdigest, SEED
    values = np.array([h(s, seed) for s in shingles], ">u8")
    ones = np.zeros(64, np.int64)
    for i in range(0, values.size, 65536):
        part = values[i : i + 65536]
        ones += np.unpackbits(part.view(np.uint8).reshape(part.size, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > values.size).tobytes(), "big")


def fingerprints(docs: DataFrame, n: int = SHINGLE, with_text_hash: bool = False) -> DataFrame:
    """doc_id, fp (the 64 bits as a bigint); asked for, text_hash, Spark's xxhash64 of the text."""
    names = ["doc_id", "text_hash", "fp"] if with_text_hash else ["doc_id", "fp"]

    def run(batches):
        for b in batches:
            found = np.array([simhash(t or "", n) for t in b.column(b.num_columns - 1).to_pylist()], np.uint64)
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array(found.view(np.int64))], names=names)

    hashed = [F.xxhash64("text").alias("text_hash")] if with_text_hash else []
    return docs.select(F.col("doc_id").cast("bigint"), *hashed, "text").mapInArrow(
        run, ", ".join(f"{c} bigint" for c in names)
    )


def block_masks() -> list[int]:
    edges = [64 * i // BLOCKS for i in range(BLOCKS + 1)]
    return [(1 << b) - (1 << a) for a, b in zip(edges, edges[1:])]


def pivots() -> np.ndarray:
    """Reference fingerprints: XXH64 values of their numbers."""
    return np.array([xxhash.xxh64_intdigest(str(i).encode(), SEED) for i in range(PIVOTS)], np.uint64)


def distances(fp: np.ndarray) -> np.ndarray:
    """The pivot table: (fingerprint, block, pivot)."""
    apart = fp[:, None] ^ pivots()[None, :]
    return np.stack([np.bitwise_count(apart & np.uint64(m)) for m in block_masks()], axis=1)


def keys(fp: np.ndarray, bits: int = MAX_BITS) -> list[np.ndarray]:
    """For each choice of blocks that could be equal, a number for their coordinates."""
    table = distances(fp).astype(np.uint64)
    shift = np.arange(PIVOTS, dtype=np.uint64) * np.uint64(4)
    packed = (table << shift).sum(axis=2, dtype=np.uint64)
    odd = np.uint64(0x9E3779B97F4A7C15)
    out = []
    for chosen in combinations(range(BLOCKS), BLOCKS - bits):
        k = np.zeros(fp.size, np.uint64)
        for b in chosen:
            k = (k ^ packed[:, b]) * odd
            k ^= k >> np.uint64(29)
        out.append(k)
    return out


def linked(fp: np.ndarray, group: np.ndarray, side: np.ndarray, bits: int = MAX_BITS):
    """Positions of the links (i, j) within groups of consecutive equal `group`.

    side: 0 where all pairs of a group count; else 1 and 2, and pairs of different sides do.
    """
    n = fp.size
    coordinates = distances(fp).sum(axis=1, dtype=np.int16)
    edge = np.flatnonzero(np.append(group[1:] != group[:-1], True))
    end = edge[np.searchsorted(edge, np.arange(n))]
    left, right, step, at = [], [], 0, np.arange(n)
    while True:
        step += 1
        at = at[at + step <= end[at]]
        if not at.size:
            break
        i, j = at, at + step
        keep = (side[i] == 0) | (side[i] != side[j])
        i, j = i[keep], j[keep]
        for p in range(PIVOTS):
            near = np.abs(coordinates[i, p] - coordinates[j, p]) <= bits
            i, j = i[near], j[near]
        near = np.bitwise_count(fp[i] ^ fp[j]) <= bits
        left.append(i[near])
        right.append(j[near])
    none = np.zeros(0, np.int64)
    return np.concatenate([none, *left]), np.concatenate([none, *right])


def forest(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The smallest position that each position is linked to."""
    root = np.arange(n)
    while True:
        low = np.minimum(root[a], root[b])
        new = root.copy()
        np.minimum.at(new, a, low)
        np.minimum.at(new, b, low)
        np.minimum.at(new, root[a], low)
        np.minimum.at(new, root[b], low)
        new = new[new]
        if (new == root).all():
            return root
        root = new


def links(distinct: DataFrame, bits: int = MAX_BITS) -> DataFrame:
    """(a, b): links between different fingerprints `fp` that connect what `bits` bits connect."""

    def grouped(batches):
        for batch in batches:
            fp = batch.column(0).to_numpy().view(np.uint64)
            for choice, k in enumerate(keys(fp, bits)):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(fp.size, choice, np.int32)), pa.array(k.view(np.int64)), batch.column(0)],
                    names=["choice", "key", "fp"],
                )

    rows = scratch_table(
        distinct.select("fp").mapInArrow(grouped, "choice int, key bigint, fp bigint"), "pivot-groups"
    )
    sizes = rows.groupBy("choice", "key").agg(F.count("*").alias("n")).where("n > 1")
    # a tile's number, and its meetings with itself and with each other tile
    tiles = F.ceil(F.col("n") / TILE).cast("int")
    tile = F.pmod(F.xxhash64("fp", "choice"), tiles).cast("int")
    met = F.transform(
        F.sequence(F.lit(0), tiles - 1),
        lambda t: F.struct(
            F.least(t, tile).alias("low"),
            F.greatest(t, tile).alias("high"),
            F.when(t == tile, 0).when(tile < t, 1).otherwise(2).alias("side"),
        ),
    )
    # one partition has whole groups (choice, key, low, high), each of at most about two tiles
    meetings = (
        rows.join(sizes, ["choice", "key"])
        .select("choice", "key", "fp", F.explode(met).alias("met"))
        .select(F.xxhash64("choice", "key", "met.low", "met.high").alias("group"), "fp", "met.side")
        .repartition(width(rows.sparkSession), "group")
        .sortWithinPartitions("group", "fp")
    )

    def spanned(batches):
        def links_of(rows):
            group, fp, side = rows
            fp = fp.view(np.uint64)
            a, b = linked(fp, group, side, bits)
            root = forest(fp.size, a, b)
            hung = np.flatnonzero(root != np.arange(fp.size))
            return pa.RecordBatch.from_arrays(
                [pa.array(fp[hung].view(np.int64)), pa.array(fp[root[hung]].view(np.int64))], names=["a", "b"]
            )

        held = [np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int32)]
        for batch in batches:
            held = [np.concatenate([h, c.to_numpy()]) for h, c in zip(held, batch.columns)]
            if not held[0].size:
                continue
            cut = int(np.searchsorted(held[0], held[0][-1]))  # the last group may go on
            if cut:
                yield links_of([h[:cut] for h in held])
                held = [h[cut:] for h in held]
        if held[0].size:
            yield links_of(held)

    return meetings.mapInArrow(spanned, "a bigint, b bigint")


def groups(prints: DataFrame, bits: int = MAX_BITS) -> DataFrame:
    """(fp, root, component_id): each distinct fingerprint with its component's smallest
    fingerprint and the smallest doc_id it is linked to.

    prints: doc_id, fp, better a written table: it is read twice.
    """
    distinct = scratch_table(prints.groupBy("fp").agg(F.min("doc_id").alias("first")), "fingerprints")
    roots = components(links(distinct, bits))
    rooted = distinct.join(roots, distinct.fp == roots.node, "left").select(
        "fp", "first", F.coalesce("root", "fp").alias("root")
    )
    rooted = scratch_table(rooted, "rooted")
    lowest = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    return scratch_table(rooted.join(lowest, "root").select("fp", "root", "component_id"), "groups")


def near_duplicates(docs: DataFrame, n: int = SHINGLE, bits: int = MAX_BITS) -> DataFrame:
    """doc_id, fp, component_id of every document."""
    prints = scratch_table(fingerprints(docs, n), "prints")
    found = groups(prints, bits).select(F.col("fp").alias("of"), "component_id")
    return prints.join(found, prints.fp == found.of).select("doc_id", "fp", "component_id")


def shown(fp) -> F.Column:
    """16 lower-case hex digits."""
    return F.lower(F.lpad(F.hex(fp), 16, "0"))
