"""Spelling variants: words one edit apart, and the more frequent word each one belongs to.

Words are counted in all texts; partial counts leave the tasks. Near words are found with
bidirectional FM-indexes of the delimited vocabulary. A word that differs from another by one inserted,
deleted or replaced code point keeps either its first or its second half whole. Hence two
searches: the first half is matched exactly, together with the delimiter before it, from its
end backwards; then the match turns round and goes on over the second half, with one error somewhere.
The second search is its mirror image. While a half is matched, the intervals of suffix ranks of
the text and of the reversed text are kept in step; that is what lets the match turn. Of the
ways to write one edit (a letter of a run may be dropped anywhere in it) only the last in the
direction of the search is followed, and the second search leaves out what has the whole first
half: each pair of words is found exactly once.

The vocabulary is cut into shards of bounded size, once by the order of the words and once by the order
of the reversed words. A half that is matched exactly then stands in one stretch of shards, mostly in
one shard, and only there a word is sought. A shard that many words ask is
built in several tasks, each for some of them. Pairs never leave a task: a word gets from each shard
the number of its near words and the best of them.

Odd cases: a null text has no words, a null id counts as an empty one. Repeated rows count as often as
they come. Words of any length count. An empty table gives no rows; extra columns are ignored. A word
without near words, or whose near words are all too rare, has no form and is its own root.
"""

from __future__ import annotations

import re
import zlib
from bisect import bisect_right
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barsmith.llm.common import ship
from barsmith.session import discard, scratch_table, sized_side

ship(__name__)

# Words of at least so many code points and occurrences; a form is at least so many times as frequent.
LENGTH, COUNT, TIMES = 5, 3, 2
# One run in so many (by the hash of document and run) has lost a letter.
DAMAGED = 97
# code points in a shard, words asking one task, words searched at a time, words that cuts are chosen from
SHARD, ASKING, BATCH, SAMPLE = 1 << 18, 1 << 18, 1 << 14, 20
# A cut between shards is a word of at most so many code points.
LONGEST_CUT = 1000
# different words that a task counts before it passes their counts on
HELD = 400_000
# intervals up to this size are read letter by letter
SMALL = 48
LAST = "\U0010ffff"

# A-Z become lower case and what is no ASCII letter a blank; bytes of longer characters stay.
_LETTERS = bytes(c | 32 if chr(c).isascii() and chr(c).isalpha() else c if c >= 128 else 32 for c in range(256))
# characters beyond ASCII but for U+00C0 to U+00FF, whose first byte in UTF-8 is C3
_OTHER = re.compile(rb"[\xc2\xc4-\xf4][\x80-\xbf]+")


# Words


def add_runs(held: dict, doc_id, raw: bytes) -> None:
    """Add to `held` the words of a text, in UTF-8 as they are, and their counts.

    A-Z are lower-cased and the words damaged by the rule. A word gets no longer by that, so short ones
    are left out before.
    """
    try:
        raw.decode()
    except UnicodeDecodeError:
        raw = raw.decode("utf-8", "replace").encode()
    base, crc32, known = zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode()), zlib.crc32, held.get
    for run, n in Counter(_OTHER.sub(b" ", raw).translate(_LETTERS).split()).items():
        size = len(run)
        if size < LENGTH or not run.isascii() and size - run.count(b"\xc3") < LENGTH:
            continue
        h = crc32(run, base)
        if h % DAMAGED == 0:
            word = run.decode()
            at = h % len(word)
            run = (word[:at] + word[at + 1 :]).encode()
            if len(word) == LENGTH:
                continue
        held[run] = known(run, 0) + n


def vocabulary(docs: DataFrame) -> DataFrame:
    """word, n of the words that are long and frequent enough."""

    def run(batches):
        held = {}

        def flushed():
            return pa.RecordBatch.from_arrays([pa.array(held.keys(), pa.string()), pa.array(held.values(), pa.int64())], names=["word", "n"])

        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                add_runs(held, doc_id, text.as_py() or b"")
                if len(held) >= HELD:
                    yield flushed()
                    held.clear()
        yield flushed()

    texts = docs.select("doc_id", F.col("text").cast("binary").alias("text"))
    counts = texts.mapInArrow(run, "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n"))
    return scratch_table(counts.where(F.col("n") >= COUNT), "vocabulary")


# The index


def rotations(codes: np.ndarray, letters: int) -> np.ndarray:
    """Starts of the rotations of a cyclic text in their order; no two rotations may be equal."""
    n = codes.size
    bits = int(letters).bit_length()
    step = max(1, min(62 // bits, n))
    key = np.zeros(n, np.int64)
    for i in range(step):
        key = (key << bits) | np.roll(codes, -i)
    while True:
        order = np.argsort(key, kind="stable")
        new = np.diff(key[order], prepend=-1) != 0
        rank = np.empty(n, np.int64)
        rank[order] = np.cumsum(new) - 1
        if new.all() or step >= n:
            return order
        key = rank * n + np.roll(rank, -step)
        step *= 2


class Ranks:
    """Counts of letters in the front part of a sequence: of one letter, and of all smaller ones."""

    def __init__(self, sequence: np.ndarray, letters: int):
        self.equal = self._bits([sequence == c for c in range(letters)])
        self.less = self._bits([sequence < c for c in range(letters)])

    @staticmethod
    def _bits(flags):
        size = -(-flags[0].size // 64) * 8 + 8  # one word more, for the place after the last
        bits = np.zeros((len(flags), size), np.uint8)
        for row, flag in zip(bits, flags):
            packed = np.packbits(flag, bitorder="little")
            row[: packed.size] = packed
        bits = bits.view(np.uint64)
        before = np.cumsum(np.bitwise_count(bits), axis=1, dtype=np.int32)
        return bits, np.hstack([np.zeros((len(flags), 1), np.int32), before[:, :-1]])

    @staticmethod
    def count(table, c: np.ndarray, i: np.ndarray) -> np.ndarray:
        bits, before = table
        word = i >> 6
        below = (np.uint64(1) << (i & 63).astype(np.uint64)) - np.uint64(1)
        return before[c, word] + np.bitwise_count(bits[c, word] & below).astype(np.int64)


class Index:
    """A bidirectional FM-index of distinct words: the cyclic text `$word$word...` and its reverse.

    Side 0 is the text, whose intervals grow to the left; side 1 the reversed text, whose
    intervals grow to the right of the text.
    """

    def __init__(self, words: list[str]):
        self.words = len(words)
        points = np.frombuffer(("\0" + "\0".join(words)).encode("utf-32-le"), np.uint32)
        self.alphabet, text = np.unique(points, return_inverse=True)
        text = text.astype(np.int64)  # the delimiter is letter 0
        self.letters, self.size = self.alphabet.size, text.size
        self.first = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=self.letters))])
        starts = np.flatnonzero(text == 0)
        self.sides, self.at, self.word = [], [], []
        for side, codes in enumerate((text, text[::-1])):
            order = rotations(codes, self.letters)
            before = codes[order - 1]
            self.at.append(before)
            self.sides.append(Ranks(before, self.letters))
            # of the rotations that begin with a delimiter: the word after it in the text, or before it
            places = order[: starts.size] if side == 0 else self.size - 1 - order[: starts.size]
            self.word.append((np.searchsorted(starts, places) - side) % starts.size)

    def encode(self, words: list[str], lengths: np.ndarray) -> np.ndarray:
        """Letters of the words, a row each, padded; -1 for letters that the index has not."""
        out = np.full((len(words), int(lengths.max()) if len(words) else 0), -1, np.int64)
        points = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32)
        at = np.minimum(np.searchsorted(self.alphabet, points), self.letters - 1)
        out[np.arange(out.shape[1]) < lengths[:, None]] = np.where(self.alphabet[at] == points, at, -1)
        return out

    def grow(self, side: int, c: np.ndarray, low: np.ndarray, size: np.ndarray):
        """Intervals after one more letter on their own side."""
        ranks = self.sides[side]
        start = ranks.count(ranks.equal, c, low)
        return self.first[c] + start, ranks.count(ranks.equal, c, low + size) - start

    def grow_both(self, side: int, c: np.ndarray, low: np.ndarray, other: np.ndarray, size: np.ndarray):
        """`grow`, and the interval of the other side in step with it."""
        ranks = self.sides[side]
        smaller = ranks.count(ranks.less, c, low + size) - ranks.count(ranks.less, c, low)
        low, size = self.grow(side, c, low, size)
        return low, other + smaller, size

    def branches(self, side: int, low: np.ndarray, size: np.ndarray):
        """(interval, letter) for each different letter, not the delimiter, next to an interval."""
        small = np.flatnonzero(size <= SMALL)
        which = np.repeat(small, size[small])
        ends = np.cumsum(size[small])
        place = np.arange(which.size) - np.repeat(ends - size[small], size[small]) + low[which]
        pairs = [which * self.letters + self.at[side][place]]
        large = np.flatnonzero(size > SMALL)
        pairs.append((large[:, None] * self.letters + np.arange(self.letters)).ravel())
        pairs = np.unique(np.concatenate(pairs))
        which, c = pairs // self.letters, pairs % self.letters
        return which[c > 0], c[c > 0]

    def near(self, words: list[str], second: bool) -> tuple[np.ndarray, np.ndarray]:
        """(word asked, word of the index) for each pair one edit apart that the search meets.

        The first search meets all pairs that share the whole first half (`len // 2`), the
        `second` all others.
        """
        asked, found = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        lengths = np.array([len(w) for w in words], np.int64)
        order = np.argsort(lengths, kind="stable")  # words of a batch are about equally long
        for at in range(0, order.size, BATCH):
            part = order[at : at + BATCH]
            a, b = self._near([words[i] for i in part], lengths[part], second)
            asked.append(part[a])
            found.append(b)
        return np.concatenate(asked), np.concatenate(found)

    def _near(self, words, lengths, second):
        codes = self.encode(words, lengths)
        half = lengths // 2
        rows = np.arange(len(words))
        # the letters in the order the search takes them; a delimiter ends each part
        exact_size, loose_size = (lengths - half, half) if second else (half, lengths - half)
        exact_step, loose_step = (1, -1) if second else (-1, 1)
        exact_from, loose_from = (half, half - 1) if second else (half - 1, half)

        def letter(row, start, step, size, j):
            c = codes[row, np.clip(start[row] + step * j, 0, codes.shape[1] - 1)]
            return np.where(j < size[row], c, 0)

        def loose(row, j):
            return letter(row, loose_from, loose_step, loose_size, j)

        side = 1 if second else 0
        low, other, size = np.zeros(rows.size, np.int64), np.zeros(rows.size, np.int64), np.full(rows.size, self.size)
        alive = rows
        for j in range(int(exact_size.max()) + 1):
            going = alive[exact_size[alive] >= j]
            c = letter(going, exact_from, exact_step, exact_size, j)
            size[going[c < 0]] = 0
            going, c = going[c >= 0], c[c >= 0]
            low[going], other[going], size[going] = self.grow_both(side, c, low[going], other[going], size[going])
            alive = alive[size[alive] > 0]
        side, low = 1 - side, other  # the match turns
        asked, found = [], []

        def follow(row, low, size, j):
            """Match the rest from the j-th letter on without a further error."""
            while row.size:
                c = loose(row, j)
                known = c >= 0
                row, j, c = row[known], j[known], c[known]
                low, size = self.grow(side, c, low[known], size[known])
                on = size > 0
                row, low, size, j, c = row[on], low[on], size[on], j[on] + 1, c[on]
                over = j > loose_size[row]
                asked.append(row[over])
                found.append(self.word[side][low[over]])
                row, low, size, j = row[~over], low[~over], size[~over], j[~over]

        same = np.ones(rows.size, bool)  # the letters taken so far are all the same one
        for j in range(int(loose_size.max()) + 1 if alive.size else 0):
            alive = alive[loose_size[alive] >= j]
            if not alive.size:
                break
            here, ended = loose(alive, j), loose_size[alive] == j
            which, c = self.branches(side, low[alive], size[alive])
            which, c = which[c != here[which]], c[c != here[which]]
            row = alive[which]
            new_low, new_size = self.grow(side, c, low[row], size[row])
            live = new_size > 0
            row, c, which, new_low, new_size = row[live], c[live], which[live], new_low[live], new_size[live]
            replaced = ~ended[which]
            added = np.ones(row.size, bool)
            dropped = ~ended & (here != loose(alive, j + 1))
            if second:  # not what has the whole first half
                first = loose(row, np.zeros(row.size, np.int64))
                added = ~(same[row] & (first == c)) if j else np.zeros(row.size, bool)
                last = letter(alive, exact_from, exact_step, exact_size, 0)
                dropped &= ~(same[alive] & (here == last) & (loose(alive, np.zeros(alive.size, np.int64)) == here))
            gone = alive[dropped]
            follow(
                np.concatenate([row[replaced], row[added], gone]),
                np.concatenate([new_low[replaced], new_low[added], low[gone]]),
                np.concatenate([new_size[replaced], new_size[added], size[gone]]),
                np.concatenate([np.full(replaced.sum(), j + 1), np.full(added.sum(), j), np.full(gone.size, j + 1)]),
            )
            same[alive] &= here == loose(alive, np.zeros(alive.size, np.int64))
            keep = (here >= 0) & ~ended
            alive, here = alive[keep], here[keep]
            low[alive], size[alive] = self.grow(side, here, low[alive], size[alive])
            alive = alive[size[alive] > 0]
        none = np.zeros(0, np.int64)
        return np.concatenate([none, *asked]), np.concatenate([none, *found])


# In Spark


def cuts(words: DataFrame, shard: int = SHARD) -> list[list[str]]:
    """First words of all shards but the first, by words and by reversed words."""
    rows, size = words.agg(F.count("*"), F.coalesce(F.sum(F.length("word") + 1), F.lit(0))).first()
    shards = -(-size // shard)
    if shards < 2:
        return [[], []]
    every = max(1, rows // (shards * SAMPLE))
    chosen = words.where((F.pmod(F.xxhash64("word"), F.lit(every)) == 0) & (F.length("word") <= LONGEST_CUT))
    chosen = [r.word for r in chosen.select("word").collect()]
    out = []
    for keys in (sorted(chosen), sorted(w[::-1] for w in chosen)):
        upto = np.cumsum([len(k) + 1 for k in keys])
        share = upto[-1] / shards if keys else 1
        out.append([keys[i] for i in range(1, len(keys)) if upto[i] // share > upto[i - 1] // share])
    return out


def _routed(words: DataFrame, cut: list[list[str]]) -> DataFrame:
    """Each word as a member of its two shards, and as asking the shards its halves may stand in."""

    def run(batches):
        for batch in batches:
            rows = []
            for word, n in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                half = len(word) // 2
                for order, key, part in ((0, word, word[:half]), (1, word[::-1], word[half:][::-1])):
                    rows.append((order, bisect_right(cut[order], key), word, n))
                    for at in range(bisect_right(cut[order], part), bisect_right(cut[order], part + LAST) + 1):
                        rows.append((order, at, word, None))
            columns = zip(*rows) if rows else [()] * 4
            kinds = [pa.int32(), pa.int32(), pa.string(), pa.int64()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds)], names=["sorted_by", "shard", "word", "n"]
            )

    return words.select("word", "n").mapInArrow(run, "sorted_by int, shard int, word string, n bigint")


def _answers(table: pa.Table) -> pa.Table:
    """For each word asking a shard: the number of its near words there, and the best of them."""
    schema = pa.schema([("word", pa.string()), ("n_near", pa.int64()), ("best_n", pa.int64()), ("best", pa.string())])
    member = table.column("n").is_valid()
    held = table.filter(member).sort_by("word")
    asking = table.filter(pa.compute.invert(member)).column("word").to_pylist()
    words = held.column("word").to_pylist()  # in code-point order
    if not words or not asking:
        return schema.empty_table()
    n = held.column("n").to_numpy()
    asked, found = Index(words).near(asking, bool(table.column("sorted_by")[0].as_py()))
    order = np.lexsort((found, -n[found], asked))
    asked, found = asked[order], found[order]
    first = np.flatnonzero(np.diff(asked, prepend=-1))
    counts = np.diff(np.append(first, asked.size))
    best = found[first]
    return pa.table(
        [
            pa.array([asking[i] for i in asked[first]], pa.string()),
            pa.array(counts, pa.int64()),
            pa.array(n[best], pa.int64()),
            pa.array([words[i] for i in best], pa.string()),
        ],
        schema=schema,
    )


def near_words(words: DataFrame, shard: int = SHARD, asking: int = ASKING) -> DataFrame:
    """word, n, n_near, best, best_n of each word: its near words' number, and the most frequent one."""
    spark = words.sparkSession
    routed = scratch_table(_routed(words, cuts(words, shard)), "routed")
    asked = routed.where("n is null").groupBy("sorted_by", "shard").count()
    tasks = sized_side(asked.select("sorted_by", "shard", F.ceil(F.col("count") / asking).cast("int").alias("tasks")))
    groups = tasks.agg(F.coalesce(F.sum("tasks"), F.lit(0))).first()[0]
    share = F.pmod(F.xxhash64("word"), F.col("tasks")).cast("int")
    of = F.when(F.col("n").isNull(), F.array(share)).otherwise(F.sequence(F.lit(0), F.col("tasks") - 1))
    dealt = routed.join(tasks, ["sorted_by", "shard"]).select("sorted_by", "shard", F.explode(of).alias("share"), "word", "n")
    keys = ["sorted_by", "shard", "share"]
    # a number of partitions of its own: little data is much work here, and must not be merged
    dealt = dealt.repartition(max(2 * groups, 1), *keys)
    answers = dealt.groupBy(*keys).applyInArrow(_answers, "word string, n_near bigint, best_n bigint, best string")
    best = F.struct((-F.col("best_n")).alias("less"), F.col("best").alias("word"))
    none = F.lit(None).cast(f"struct<less bigint, word string>")
    rows = answers.select("word", F.lit(None).cast("bigint").alias("n"), "n_near", best.alias("best")).unionByName(
        words.select("word", "n", F.lit(0).cast("bigint").alias("n_near"), none.alias("best"))
    )
    rows = rows.groupBy("word").agg(F.max("n").alias("n"), F.sum("n_near").alias("n_near"), F.min("best").alias("best"))
    rows = scratch_table(
        rows.select("word", "n", "n_near", F.col("best.word").alias("best"), (-F.col("best.less")).alias("best_n")), "near"
    )
    discard(routed)
    return rows


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) from (word, form), where forms lead to no circle: by doubled steps."""
    hops = scratch_table(forms.select("word", F.col("form").alias("root")), "hops")
    while True:
        further = hops.select(F.col("word").alias("root"), F.col("root").alias("next"))
        hops = scratch_table(
            hops.select("word", "root").join(further, "root", "left").select(
                "word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")
            ),
            "hops",
        )
        if hops.where("moved").isEmpty():
            return hops.select("word", "root")


def variants(docs: DataFrame, shard: int = SHARD, asking: int = ASKING) -> DataFrame:
    """word, form, root, n, n_near, form_n of each word of the texts (doc_id, text)."""
    words = near_words(vocabulary(docs), shard, asking)
    formed = F.col("best_n") >= TIMES * F.col("n")
    words = words.select(
        "word", "n", "n_near", F.when(formed, F.col("best")).alias("form"), F.when(formed, F.col("best_n")).alias("form_n")
    )
    found = roots(words.where(F.col("form").isNotNull()))
    return words.join(found, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
