"""Fingerprints: SimHash groups and order MinHash against plain versions."""

import hashlib
import random

import numpy as np
import xxhash
from conftest_llm import ODD, fixture_texts
from pyspark.sql import functions as F

from barsmith.llm import order_minhash, simhash
from barsmith.llm.components import components


def plain_simhash(text):
    words = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)
    for c in "\t\n\v\f\r":
        words = words.replace(c, " ")
    words = [w for w in words.split(" ") if w]
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_groups(prints):
    """Smallest position reachable over at most three bits."""
    root = list(range(len(prints)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(prints)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= 3:
                a, b = sorted((find(i), find(j)))
                root[b] = a
    return [find(i) for i in range(len(prints))]


def test_simhash_matches_the_definition():
    for text in ["One two  THREE four five Ä", "a", "", "a b", *fixture_texts(20)]:
        assert simhash.simhash(text) == plain_simhash(text)


def test_near_duplicates(docs):
    texts = ODD + fixture_texts(500)
    got = {r.doc_id: r for r in simhash.near_duplicates(docs(texts)).collect()}
    prints = [simhash.simhash(t or "") for t in texts]
    want = plain_groups(prints)
    assert len(got) == len(texts)
    for i in range(len(texts)):
        assert got[i].fp % 2**64 == prints[i] and got[i].component_id == want[i]


def prints_frame(spark, prints):
    signed = [int(np.uint64(p).astype(np.int64)) for p in prints]
    return spark.createDataFrame(list(enumerate(signed)), "doc_id bigint, fp bigint")


def test_links_of_random_and_dense_prints(spark, monkeypatch):
    rng = random.Random(3)
    prints = [rng.getrandbits(64) for _ in range(60)]
    for p in list(prints[:20]):  # pairs at each distance, and chains of three bits each
        for d in range(1, 7):
            q = p
            for b in rng.sample(range(64), d):
                q ^= 1 << b
            prints.append(q)
    centre = rng.getrandbits(64)
    prints += [centre ^ (1 << a) ^ (1 << b) for a in range(20) for b in range(a)]
    want = plain_groups(prints)
    for tile in (simhash.TILE, 16):  # whole groups, and groups cut into tiles
        monkeypatch.setattr(simhash, "TILE", tile)
        frame = prints_frame(spark, prints)
        got = frame.join(simhash.groups(frame), "fp").select("doc_id", "component_id").collect()
        assert dict(map(tuple, got)) == dict(enumerate(want))


def test_null_ids_and_no_rows(docs, spark):
    frame = docs([(None, "one two three four", "s"), (7, "one two three four", "s"), (None, "other words entirely here", "s")])
    got = sorted((str(r.doc_id), str(r.component_id)) for r in simhash.near_duplicates(frame).collect())
    assert got == [("7", "7"), ("None", "7"), ("None", "None")]
    assert simhash.near_duplicates(docs([])).count() == 0


def test_components_of_long_paths(spark):
    n = 700
    links = spark.range(n - 1).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b"))
    rows = components(links).collect()
    assert len(rows) == n - 1 and {r.root for r in rows} == {0}
    assert components(links.limit(0)).count() == 0


def plain_order_minhash(text):
    """The same sketch from its description, with lists."""
    if not text:
        return [0] * order_minhash.LANES
    k, top = order_minhash.K, 2**64
    codes = [ord(c) for c in text] + [0] * (k - len(text))

    def mix(x):
        x = ((x ^ x >> 31) * 0x7FB5D329728EA185) % top
        x = ((x ^ x >> 27) * 0x81DADEF4BC2DD44D) % top
        return x ^ x >> 33

    seen, points = {}, []
    for i in range(len(codes) - k + 1):
        h = 0
        for c in codes[i : i + k]:
            h = (h * 0x9E3779B97F4A7C15 + c) % top
        h = mix(h)
        number = seen[h] = seen.get(h, -1) + 1
        points.append((mix((h + number * 0xD1B54A32D192ED03) % top), i))
    circle, out = sorted(points), []
    for lane in range(order_minhash.LANES):
        start = lane * (top // order_minhash.LANES)
        first = sum(h < start for h, _ in circle)
        chosen = sorted((circle[(first + j) % len(circle)] for j in range(min(order_minhash.TUPLE, len(circle)))), key=lambda p: p[1])
        acc = chosen[0][0]
        for h, _ in chosen[1:]:
            acc = mix((acc * 0xA0761D6478BD642F + h) % top)
        out.append(acc >> 48)
    return out


def test_order_minhash_matches_the_definition():
    for text in ["", "a", "abcdef", "abababababababab", "Ein längerer Satz, der nicht viel sagt. 🙂" * 3, *fixture_texts(5)]:
        assert order_minhash.fingerprint(text[:3000]).tolist() == plain_order_minhash(text[:3000])


def test_order_minhash_follows_the_edit_distance():
    rng = random.Random(1)
    text = "".join(rng.choice("abcdefgh ") for _ in range(3000))
    own = order_minhash.fingerprint(text)
    shares = [order_minhash.likeness(own, order_minhash.fingerprint(text[: 3000 - n] + "z" * n)) for n in (0, 30, 300, 1000, 2900)]
    assert shares[0] == 1 and shares == sorted(shares, reverse=True) and shares[-1] < 0.1
    swapped = text[1500:] + text[:1500]  # the same k-mers but for one place, in another order
    assert order_minhash.likeness(own, order_minhash.fingerprint(swapped)) < 0.75


def test_compared_with_edited_and_next(docs):
    texts = ODD + fixture_texts(120)
    ids = [None, *random.Random(2).sample(range(-50, 5000), len(texts) - 1)]
    got = {r.doc_id: r for r in order_minhash.compared(docs([(i, t, "s") for i, t in zip(ids, texts)])).collect()}
    order = sorted(range(len(texts)), key=lambda j: (ids[j] is not None, ids[j] or 0))
    assert len(got) == len(texts)
    for at, j in enumerate(order):
        text, following = texts[j] or "", texts[order[(at + 1) % len(order)]] or ""
        n = len(text) // 4
        edited = text[: len(text) - n] + following[:n]
        row = got[ids[j]]
        assert row.n_chars == len(text) and row.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert row.fingerprint == order_minhash.shown(order_minhash.fingerprint(text))
        assert row.edited_fingerprint == order_minhash.shown(order_minhash.fingerprint(edited))
        assert 0 <= row.near_next <= row.near_edited + 1 <= 2


def test_compared_repeated_ids_and_few_rows(docs):
    got = order_minhash.compared(docs([(1, "bbbbbbbb", "s"), (1, "aaaaaaaa", "s"), (2, "cccc", "s")])).collect()
    assert sorted((r.doc_id, r.n_chars) for r in got) == [(1, 8), (1, 8), (2, 4)]
    one = order_minhash.compared(docs([(5, "abcdefgh", "s")])).first()
    assert one.near_next == 1 and one.edited_sha256 == hashlib.sha256(b"abcdefab").hexdigest()
    assert order_minhash.compared(docs([])).count() == 0
