"""Benchmark passages, licenses and quotations."""

import itertools
import random

import numpy as np
from conftest_llm import ODD, fixture_texts

from barsmith.llm import licenses, quotes, spaced_seeds


def test_masks_meet_every_window_with_substitutions():
    for wrong in itertools.combinations(range(spaced_seeds.WINDOW), spaced_seeds.SUBSTITUTIONS):
        assert any(
            all(at + i not in wrong for i, c in enumerate(mask) if c == "1")
            for mask in spaced_seeds.MASKS
            for at in range(spaced_seeds.WINDOW - len(mask) + 1)
        )


def plain_overlap(doc, item):
    """Whether a window of the item stands in the document with few enough words changed."""
    n = min(spaced_seeds.WINDOW, len(item))
    wrong = spaced_seeds.SUBSTITUTIONS if len(item) >= spaced_seeds.WINDOW else 0
    if len(item) < spaced_seeds.SHORTEST:
        return False
    return any(
        sum(a != b for a, b in zip(doc[i : i + n], item[j : j + n])) <= wrong
        for i in range(len(doc) - n + 1)
        for j in range(len(item) - n + 1)
    )


def test_overlaps(docs, spark):
    rng = random.Random(4)
    words = [f"w{i}" for i in range(12)]
    items = [[rng.choice(words) for _ in range(n)] for n in (4, 5, 8, 11, 12, 20, 40)]
    texts = []
    for _ in range(150):
        item = rng.choice(items)
        a = rng.randrange(len(item))
        part = [w if rng.random() > 0.12 else "other" for w in item[a : a + rng.randint(5, 25)]]
        texts.append([rng.choice(words) for _ in range(rng.randint(0, 15))] + part + [rng.choice(words) for _ in range(9)])
    bench = [(i, " ".join(t)) for i, t in enumerate(items)] + [(90, " ".join(items[5])), (91, None), (92, "")]
    frame = spark.createDataFrame(bench, "item_id bigint, text string")
    found = spaced_seeds.overlaps(docs([" ".join(t).upper() + "!" for t in texts] + ODD).select("doc_id", "text"), frame).collect()
    want = {(i, k) for i, t in enumerate(texts) for k, item in enumerate(items) if plain_overlap(t, item)}
    assert {(r.doc_id, r.item_id) for r in found} == want and len(found) == len(want) > 20
    for r in found:
        ours, theirs = texts[r.doc_id][r.doc_start : r.doc_end], items[r.item_id][r.item_start : r.item_end]
        assert len(ours) == len(theirs) and sum(a == b for a, b in zip(ours, theirs)) == r.matched and 0 < r.coverage <= 1


def test_overlaps_of_empty_tables(docs, spark):
    bench = spark.createDataFrame([(1, "one two three four five six seven")], "item_id bigint, text string")
    assert spaced_seeds.overlaps(docs([]), bench).count() == 0
    assert spaced_seeds.overlaps(docs(ODD), bench.limit(0)).count() == 0


def plain_alignment(template, doc):
    """Best score and equal words of a local alignment without a band."""
    best, before = (0, 0), [(0, 0)] * (len(doc) + 1)
    for t in template:
        row = [(0, 0)]
        for i, d in enumerate(doc):
            step = (before[i][0] + (1 if t == d else -1), before[i][1] + (t == d))
            one = max(step, (before[i + 1][0] - 1, before[i + 1][1]), (row[i][0] - 1, row[i][1]))
            row.append(one if one[0] > 0 else (0, 0))
            best = max(best, row[-1])
        before = row
    return best


def test_alignment_in_a_wide_band_is_the_plain_one():
    rng = random.Random(5)
    for _ in range(200):
        template = [rng.randint(1, 9) for _ in range(rng.randint(3, 20))]
        doc = [w for w in template if rng.random() > 0.1]
        doc = [rng.randint(0, 9) if rng.random() < 0.1 else w for w in doc]
        doc = [rng.randint(0, 9) for _ in range(5)] + doc + [rng.randint(0, 9) for _ in range(5)]
        matched, begin, end = licenses.aligned(np.array(template), np.array(doc), -50, 50)
        _, equal = plain_alignment(template, doc)
        assert matched == equal and 0 <= begin <= end <= len(doc)


def test_licenses_in_texts(docs):
    mit = licenses.TEMPLATES["MIT"]
    changed = mit.replace("free of charge", "gratis").replace("publish, ", "")
    texts = [
        f"Words before. {mit} And after.",
        f"# {changed.upper()}",
        "Licensed   under the\nApache License; Version 2.0!",
        "Licensed under CC BY-NC 4.0.",
        "We talk about the license of a driver, under the rules.",
        *ODD,
    ]
    found = licenses.findings(docs(texts)).collect()
    got = {(r.doc_id, r.license): r for r in found}
    assert set(got) == {(0, "MIT"), (1, "MIT"), (2, "Apache-2.0-notice"), (3, "CC-BY-NC-4.0-notice")}
    assert texts[0][got[0, "MIT"].start : got[0, "MIT"].end] == mit and got[0, "MIT"].coverage == 1
    assert 0.85 < got[1, "MIT"].coverage < 1
    assert texts[2][got[2, "Apache-2.0-notice"].start :].startswith("Licensed")
    assert licenses.findings(docs([])).count() == 0


def test_whole_licenses_are_told_from_parts(docs):
    """Whole texts are found from their first to their last word, as themselves; parts only as parts."""
    whole = {k: t for k, t in licenses.TEMPLATES.items() if not k.endswith(("notice", "excerpt"))}
    assert {"MIT", "ISC", "BSD-2-Clause", "BSD-3-Clause", "Apache-2.0", "GPL-3.0", "LGPL-2.1", "MPL-2.0", "CC0-1.0",
            "Unlicense", "EPL-1.0", "AGPL-3.0-header"} <= set(whole)
    names = list(whole)
    part = " ".join(whole["MIT"].split()[:90])
    texts = [f"Here follows: {whole[k]}, so it was." for k in names] + [part]
    rows = licenses.findings(docs(texts)).collect()
    got = {r.doc_id: r for r in rows}
    for i, k in enumerate(names):
        found = licenses.WORD.findall(texts[i][got[i].start : got[i].end])
        assert (got[i].license, got[i].coverage, found) == (k, 1, licenses.WORD.findall(whole[k])), k
    assert got[len(names)].license == "MIT-excerpt" and len(rows) == len(texts)


def test_licenses_find_every_adjacent_copy(docs):
    """Copies of the short notices, next to each other or a word apart, are found one by one."""
    notices = {k: t.rstrip(".") for k, t in licenses.TEMPLATES.items() if k.endswith("notice")}
    cases = [(k, gap, n) for k in notices for gap in (" ", " and ", ". So two ") for n in (2, 3, 4, 7)]
    texts = [gap.join([notices[k]] * n) for k, gap, n in cases]
    got = [(r.doc_id, r.license, texts[r.doc_id][r.start : r.end]) for r in licenses.findings(docs(texts)).collect()]
    assert sorted(got) == sorted((i, k, notices[k]) for i, (k, _, n) in enumerate(cases) for _ in range(n))


def test_licenses_of_the_fixture(docs):
    texts = fixture_texts(1000)
    found = {r.doc_id for r in licenses.findings(docs(texts)).collect()}
    notices = [t for k, t in licenses.TEMPLATES.items() if k.endswith("notice")]
    assert {i for i, t in enumerate(texts) if any(n.rstrip(".") in t for n in notices)} <= found


def test_passages():
    own, wrote, quoted = quotes.passages("On Monday Ann wrote:\n> > deep\n> > words\n>\n> reply\n\nmine\nalso\n\nmore")
    assert own == "mine\nalso\n\nmore" and len(wrote) == 2 and [len(q) for q in quoted] == [1, 1]
    assert quoted[1] == quotes.passages("Deep words!")[1]
    assert quotes.passages("") == ("", [], [])


def test_links(spark):
    rows = [
        ("t", 1, "first words"),
        ("t", 2, "> first\n> words\n\nsecond"),
        ("t", 3, "> > first words\n>\n> second\n\nthird"),
        ("t", 4, "> first words\n\nfourth"),
        ("t", 5, "first words"),
        ("t", 6, "> nobody wrote this\n\nsixth"),
        ("u", 1, "> first words\nelsewhere"),
        (None, 9, "> first words"),
        ("t", None, None),
        ("t", 4, "> first words\n\nfourth"),
    ]
    frame = spark.createDataFrame(rows, "thread string, at int, body string")
    got = [tuple(r) for r in quotes.linked(frame, "thread", "at", "body").collect()]
    found = {(r[0], r[1]): r[2:] for r in got}
    assert len(got) == len(rows)
    assert found["t", 2] == (1, 1, 1, 1, 1, "second")
    assert found["t", 3] == (2, 1, 2, 2, 2, "third")
    assert found["t", 4] == (1, 1, 1, 1, 1, "fourth")
    assert found["t", 5] == (None, 5, 0, 0, 0, "first words")
    assert found["t", 6] == (None, 6, 0, 1, 0, "sixth")
    assert found["u", 1][0] is None and found[None, 9][0] is None and found["t", None] == (None, None, 0, 0, 0, "")


def test_links_to_the_latest_of_equal_passages(spark):
    """Also where one passage of one thread lies in several parts."""
    rows = [("t", i, b) for i, b in enumerate(["hi", "ok", "foo", "ok", "> ok\n\nyes", "ok"])]
    rows += [("many", i, "> ok\n\nok" if i else "ok") for i in range(300)]
    rows += [("many", 300 + i, f"> ok\n\nother {i}") for i in range(200)]
    frame = spark.createDataFrame(rows, "thread string, at int, body string")
    found = {(r[0], r[1]): (r.parent, r.root, r.depth) for r in quotes.linked(frame, "thread", "at", "body").collect()}
    assert found["t", 4] == (3, 3, 1) and found["t", 5] == (None, 5, 0) and len(found) == len(rows)
    assert all(found["many", i] == (i - 1, 0, i) for i in range(1, 300))
    assert all(found["many", i] == (299, 0, 300) for i in range(300, 500))


def test_mail_and_back(spark):
    rows = [("c", i, "user" if i % 2 == 0 else "bot", f"turn {i}\nof many") for i in range(40)] + [("d", 0, "user", None)]
    frame = spark.createDataFrame(rows, "conv_id string, turn bigint, role string, text string")
    got = {(r.conv_id, r.turn): r for r in quotes.conversations(frame).collect()}
    for i in range(40):
        r = got["c", i]
        assert (r.parent, r.root, r.depth, r.own) == (i - 1 if i else None, 0, i, rows[i][3])
    assert got["d", 0].own == "" and quotes.conversations(frame.limit(0)).count() == 0


def test_items_without_ids_and_different_texts_under_one(docs, spark):
    """Each text is an item of its own, also of equal words and without an id."""
    same, one, two = "same " * 14, " ".join(f"a{i}" for i in range(13)), " ".join(f"b{i}" for i in range(13))
    bench = spark.createDataFrame([(None, same), (7, one), (7, two), (7, two)], "item_id bigint, text string")
    texts = [f"x {same} y", f"x {one} y", f"x {two} y {one}", "none of it"]
    frame = docs(texts + [texts[1]]).select("doc_id", "text")
    frame = frame.unionByName(docs([(0, texts[0], "s")]).select("doc_id", "text"))
    found = spaced_seeds.overlaps(frame, bench).collect()
    assert sorted((r.doc_id, r.item_id or -1) for r in found) == [(0, -1), (0, -1), (1, 7), (2, 7), (2, 7), (4, 7)]


def test_one_stem_in_many_items(spark, monkeypatch):
    """Items and documents that share a passage: every pair is found, with items shipped or joined."""
    stem = " ".join(f"stem{i}" for i in range(13))
    bench = spark.createDataFrame([(i, f"{stem} item{i} " * 2) for i in range(60)], "item_id bigint, text string")
    frame = spark.createDataFrame([(i, f"own{i} {stem} words{i}") for i in range(200)], "doc_id bigint, text string")
    ways = []
    for limit in (spaced_seeds.ITEM_BYTES, 0):
        monkeypatch.setattr(spaced_seeds, "ITEM_BYTES", limit)
        found = spaced_seeds.overlaps(frame, bench)
        ways.append(sorted(map(tuple, found.collect())))
    assert ways[0] == ways[1] and {w[:1] + w[2:3] for w in ways[0]} == {(d, i) for d in range(200) for i in range(60)}
    assert {w[3:5] + w[7:8] for w in ways[0]} == {(1, 14, 13)}
