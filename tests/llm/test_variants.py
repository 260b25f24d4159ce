"""Spelling variants next to plain comparisons of all words."""

import random
import re
import zlib
from collections import Counter

import pytest
from conftest_llm import ODD, fixture_texts
from pyspark.sql import functions as F

from barsmith.llm import variants


def plain_words(rows):
    out = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 97 == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1 :]
            if len(run) >= 5:
                out[run] += 1
    return out


def near(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) - len(a) == 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def plain_variants(rows):
    count = {w: n for w, n in plain_words(rows).items() if n >= 3}
    out = {}
    for word, n in count.items():
        others = [w for w in count if abs(len(w) - len(word)) < 2 and near(w, word)]
        best = min(others, key=lambda w: (-count[w], w), default=None)
        form = best if best is not None and count[best] >= 2 * n else None
        out[word] = [word, form, None, n, len(others), count[form] if form else None]
    for word, row in out.items():
        root = word
        while out[root][1]:
            root = out[root][1]
        row[2] = root
    return out


def test_words_of_odd_texts():
    rng, letters = random.Random(2), "abcDEZzÀÿ×é \n.1Ā¿🙂字\x7f\x85"
    for doc_id in range(1500):
        text = "".join(rng.choice(letters[:11] * 6 + letters) for _ in range(rng.randint(0, 300)))
        held = {}
        variants.add_runs(held, doc_id, text.encode())
        assert {w.decode(): n for w, n in held.items()} == dict(plain_words([(doc_id, text)]))
    held = {}
    variants.add_runs(held, None, b"valid \xff\xfe words \xc3")
    assert set(held) == {b"valid", b"words"}


def test_rotations_are_sorted():
    rng = random.Random(4)
    for n in (1, 2, 7, 200):
        words = sorted({"".join(rng.choice("ab") for _ in range(rng.randint(1, 12))) for _ in range(n)})
        text = "".join("\0" + w for w in words)
        codes = [0 if c == "\0" else ord(c) - 96 for c in text]
        got = variants.rotations(variants.np.array(codes), 3)
        assert got.tolist() == sorted(range(len(text)), key=lambda i: codes[i:] + codes[:i])


@pytest.mark.parametrize("letters", ["ab", "abcdé", "abcdefghijkÀ"])
def test_searches_meet_each_near_pair_once(letters, monkeypatch):
    rng = random.Random(letters)
    for trial in range(12):
        words = sorted({"".join(rng.choice(letters) for _ in range(rng.randint(5, 12 if trial % 2 else 7))) for _ in range(rng.choice([1, 2, 30, 250]))})
        words += ["zzzzz", "zzzzzz"] if trial % 3 else []  # letters that the index may not have
        held = sorted(rng.sample(words, max(1, len(words) * 2 // 3)))
        monkeypatch.setattr(variants, "BATCH", rng.choice([16, 1 << 14]))
        monkeypatch.setattr(variants, "SMALL", rng.choice([0, 3, 48]))
        index, met = variants.Index(held), []
        for second in (False, True):
            a, b = index.near(words, second)
            met += zip(a.tolist(), b.tolist())
            half = [words[i][: len(words[i]) // 2] == held[j][: len(words[i]) // 2] for i, j in zip(a, b)]
            assert all(half) if not second else not any(half)
        assert len(met) == len(set(met))
        assert set(met) == {(i, j) for i, a in enumerate(words) for j, b in enumerate(held) if near(a, b)}


@pytest.mark.parametrize("shard, asking", [(variants.SHARD, variants.ASKING), (400, 15)])
def test_variants(docs, shard, asking):
    rng = random.Random(6)
    base = ["".join(rng.choice("abcdeé") for _ in range(rng.randint(5, 9))) for _ in range(40)] + ["aaaaaaaa", "aaaaaaa", "aaaaaa"]
    texts = []
    for _ in range(220):
        words = []
        for _ in range(rng.randint(0, 40)):
            word = rng.choice(base[: rng.randint(1, len(base))])
            if rng.random() < 0.3:
                at = rng.randrange(len(word))
                word = word[:at] + rng.choice(["", "x", word[at] * 2, "É"]) + word[at + 1 :]
            words.append(word.upper() if rng.random() < 0.1 else word)
        texts.append(" ".join(words))
    rows = list(enumerate(texts + ODD + fixture_texts(60))) + [(None, "aaaaaaa bbbbb"), (0, texts[0])]
    frame = docs([(i, t, "s") for i, t in rows]).withColumns({"word": F.lit(1), "n": F.lit(2)})
    got = variants.variants(frame, shard, asking)
    want = plain_variants(rows)
    found = {r.word: list(r) for r in got.collect()}
    assert got.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    assert found == want and any(r[1] for r in want.values())


def test_ties_chains_and_empty_tables(docs):
    rows = ["abcde " * 3 + "abcdf " * 6 + "abcdg " * 6 + "abcdfh " * 12 + "zzzzz " * 3]
    got = {r.word: tuple(r)[1:] for r in variants.variants(docs([(1, rows[0], "s")])).collect()}
    assert got == {w: tuple(r[1:]) for w, r in plain_variants([(1, rows[0])]).items()}
    assert got["abcde"][0] == "abcdf" and got["abcde"][1] == "abcdfh" and got["zzzzz"] == (None, "zzzzz", 3, 0, None)
    assert variants.variants(docs([])).count() == 0
    assert variants.variants(docs([None, ""])).count() == 0
