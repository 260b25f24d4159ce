"""Mixing and the pipeline, and every corpus query next to its SQL."""

import hashlib
import math
import os
import re
import sys
from collections import Counter, defaultdict

import pytest
from conftest_llm import FOLDER, ODD, fixture_texts

import corpus_pipeline
from barsmith.llm import mixing, private, queries, simhash, spaced_seeds, toxicity


def h(*parts):
    text = ":".join("null" if p is None else str(p) for p in parts)
    return int(hashlib.md5(text.encode()).hexdigest()[:15], 16)


def plain_mixture(rows, budget=1.0, entropy=0.95, repeats=None, seed=7):
    """(position in rows, epoch) of the mixture, step by step."""
    n = [len(re.findall(r"[^\x20\x09-\x0D]+", t or "")) for _, t, _ in rows]
    totals, size = defaultdict(int), Counter()
    for (_, _, s), k in zip(rows, n):
        totals[s] += k
        size[s] += 1
    totals = {s: t for s, t in totals.items() if t}
    total = sum(totals.values())

    def weights(a):
        p = {s: (t / total) ** a for s, t in totals.items()}
        z = sum(p.values())
        return {s: x / z for s, x in p.items()}

    def met(a):
        w = weights(a)
        if entropy is not None:
            return -sum(x * math.log(x) for x in w.values()) >= entropy * math.log(len(w))
        return max(x / totals[s] for s, x in w.items()) * budget * total <= repeats

    low, high = 0.0, 1.0
    if len(totals) < 2:
        tau = 1.0
    elif entropy is not None:
        for _ in range(32):
            mid = (low + high) / 2
            low, high = (mid, high) if met(mid) else (low, mid)
        tau = 1.0 if met(1.0) else low
    else:
        for _ in range(32):
            mid = (low + high) / 2
            low, high = (low, mid) if met(mid) else (mid, high)
        tau = 0.0 if met(0.0) else high
    out = []
    for s, w in weights(round(tau, mixing.PLACES)).items():
        scale = 10.0 ** math.floor(-math.log10(w))
        tokens = math.floor(round(w * scale, mixing.PLACES) / scale * (budget * total))
        epochs, rest = divmod(tokens, totals[s])
        blocks = -(-size[s] // mixing.BLOCK)
        mine = []
        for at, (i, t, of) in enumerate(rows):
            if of == s:
                key = h(i, t)
                mine.append((h(seed, s, key % blocks, epochs), key % blocks, h(key, epochs), at))
                out += [(at, e) for e in range(epochs)]
        spent, full = 0, True
        for slot, block in sorted({m[:2] for m in mine}):
            inside = sorted(m for m in mine if m[:2] == (slot, block))
            if full and spent + sum(n[m[3]] for m in inside) <= rest:
                spent += sum(n[m[3]] for m in inside)
                out += [(m[3], epochs) for m in inside]
            elif full:
                full = False
                for place in sorted({m[2] for m in inside}):
                    same = [m[3] for m in inside if m[2] == place]
                    if spent + sum(n[a] for a in same) > rest:
                        break
                    spent += sum(n[a] for a in same)
                    out += [(a, epochs) for a in same]
    return sorted(out)


@pytest.mark.parametrize("options", [{}, {"entropy": None, "repeats": 2.0, "budget": 0.7}, {"budget": 2.5, "entropy": 0.99}, {"entropy": 1.0}, {"entropy": 0.01}, {"budget": 30.0}])
def test_mixture(docs, options, monkeypatch):
    monkeypatch.setattr(mixing, "BLOCK", 16)
    monkeypatch.setattr(mixing, "COPIES", 8)
    texts = [t for t in fixture_texts(160) if t] + ["", "one word", "one word"]
    rows = [(i, t, None if i % 37 == 0 else "big" if i % 3 else f"s{i % 4}") for i, t in enumerate(texts)]
    frame = docs(rows).withColumnRenamed("source", "source")
    got = sorted((r.doc_id, r.epoch) for r in mixing.mixture(frame, **options).collect())
    assert got == plain_mixture(rows, **options)


def test_a_tiny_source_does_not_vanish(spark):
    rows = [("big", 10**11, 5), ("tiny", 2, 6)]
    found = mixing.plan(spark.createDataFrame(rows, "source string, n bigint, id_hash bigint"), entropy=0.0)
    assert {r.source: r.epochs for r in found.collect()} == {"big": 1, "tiny": 1}


def test_many_copies_of_one_document(docs, monkeypatch):
    """Two words beside 40,000: the copies come in shares of bounded size, each once."""
    monkeypatch.setattr(mixing, "COPIES", 1000)
    frame = docs([(1, "two words", "tiny")] + [(i, "w " * 400, "big") for i in range(2, 102)])
    got = mixing.mixture(frame).where("doc_id = 1").groupBy("epoch").count().agg({"epoch": "max", "count": "max", "*": "count"}).first()
    assert got["max(count)"] == 1 and got["count(1)"] == got["max(epoch)"] + 1 > 2 * mixing.COPIES


def test_mixture_of_odd_tables(docs):
    from pyspark.sql import functions as F

    assert mixing.mixture(docs([])).count() == 0
    assert mixing.mixture(docs([None, ""])).count() == 0
    frame = docs(ODD).withColumn("epoch", F.lit("kept")).withColumn("of", F.lit(1))
    assert {r.epoch for r in mixing.mixture(frame).collect()} == {"kept"}
    assert "epoch_" in mixing.mixture(frame).columns


def small(spark, folder, rows, extra=False):
    from pyspark.sql import functions as F

    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    if extra:
        for name in ("score", "fp", "text_hash", "of", "epoch", "found_spans", "n"):
            docs = docs.withColumn(name, F.lit("kept"))
    docs.write.parquet(f"{folder}/documents.parquet")
    for name in ("labels", "benchmark"):
        table = spark.read.parquet(f"{FOLDER}/{name}.parquet")
        table.write.parquet(f"{folder}/{name}.parquet")
    return docs


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")
def test_pipeline_against_a_plain_version(spark, tmp_path):
    folder = str(tmp_path)
    table = [tuple(r) for r in spark.read.parquet(f"{FOLDER}/documents.parquet").orderBy("doc_id").limit(300).collect()]
    odd = [(9000 + i, t, "en", "odd", len(t or "")) for i, t in enumerate(ODD)] + [table[3], table[3], (None, "words of no id", "en", "s", 14)]
    docs = small(spark, folder, table + odd, extra=True)
    rows = [tuple(r)[:5] for r in docs.collect()]
    bench = [tuple(r) for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect()]

    score = toxicity.scorer(toxicity.fit(docs, spark.read.parquet(f"{folder}/labels.parquet")))
    kept = [r for r in rows if score(r[1] or "") < 0.5]

    prints, root = [simhash.simhash(r[1] or "") for r in kept], list(range(len(kept)))
    for _ in range(len(kept)):
        new = [min(root[j] for j in range(len(kept)) if (prints[i] ^ prints[j]).bit_count() <= 3) for i in range(len(kept))]
        if new == root:
            break
        root = new
    groups = defaultdict(list)
    for i, r in enumerate(kept):
        groups[root[i]].append(r)
    kept = [min(g, key=lambda r: (r[0] is None, r[0] or 0)) for g in groups.values()]

    places, cache = spaced_seeds.offsets([]), spaced_seeds.Hashes()
    items = [spaced_seeds.word_hashes(t, cache) for _, t in bench]
    seeds = lambda text: spaced_seeds.Seeds(spaced_seeds.word_hashes(text or "", cache), places)
    kept = [r for r in kept if not any(spaced_seeds.verified(seeds(r[1]), i, places) for i in items)]

    frame = spark.createDataFrame(kept, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    masked = [tuple(r) for r in private.redacted(frame).collect()]
    assert all(private.KINDS and "@mail" not in (r[1] or "") for r in masked)
    want = plain_mixture([(r[0], r[1], r[3]) for r in masked])

    got = corpus_pipeline.run(spark, folder)
    assert sorted((str(masked[a][0]), e) for a, e in want) == sorted((str(r.doc_id), r["epoch_"]) for r in got.collect())
    assert {r.score for r in got.collect()} == {"kept"}
    texts = {r[0]: r[1] for r in masked}
    assert all(texts[r.doc_id] == r.text for r in got.collect())


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")
def test_stages_keep_the_columns(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs.limit(0), FOLDER).schema.names == docs.columns, name
        assert stage(spark, docs.limit(0), FOLDER).count() == 0


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")
@pytest.mark.parametrize("name", list(queries.SQL))
def test_query_next_to_its_sql(spark, name):
    sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(__file__))))
    import oracle

    got = queries.QUERIES[name](spark, FOLDER).toPandas()
    assert oracle.differences(got, oracle.connect(FOLDER).execute(queries.SQL[name]).df()) == []
