from __future__ import annotations

import zlib
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from ledgerstrata.llm import gam, rules
from ledgerstrata.llm.textstats import Words

from . import edge

LABELS = "doc_id long, quality int, toxic int"


def counted(text):
    """The base counts by their definition, word by word."""
    text = text or ""
    found = text.encode().split()
    windows = Counter(tuple(found[i : i + 8]) for i in range(len(found) - 7))
    again = {j for i in range(len(found) - 7) if windows[tuple(found[i : i + 8])] > 1 for j in range(i, i + 8)}
    lines, seen, twice = [x for x in text.split("\n") if x.encode().split()], set(), 0
    for line in lines:
        twice += line in seen
        seen.add(line)
    chars = sum(len(w.decode()) for w in found)
    return len(found), chars, sum(c in "#*$%&|<>" for c in text), twice, len(again)


def labels(spark, rows):
    return spark.createDataFrame(rows, LABELS)


def test_base_counts(spark):
    docs = edge.docs(spark)
    found = edge.rows(rules.judge(docs, labels(spark, [(0, 1, 0)])))
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    assert Counter((r["doc_id"], counted(r["text"])) for r in edge.rows(docs)) == Counter(
        (r["doc_id"], tuple(r[n] for n in names)) for r in found)
    for r in found:
        assert r["base_failed"] == (r["n_words"] < 20 or 100 * r["n_repeat_words"] > 30 * r["n_words"])
        assert not (r["kept"] and r["base_failed"])
        assert r["kept"] == (not r["base_failed"] and r["llr"] >= rules.LEAST)


def test_ratio_equals_brute_force(spark):
    docs = edge.docs(spark, extra=False)
    trusted = {1, 2, 5, 8}
    given = edge.rows(docs)
    raw, target = np.zeros(2 * rules.BUCKETS), np.zeros(2 * rules.BUCKETS)
    for r in given:
        for g in rules.grams(Words((r["text"] or "").encode())):
            raw[g] += 1
            target[g] += r["doc_id"] in trusted
    half = rules.BUCKETS
    table = np.concatenate([
        np.log((target[s] + 1) / (target[s] + 1).sum()) - np.log((raw[s] + 1) / (raw[s] + 1).sum())
        for s in (slice(0, half), slice(half, None))])
    expected = Counter()
    for r in given:
        grams = rules.grams(Words((r["text"] or "").encode()))
        expected[(r["doc_id"], round(float(table[grams].mean()) if len(grams) else 0.0, 9))] += 1
    for limit in (rules.BROADCAST_IDS, 0):
        rules.BROADCAST_IDS, before = limit, rules.BROADCAST_IDS
        found = edge.rows(rules.judge(docs, labels(spark, [(i, 1, 0) for i in [*trusted, None]])))
        rules.BROADCAST_IDS = before
        assert Counter((r["doc_id"], round(r["llr"], 9)) for r in found) == expected


def test_nothing_trusted_and_empty(spark):
    none = labels(spark, [])
    assert {r["llr"] for r in edge.rows(rules.judge(edge.docs(spark), none))} == {0.0}
    assert rules.judge(edge.empty(spark), none).collect() == []


def test_classifier_learns_held_out_rows(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    known = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    found = gam.classify(docs, known)
    assert found.columns == ["doc_id", "held_out", "score", "predicted"]
    rows = edge.rows(found.join(known, "doc_id", "left"))
    assert len(rows) == docs.count()
    for r in rows:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2)
        assert 0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.7)
    held = [r for r in rows if r["held_out"] and r["quality"] is not None]
    assert np.mean([r["predicted"] == r["quality"] for r in held]) > 0.95
    kept = {r["doc_id"] for r in edge.rows(gam.accept(docs, known))}
    assert kept == {r["doc_id"] for r in rows if r["predicted"]}


def test_held_out_labels_are_not_used(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    known = spark.read.parquet("/root/testdata/sf0.001/labels.parquet")
    flipped = known.withColumn("quality", F.when(gam.remainder() == 2, 1 - F.col("quality")).otherwise(F.col("quality")))
    assert sorted(gam.classify(docs, known).collect()) == sorted(gam.classify(docs, flipped).collect())


def test_classifier_edges(spark):
    docs = edge.docs(spark)
    known = labels(spark, [(i, i % 2, 0) for i in range(20)] + [(0, 1, 0), (None, 1, 0), (3, None, 0), (9999, 1, 1)])
    found = edge.rows(gam.classify(docs, known))
    assert len(found) == docs.count() and all(0 <= r["score"] <= 1 for r in found)
    texts = {d["doc_id"]: d["text"] for d in edge.rows(docs) if d["doc_id"] is not None}
    assert len({r["score"] for r in found if r["doc_id"] is not None and not texts[r["doc_id"]]}) == 1
    assert gam.accept(docs, known).columns == docs.columns
    assert {r["predicted"] for r in edge.rows(gam.classify(docs, labels(spark, [])))} == {1}
    assert gam.classify(edge.empty(spark), known).collect() == []


def test_pair_effects():
    """Neither feature tells anything alone; the pair does."""
    rng = np.random.default_rng(1)
    x = rng.random((3000, len(gam.FEATURES)))
    y = ((x[:, 0] > 0.5) ^ (x[:, 1] > 0.5)).astype(float)
    model = gam.fit(x[:2000], y[:2000])
    assert any({i, j} == {0, 1} for i, j, _ in model.pairs)
    assert ((model.score(x[2000:]) > 0.5) == y[2000:]).mean() > 0.9


def test_every_label_takes_part(spark):
    """The labels of least hash, as many as a block, say the opposite of all others, which decide."""
    rng = np.random.default_rng(4)
    texts = [" ".join(["word"] * n if i % 2 else map(str, rng.integers(0, 10**6, n))) for i, n in enumerate(rng.integers(40, 90, 600))]
    docs = spark.createDataFrame([(i, t, "en", "s", 0) for i, t in enumerate(texts)], edge.SCHEMA).repartition(3)
    order = docs.where(gam.remainder() != gam.HELD_OUT).orderBy(F.xxhash64("doc_id"), "doc_id").select("doc_id").limit(60)
    other = {r["doc_id"] for r in order.collect()}
    known = labels(spark, [(i, (i % 2) ^ (i in other), 0) for i in range(600)])
    found = {r["doc_id"]: r["score"] for r in edge.rows(gam.classify(docs, known, 60))}
    assert all((found[i] > 0.5) == i % 2 for i in found)
    again = {r["doc_id"]: r["score"] for r in edge.rows(gam.classify(docs.repartition(7), known, 60))}
    assert again == found


def test_blocks_are_averaged(spark, monkeypatch):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    known = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    quality = {r["doc_id"]: r["quality"] for r in edge.rows(known.where(gam.remainder() != gam.HELD_OUT))}
    given = sorted((r["doc_id"], r["text"]) for r in edge.rows(docs) if r["doc_id"] in quality)
    x = np.array([gam.features(t or "") for _, t in given])
    y = np.array([quality[d] for d, _ in given], float)
    for limit in (gam.BROADCAST_LABELS, 0):
        monkeypatch.setattr(gam, "BROADCAST_LABELS", limit)
        assert np.array_equal(gam.train(docs, known).score(x), gam.fit(x, y).score(x))
    bounds = (gam.quantiles(x[::2]) + gam.quantiles(x[1::2])) / 2
    parts = [gam.fit(x[k::2], y[k::2], bounds) for k in (0, 1)]
    logit = lambda p: np.log(p / (1 - p))
    mean = sum(logit(m.score(x)) for m in parts) / 2
    assert np.allclose(logit(gam.merge(parts).score(x)), mean)
    assert ((gam.train(docs, known, 50).score(x) >= gam.CUT) == y).mean() > 0.95
