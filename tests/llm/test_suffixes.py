from __future__ import annotations

import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from ledgerstrata.llm import suffixes
from ledgerstrata.llm.suffixes import remove, repeats, runs

from . import edge


def brute(given, length):
    data = [(r["doc_id"], (r["text"] or "").encode()) for r in given]
    seen = Counter(d[i : i + length] for _, d in data for i in range(len(d) - length + 1))
    out = []
    for doc_id, d in data:
        gone = bytearray(len(d))
        for i in range(len(d) - length + 1):
            if seen[d[i : i + length]] > 1:
                gone[i : i + length] = b"\1" * length
        kept = bytes(x for x, g in zip(d, gone, strict=True) if not g)
        spans = sum(a and not b for a, b in zip(gone, [0, *gone[:-1]], strict=False))
        out.append((doc_id, len(d), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return Counter(out)


def got(df):
    return Counter((r["doc_id"], r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in df.collect())


@pytest.mark.parametrize(("hot", "step"), [(8192, 1 << 18), (0, 1 << 18), (8192, 300)])
def test_equals_brute_force(spark, monkeypatch, hot, step):
    """Also with every anchor taken for a hot one, and with long texts cut into many pieces."""
    monkeypatch.setattr(suffixes, "HOT", hot)
    monkeypatch.setattr(suffixes, "STEP", step)
    docs = edge.docs(spark)
    assert got(remove(docs)) == brute(edge.rows(docs), 200)


def test_kept_bytes(spark):
    for r in edge.rows(remove(edge.docs(spark), texts=True)):
        assert hashlib.sha256(r["kept"]).hexdigest() == r["kept_sha256"]
        assert r["n_removed"] == sum(s["end"] - s["start"] for s in r["spans"])


def test_empty(spark):
    assert remove(edge.empty(spark)).collect() == []


def test_expansion_equals_counting():
    rng = random.Random(5)
    for length in (1, 2, 3, 9, 40):
        parts = [bytes(rng.choices(b"abc", k=rng.randrange(1, 150))) for _ in range(15)]
        parts += [parts[0], parts[1][20:] + parts[2], b"ab" * 60]
        text = b"".join(p + b"\xff" for p in parts)
        same = repeats(np.frombuffer(text, np.uint8), length)
        seen = Counter(text[i : i + length] for i in range(len(text) - length + 1))
        for i in range(len(text) - length + 1):
            if 0xFF not in text[i : i + length]:
                assert same[i] == (seen[text[i : i + length]] > 1)


def test_runs_cover_all_windows_and_depend_on_content():
    rng = random.Random(6)
    a = bytes(rng.choices(b"abcdefgh", k=3000))
    b = bytes(rng.choices(b"abcdefgh", k=500)) + a[700:2000]
    anchors = []
    for data in (a, b):
        anchor, _, start, n = runs(data)
        assert start[0] == 0 and (start[1:] == (start + n)[:-1]).all() and start[-1] + n[-1] == len(data) - 199
        anchors.append(np.repeat(anchor, n))
    assert (anchors[0][700:1801] == anchors[1][500:1601]).all()


def test_a_repeated_row_has_each_span_once(spark):
    rng = random.Random(9)
    text = edge.words(rng, 300)
    rows = [(1, text, "en", "s", 0)] * 40 + [(2, edge.words(rng, 60), "en", "s", 0)]
    docs = spark.createDataFrame(rows, edge.SCHEMA).repartition(4)
    keyed = docs.selectExpr("doc_id", "cast(text as binary) as data", "xxhash64(doc_id, text) as k")
    spans = suffixes.repeated(keyed)
    found = suffixes.listed(spans).collect()
    assert len(found) == 1 and len(found[0]["windows"]) == spans.distinct().count() < spans.count()
    assert got(remove(docs)) == brute(edge.rows(docs), 200)
