from __future__ import annotations

from collections import Counter

import numpy as np
import xxhash

from ledgerstrata.llm import simhash

from . import edge


def bits(text):
    found = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").encode().split()
    if not found:
        return 0
    hashes = [xxhash.xxh64_intdigest(b" ".join(found[i : i + 3]), 42) for i in range(max(1, len(found) - 2))]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def least(fps, ids, radius=2):
    """The least id reachable from each row."""
    group = list(range(len(fps)))
    for i, a in enumerate(fps):
        for j in range(i):
            if (a ^ fps[j]).bit_count() <= radius and group[i] != group[j]:
                old, new = group[i], group[j]
                group = [new if g == old else g for g in group]
    best = {}
    for g, i in zip(group, ids, strict=True):
        if i is not None:
            best[g] = min(best.get(g, i), i)
    return [best.get(g) for g in group]


def test_rows(spark):
    given = edge.rows(edge.docs(spark))
    fps = [bits(r["text"]) for r in given]
    expected = Counter(zip([r["doc_id"] for r in given], [f"{f:016x}" for f in fps], least(fps, [r["doc_id"] for r in given]), strict=True))
    found = edge.rows(simhash.near_duplicates(edge.docs(spark)))
    assert Counter((r["doc_id"], r["fingerprint"], r["component_id"]) for r in found) == expected


def test_links_of_dense_and_random_fingerprints(spark, monkeypatch):
    monkeypatch.setattr(simhash, "TILE", 50)
    rng = np.random.default_rng(3)
    middle = int(rng.integers(0, 2**63))
    fps = {middle ^ (1 << int(a)) ^ (1 << int(b)) for a, b in rng.integers(0, 64, (150, 2))}
    fps |= {int(x) for x in rng.integers(0, 2**64, 300, dtype=np.uint64)} | {0, 2**64 - 1, 2**64 - 2, 7, 3}
    fps = sorted(fps)
    signed = [f - 2**64 if f >> 63 else f for f in fps]
    df = spark.createDataFrame([(s,) for s in signed], "fp long").repartition(3)
    from ledgerstrata.llm.common import components

    groups = {r["node"]: r["component"] for r in components(simhash.links(df)).collect()}
    assert [groups.get(s, s) for s in signed] == least(fps, signed)


def test_long_text_in_steps(monkeypatch):
    text = next(t for t in edge.texts() if t and len(t) > 30_000).encode()
    whole = simhash.fingerprint(text)
    monkeypatch.setattr(simhash, "STEP", 100)
    assert simhash.fingerprint(text) == whole == bits(text.decode())


def test_keep_one(spark):
    docs = edge.docs(spark)
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    lead = {r["component_id"] for r in edge.rows(simhash.near_duplicates(docs))}
    assert {r["doc_id"] for r in edge.rows(kept)} == lead


def test_empty(spark):
    assert simhash.near_duplicates(edge.empty(spark)).collect() == []
    assert simhash.keep_one(edge.empty(spark)).collect() == []
