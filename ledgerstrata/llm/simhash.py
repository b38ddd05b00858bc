"""SimHash near-dedup: fingerprints compared exactly, tile by tile."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import product

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import components, importable, stored

SHINGLE, SEED, RADIUS = 3, 42, 2
#: A fingerprint has PARTS parts of 16 bits; fingerprints of equal population counts by part form tiles of TILE at most.
PARTS, TILE = 4, 4096
#: Shingles hashed at once, so that a very long text takes bounded memory.
STEP = 1 << 16


def fingerprint(data: bytes, shingle: int = SHINGLE, seed: int = SEED) -> int:
    """The majority of each bit over the hashes of all shingles, repeats included, as unsigned 64-bit number."""
    words = data.lower().split()
    if not words:
        return 0
    if len(words) < shingle:
        return xxhash.xxh64_intdigest(b" ".join(words), seed)
    line = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    n = len(words) - shingle + 1
    ones = np.zeros(64, np.int64)
    digest = xxhash.xxh64_intdigest
    for at in range(0, n, STEP):
        to = min(n, at + STEP)
        spans = zip(starts[at:to].tolist(), ends[at + shingle - 1 : to + shingle - 1].tolist(), strict=True)
        hashes = np.fromiter((digest(line[a:b], seed) for a, b in spans), np.uint64, to - at)
        bits = np.unpackbits(hashes.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return sum(1 << int(i) for i in np.flatnonzero(2 * ones > n))


def fingerprints(docs: DataFrame) -> DataFrame:
    """(doc_id, fp): one row per document, fp as signed long. No words (or null): 0."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fps = np.array([fingerprint(t or b"") for t in b.column(1).to_pylist()], np.uint64)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fps.view(np.int64))], ["doc_id", "fp"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", F.col("text").cast("binary")).mapInArrow(run, f"doc_id {kind}, fp long")


def _part_counts(fps: np.ndarray) -> np.ndarray:
    """Population counts of the parts, packed as one number in base 32."""
    counts = np.bitwise_count(fps.view(np.uint16).reshape(-1, PARTS)).astype(np.int64)
    return counts @ (32 ** np.arange(PARTS, dtype=np.int64))


def _tiles(fps: DataFrame) -> DataFrame:
    """Pack fingerprints of equal part counts: rows (cls, tile, fps)."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            cls = _part_counts(np.ascontiguousarray(b.column(0).to_numpy()).view(np.uint64))
            yield pa.RecordBatch.from_arrays([pa.array(cls), b.column(0)], ["cls", "fp"])

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cls, parts, size = None, [], 0

        def out() -> pa.RecordBatch:
            fps = np.concatenate(parts)
            return pa.RecordBatch.from_pydict({"cls": [cls], "tile": [int(fps[0])], "fps": [fps.tobytes()]})

        for b in batches:
            keys, values = b.column(0).to_numpy(), b.column(1).to_numpy()
            edges = [0, *(np.flatnonzero(np.diff(keys)) + 1).tolist(), len(keys)]
            for a, z in zip(edges, edges[1:], strict=False):
                while a < z:
                    if parts and (keys[a] != cls or size == TILE):
                        yield out()
                        parts, size = [], 0
                    cls, to = int(keys[a]), min(z, a + TILE - size)
                    parts.append(values[a:to])
                    size += to - a
                    a = to
        if parts:
            yield out()

    dealt = fps.mapInArrow(count, "cls long, fp long").repartition("cls").sortWithinPartitions("cls", "fp")
    return dealt.mapInArrow(pack, "cls long, tile long, fps binary")


def _neighbours(radius: int) -> list[int]:
    """Differences of packed part counts within the radius, one of each pair of opposite signs, zero first."""
    steps = [d for d in product(range(-radius, radius + 1), repeat=PARTS) if sum(map(abs, d)) <= radius]
    return sorted({abs(sum(x * 32**i for i, x in enumerate(d))) for d in steps if d >= tuple(-x for x in d)})


def forest(u: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Few edges with the components of the edges (u, v): each node to the least node of its component."""
    nodes, flat = np.unique(np.concatenate([u, v]), return_inverse=True)
    a, b = flat[: len(u)], flat[len(u) :]
    label = np.arange(len(nodes))
    while True:
        least = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, a, least)
        np.minimum.at(new, b, least)
        np.minimum.at(new, label[a], least)
        np.minimum.at(new, label[b], least)
        new = new[new]
        if np.array_equal(new, label):
            break
        label = new
    moved = np.flatnonzero(label != np.arange(len(nodes)))
    return nodes[moved], nodes[label[moved]]


def links(fps: DataFrame, radius: int = RADIUS) -> DataFrame:
    """Edges (u, v) that join all fingerprints within `radius` bits of each other, directly or over others.

    Exact: one bit changes one part's population count by one, so that tiles whose counts differ by more than the
    radius in sum hold no link and never meet. Tiles that meet are compared in full by exclusive-or and bit count. Of a
    dense pair of tiles a spanning forest goes out, not every pair.
    """
    tiles = stored(_tiles(fps))
    steps = F.array(*[F.lit(d).cast("long") for d in _neighbours(radius)])
    right = tiles.select(
        F.explode(steps).alias("step"), (F.col("cls") - F.col("step")).alias("cls"), "tile", "fps"
    ).select("cls", "step", F.col("tile").alias("other"), F.col("fps").alias("others"))
    pairs = tiles.join(right, "cls").where("step <> 0 or tile <= other")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found: list[tuple[np.ndarray, np.ndarray]] = []
            rows = zip(*[c.to_pylist() for c in batch.columns], strict=True)
            for same, left, others in rows:
                a, b = np.frombuffer(left, np.uint64), np.frombuffer(others, np.uint64)
                rows_at_once = max(1, (1 << 20) // len(b))
                for at in range(0, len(a), rows_at_once):
                    near = np.bitwise_count(a[at : at + rows_at_once, None] ^ b[None, :]) <= radius
                    if same:
                        near = np.triu(near, at + 1)
                    i, j = np.nonzero(near)
                    if len(i):
                        u, v = a[at + i].view(np.int64), b[j].view(np.int64)
                        found.append(forest(u, v) if len(u) > 64 else (u, v))
            if found:
                u, v = (np.concatenate(x) for x in zip(*found, strict=True))
                yield pa.RecordBatch.from_arrays([pa.array(u), pa.array(v)], ["u", "v"])

    picked = pairs.select((F.expr("step = 0 and tile = other")).alias("same"), "fps", "others")
    return picked.mapInArrow(compare, "u long, v long")


def candidates(sets: DataFrame, radius: int = RADIUS) -> DataFrame:
    """(a, b), a < b: keys to be checked, of rows (key, fp), that join all keys whose fingerprints links join.

    The keys of a fingerprint meet its least one, and the least ones of linked fingerprints meet, so that the rows grow
    with keys and links, not with their pairs. A key may have several fingerprints.
    """
    sets = stored(sets.distinct())
    least = stored(sets.groupBy("fp").agg(F.min("key").alias("lead")))
    same = sets.join(least, "fp").select(F.col("lead").alias("a"), F.col("key").alias("b"))
    u, v = (least.select(F.col("fp").alias(end), F.col("lead").alias(lead)) for end, lead in (("u", "a"), ("v", "b")))
    near = links(least.select("fp"), radius).join(u, "u").join(v, "v").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    return same.union(near).where("a <> b").distinct()


def near_duplicates(docs: DataFrame, radius: int = RADIUS) -> DataFrame:
    """doc_id, fingerprint (16 hex digits) and component_id: the least doc_id reachable over links of `radius` bits.

    Copies share a fingerprint and meet in one aggregate; only distinct fingerprints are compared. Texts without words,
    null ones included, have fingerprint 0 and are linked like others. A null doc_id gets its component's least doc_id
    (null if there is none). Repeated rows stay. Only doc_id and text are read; an empty table gives no rows.
    """
    importable(docs)
    rows = stored(fingerprints(docs))
    distinct = stored(rows.groupBy("fp").agg(F.min("doc_id").alias("rep")))
    found = components(links(distinct.select("fp"), radius)).withColumnRenamed("node", "fp")
    named = distinct.join(found, "fp", "left").select("fp", "rep", F.coalesce("component", "fp").alias("component"))
    least = named.groupBy("component").agg(F.min("rep").alias("component_id"))
    by_fp = named.join(least, "component").select("fp", "component_id")
    digits = F.lower(F.lpad(F.hex("fp"), 16, "0"))
    return rows.join(by_fp, "fp").select("doc_id", digits.alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, radius: int = RADIUS) -> DataFrame:
    """The documents whose doc_id is the least of their near-duplicate group, with all columns.

    A null doc_id leads no group: such a row goes if its group has a document with an id, else all of its group stay.
    Repeated rows of one doc_id are one document and stay or go together.
    """
    found = near_duplicates(docs, radius).where(F.coalesce(F.col("doc_id") == F.col("component_id"), F.isnull("component_id")))
    lead = found.select(F.col("doc_id").alias("_llm_lead")).distinct()
    return docs.join(lead, docs["doc_id"].eqNullSafe(lead["_llm_lead"]), "left_semi")
