"""Repeated passages: threshold-bounded interval expansion on a Burrows-Wheeler transform."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import importable, stored

#: Bytes of a repeated string, and of the anchors by which strings are dealt out.
LENGTH, ANCHOR = 200, 48
#: Windows hashed at once, so that a very long text takes bounded memory.
STEP = 1 << 18
_PLACE = np.uint64((1 << 20) - 1)
#: Odd multiplier of the rolling sums and its inverse modulo 2^64, and a second one to spread hashes.
_BASE = 0x9E3779B97F4A7C15
_SPREAD = np.uint64(0xD6E8FEB86659FD93)


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


_BYTES = np.frombuffer(hashlib.shake_256(b"bytes").digest(2048), np.uint64)
_UP = _powers(_BASE, STEP + 4096)
_DOWN = _powers(pow(_BASE, -1, 1 << 64), STEP + 4096)


def runs(data: bytes, length: int = LENGTH, anchor: int = ANCHOR) -> tuple[np.ndarray, ...]:
    """Cut the windows of `length` bytes of a text into runs of equal anchor: (anchor, content, start, count).

    The anchor of a window is its `anchor`-byte string of least hash, the leftmost of equals, so that it depends on the
    window alone: equal windows have equal anchors at equal places. A run is the windows in a row of one anchor; content
    is a hash of all its bytes. Every window is in one run.
    """
    parts: list[tuple[np.ndarray, ...]] = []
    raw = np.frombuffer(data, np.uint8)
    digest = xxhash.xxh3_64_intdigest
    for c in range(0, len(data) - length + 1, STEP):
        piece = raw[c : c + STEP + length - 1]
        n = len(piece)
        sums = np.zeros(n + 1, np.uint64)
        np.cumsum(_BYTES[piece] * _UP[:n], out=sums[1:])
        grams = (sums[anchor:] - sums[:-anchor]) * _DOWN[: n - anchor + 1]
        grams ^= grams >> np.uint64(32)
        grams *= _SPREAD
        grams ^= grams >> np.uint64(29)
        least = (grams & ~_PLACE) | np.arange(len(grams), dtype=np.uint64)
        width, wide = 1, length - anchor + 1
        while 2 * width <= wide:
            least = np.minimum(least[:-width], least[width:])
            width *= 2
        if wide > width:
            least = np.minimum(least[: n - length + 1], least[wide - width : wide - width + n - length + 1])
        place = (least[: n - length + 1] & _PLACE).astype(np.int64)
        starts = np.concatenate([[0], np.flatnonzero(np.diff(place)) + 1])
        ends = np.concatenate([starts[1:], [len(place)]])
        spans = zip((c + starts).tolist(), (c + ends + length - 1).tolist(), strict=True)
        content = np.fromiter((digest(data[a:z]) for a, z in spans), np.uint64, len(starts))
        parts.append((grams[place[starts]], content, c + starts, ends - starts))
    if not parts:
        return tuple(np.zeros(0, t) for t in (np.uint64, np.uint64, np.int64, np.int64))
    return tuple(np.concatenate(x) for x in zip(*parts, strict=True))


#: Separator of contexts: no byte of UTF-8.
SEPARATOR = 0xFF


def suffix_order(text: np.ndarray, depth: int) -> np.ndarray:
    """Suffixes in the order of their first `depth` bytes at least, by prefix doubling over what is still tied."""
    n = len(text)
    padded = np.concatenate([text, np.zeros(8, np.uint8)])
    key = np.zeros(n, np.uint64)
    for k in range(8):
        key = (key << np.uint64(8)) | padded[k : k + n]
    order = np.argsort(key)
    key = key[order]
    new = np.concatenate([[True], key[1:] != key[:-1]])
    rank = np.empty(n + 1, np.int64)
    rank[n] = -1
    rank[order] = np.maximum.accumulate(np.where(new, np.arange(n), 0))
    slots = np.flatnonzero(~(new & np.concatenate([new[1:], [True]])))
    width = 8
    while width < depth and len(slots):
        tied = order[slots]
        key = rank[tied] * (n + 2) + rank[np.minimum(tied + width, n)] + 1
        by = np.argsort(key)
        key, tied = key[by], tied[by]
        order[slots] = tied
        new = np.concatenate([[True], key[1:] != key[:-1]])
        rank[tied] = np.maximum.accumulate(np.where(new, slots, 0))
        slots = slots[~(new & np.concatenate([new[1:], [True]]))]
        width *= 2
    return order


def expand(bwt: np.ndarray, length: int) -> np.ndarray:
    """Where the common prefix of a suffix and the one before it in order is at least `length` bytes.

    Common prefixes are derived from the Burrows-Wheeler transform by increasing value. At value v the intervals of
    equal strings of v bytes, cut at the places of value below v, are extended by the byte before: within each right
    part of a new cut the first place of a byte c maps to the start of the interval of c and that string, whose value,
    if not known, is v + 1. All intervals of a value are extended at once (breadth first), and it ends at `length`.
    """
    n = len(bwt)
    order = np.argsort(bwt, kind="stable")
    back = np.empty(n, np.int64)
    back[order] = np.arange(n)
    first = np.concatenate([[True], bwt[order][1:] != bwt[order][:-1]])
    previous = np.full(n, -1, np.int64)
    previous[order[1:]] = np.where(first[1:], -1, order[:-1])
    known = np.zeros(n, bool)
    cuts = np.flatnonzero(first)
    known[cuts] = True
    for _ in range(1, length):
        if len(cuts) * 16 > n:
            upto = np.zeros(n + 1, np.int32)
            mark = np.zeros(n, np.int32)
            mark[cuts] = 1
            np.cumsum(mark, out=upto[1:])
            split = np.flatnonzero(upto[1:] > upto[previous + 1])
        else:
            bounds = np.append(np.flatnonzero(known), n)
            size = bounds[np.searchsorted(bounds, cuts, side="right")] - cuts
            ends = np.cumsum(size)
            at = np.arange(ends[-1]) - np.repeat(ends - size, size) + np.repeat(cuts, size)
            split = at[previous[at] < np.repeat(cuts, size)]
        found = back[split]
        cuts = np.unique(found[~known[found]])
        if not len(cuts):
            break
        known[cuts] = True
    return ~known


def repeats(text: np.ndarray, length: int) -> np.ndarray:
    """Places of a text (contexts, each closed by SEPARATOR) whose next `length` bytes start at another place as well."""
    order = suffix_order(text, length)
    long = expand(text[order - 1], length)
    out = np.zeros(len(text), bool)
    out[order[long]] = True
    out[order[np.flatnonzero(long) - 1]] = True
    return out


#: Bytes of contexts indexed at once: whole anchors up to about this.
BLOCK = 1 << 20
#: An anchor of more different contents than this is cut into single windows, which any number of tasks can count.
HOT = 8192
#: Repeated anchors are broadcast up to this many (32 MB); beyond it they are joined by a shuffle.
BROADCAST_ANCHORS = 2_000_000


def _columns(b: pa.RecordBatch, names: list[str]) -> list[list]:
    return [b.column(n).to_pylist() for n in names]


def _anchored(docs: DataFrame, length: int, full: bool) -> DataFrame:
    """Rows of all runs of all texts: (anchor), or (anchor, content, k, start, n)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keys, found, size = [], [], 0
            for k, data in zip(*_columns(b, ["k", "data"]), strict=True):
                one = runs(data, length)
                keys.append(np.full(len(one[0]), k, np.int64))
                found.append(one)
                size += len(one[0])
                if size > 1 << 18:
                    yield table(keys, found)
                    keys, found, size = [], [], 0
            if found:
                yield table(keys, found)

    def table(keys: list[np.ndarray], found: list[tuple]) -> pa.RecordBatch:
        anchor, content, start, n = (np.concatenate(x) for x in zip(*found, strict=True))
        arrays = [anchor.view(np.int64), content.view(np.int64), np.concatenate(keys), start, n.astype(np.int32)]
        names = ["anchor", "content", "k", "start", "n"]
        keep = slice(None if full else 1)
        return pa.RecordBatch.from_arrays([pa.array(a) for a in arrays[keep]], names[keep])

    schema = "anchor long, content long, k long, start long, n int" if full else "anchor long"
    return docs.select("k", "data").mapInArrow(run, schema)


def _contexts(docs: DataFrame, wanted: DataFrame, length: int) -> DataFrame:
    """(anchor, k, start, data): the bytes under the windows of the wanted runs (anchor, k, start, n)."""
    listed = wanted.groupBy("k").agg(F.collect_list(F.struct("anchor", "start", "n")).alias("runs"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for k, data, some in zip(*_columns(b, ["k", "data", "runs"]), strict=True):
                yield pa.RecordBatch.from_arrays([
                    pa.array([r["anchor"] for r in some], pa.int64()), pa.array([k] * len(some), pa.int64()),
                    pa.array([r["start"] for r in some], pa.int64()),
                    pa.array([data[r["start"] : r["start"] + r["n"] + length - 1] for r in some], pa.binary()),
                ], ["anchor", "k", "start", "data"])

    return docs.select("k", "data").join(listed, "k").mapInArrow(run, "anchor long, k long, start long, data binary")


def _compared(contexts: DataFrame, length: int) -> DataFrame:
    """(k, start, n): windows of contexts that are repeated among the contexts of their anchor."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block: list[tuple[int, int, bytes]] = []
        size, last = 0, None

        def out() -> pa.RecordBatch:
            text = np.frombuffer(b"".join(d + b"\xff" for _, _, d in block), np.uint8)
            same = repeats(text, length)
            k, start, n, at = [], [], [], 0
            for key, begin, data in block:
                own = same[at : at + len(data) - length + 1]
                edges = np.flatnonzero(np.diff(np.concatenate([[0], own.view(np.int8), [0]])))
                for a, z in edges.reshape(-1, 2).tolist():
                    k.append(key)
                    start.append(begin + a)
                    n.append(z - a)
                at += len(data) + 1
            return pa.RecordBatch.from_arrays([pa.array(k, pa.int64()), pa.array(start, pa.int64()), pa.array(n, pa.int32())],
                                              ["k", "start", "n"])

        for b in batches:
            for anchor, k, start, data in zip(*_columns(b, ["anchor", "k", "start", "data"]), strict=True):
                if anchor != last and size > BLOCK:
                    yield out()
                    block, size = [], 0
                block.append((k, start, data))
                size += len(data) + 1
                last = anchor
        if block:
            yield out()

    dealt = contexts.repartition("anchor").sortWithinPartitions("anchor")
    return dealt.mapInArrow(run, "k long, start long, n int")


def _counted(contexts: DataFrame, length: int) -> DataFrame:
    """(k, start, n) as `_compared`, for anchors of any number of contexts: single windows counted by hash."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digest = xxhash.xxh3_128_digest
        for b in batches:
            for k, start, data in zip(*_columns(b, ["k", "start", "data"]), strict=True):
                n = len(data) - length + 1
                yield pa.RecordBatch.from_arrays([
                    pa.array([digest(data[i : i + length]) for i in range(n)], pa.binary()),
                    pa.array([k] * n, pa.int64()), pa.array(range(start, start + n), pa.int64()),
                ], ["window", "k", "start"])

    windows = stored(contexts.mapInArrow(run, "window binary, k long, start long"))
    twice = windows.groupBy("window").agg(F.count("*").alias("c")).where("c > 1")
    return windows.join(twice, "window", "left_semi").select("k", "start", F.lit(1).alias("n"))


def repeated(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """(k, start, n) of `docs` (k, data): windows start .. start + n - 1 whose `length` bytes start elsewhere, too.

    Windows are dealt out by anchor; equal windows meet under one anchor. Anchors of one run only hold no repeat.
    Runs equal in full are copies: their windows repeat, and one of them stands for all. What is left, different runs
    of one anchor, is where repeats begin and end; their bytes are compared by interval expansion, whole anchors at
    a time.
    """
    anchors = stored(_anchored(docs, length, False).groupBy("anchor").agg(F.count("*").alias("c")).where("c > 1").select("anchor"))
    side = F.broadcast(anchors) if anchors.count() <= BROADCAST_ANCHORS else anchors
    found = stored(_anchored(docs, length, True).join(side, "anchor", "left_semi"))
    contents = stored(found.groupBy("anchor", "content").agg(
        F.count("*").alias("c"), F.min(F.struct("k", "start", "n")).alias("one")))
    copies = found.join(contents.where("c > 1").select("anchor", "content"), ["anchor", "content"], "left_semi")
    several = contents.groupBy("anchor").agg(F.count("*").alias("d")).where("d > 1")
    unlike = stored(contents.join(several, "anchor").select("anchor", "one.k", "one.start", "one.n", "d"))
    parts = [copies.select("k", "start", "n"), _compared(_contexts(docs, unlike.where(f"d <= {HOT}"), length), length)]
    hot = unlike.where(f"d > {HOT}")
    if not hot.isEmpty():
        parts.append(_counted(_contexts(docs, hot, length), length))
    spans = parts[0]
    for part in parts[1:]:
        spans = spans.unionByName(part)
    return spans


def _merged(spans: list[dict], length: int) -> list[tuple[int, int]]:
    """Byte ranges covered by windows, joined where they meet."""
    out: list[tuple[int, int]] = []
    for a, z in sorted((s["start"], s["start"] + s["n"] - 1 + length) for s in spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(z, out[-1][1]))
        else:
            out.append((a, z))
    return out


def listed(spans: DataFrame) -> DataFrame:
    """(k, windows): the spans of each k, each once however many rows repeat the document."""
    return spans.groupBy("k").agg(F.collect_set(F.struct("start", "n")).alias("windows"))


def remove(docs: DataFrame, length: int = LENGTH, texts: bool = False) -> DataFrame:
    """Remove each byte under a string of `length` bytes that also starts elsewhere in any text, the same included.

    Returns doc_id, n_bytes, n_removed, n_spans (maximal removed runs), kept_sha256 and spans ([start, end) of each), with
    `texts` also kept, the remaining bytes. Strings are judged on the input, overlapping ones count, and none crosses
    documents. A null text is an empty one; repeated rows are documents of their own, and so repeat each other. Null ids
    are like others. An empty table gives no rows. Rows are known by a 64-bit hash of doc_id and text.
    """
    importable(docs)
    data = F.coalesce(F.col("text").cast("binary"), F.lit(bytearray()))
    keyed = docs.select("doc_id", data.alias("data"), F.xxhash64("doc_id", "text").alias("k"))
    joined = keyed.join(listed(repeated(keyed, length)), "k", "left").select("doc_id", "data", "windows")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            for whole, windows in zip(*_columns(b, ["data", "windows"]), strict=True):
                cut = _merged(windows or [], length)
                edges = [0, *(x for span in cut for x in span), len(whole)]
                kept = b"".join(whole[a:z] for a, z in zip(edges[::2], edges[1::2], strict=True))
                rows.append((len(whole), len(whole) - len(kept), len(cut), hashlib.sha256(kept).hexdigest(),
                             [{"start": a, "end": z} for a, z in cut], kept))
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(),
                     pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])), pa.binary()]
            columns = list(zip(*rows, strict=True))[: 5 + texts]
            arrays = [pa.array(list(c), kind) for c, kind in zip(columns, kinds, strict=False)]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), *arrays], names)

    names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "spans", "kept"][: 6 + texts]
    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, n_bytes long, n_removed long, n_spans long, kept_sha256 string, spans array<struct<start: long, end: long>>"
    return joined.mapInArrow(run, schema + ", kept binary" * texts)
