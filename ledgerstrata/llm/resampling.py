"""Importance resampling: draw the documents that look most like a target set, by hashed word and word-pair counts.

Every Arrow batch interns its n-grams in an open-addressed table of numpy arrays, so that bytes are hashed into buckets
once for each different n-gram of the batch.
"""

from __future__ import annotations

import hashlib
import math
import zlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import importable, stored

#: Buckets of the feature space, share of documents drawn, and least words of a document that may be drawn.
BUCKETS, DRAWN_PERCENT, MIN_WORDS = 10_000, 25, 20
SEED = 7
#: Texts are interned together until they hold this many bytes, whatever the size of the Arrow batch.
TOGETHER = 1 << 19
#: Equal result rows written by one task of `_ranked`.
PIECE = 1 << 20

#: Fixed by the rules: A-Z become a-z; digits, letters and bytes from 128 on make words, all else parts them.
_WORD_BYTES = set(range(0x30, 0x3A)) | set(range(0x61, 0x7B)) | set(range(0x80, 0x100))
_FOLD = bytes(c + 32 if 0x41 <= c <= 0x5A else c if c in _WORD_BYTES else 0x20 for c in range(256))


class Grams:
    """Words and word pairs of some texts.

    The words of each text, joined by single spaces, stand in one buffer, so that every n-gram is a slice of it.
    """

    def __init__(self, texts: list[bytes | None]):
        per_text = [(text or b"").translate(_FOLD).split() for text in texts]
        self.n_words = np.fromiter(map(len, per_text), np.int64, len(per_text))
        words = list(chain.from_iterable(per_text))
        self.buffer = b" ".join(words)
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        ends = np.cumsum(lengths + 1) - 1
        starts = ends - lengths
        owner = np.repeat(np.arange(len(per_text)), self.n_words)
        pair = np.flatnonzero(owner[1:] == owner[:-1])
        self.grams = words + [a + b" " + b for text in per_text for a, b in zip(text, text[1:])]
        self.start = np.concatenate([starts, starts[pair]])
        self.end = np.concatenate([ends, ends[pair + 1]])
        self.owner = np.concatenate([owner, owner[pair]])
        self.n_features = np.bincount(self.owner, minlength=len(per_text)).astype(np.int64)


class Table:
    """An open-addressed table of n-grams: the n-gram that fills a slot, its bucket and its count.

    `slots` has the slot of every occurrence. A key met twice counts as the same n-gram only if the bytes agree;
    otherwise the second one moves on to the next free slot.
    """

    def __init__(self, grams: Grams):
        n = len(grams.grams)
        keys = np.frombuffer(b"".join(map(xxhash.xxh64_digest, grams.grams)), ">u8").astype(np.uint64)
        size = 1 << max(4, (2 * n).bit_length())
        self.owner = np.full(size, -1, np.int64)  # the occurrence whose bytes fill the slot
        self.slots = np.empty(n, np.int64)
        self._bytes = np.frombuffer(grams.buffer + bytes(8), np.uint8)
        left, mask = np.arange(n), size - 1
        at = (keys & np.uint64(mask)).astype(np.int64)
        while len(left):
            free = self.owner[at] < 0
            self.owner[at[free]] = left[free]  # of several that want one slot, one gets it
            there = self.owner[at]
            same = keys[there] == keys[left]
            same[same] = self._equal(grams, there[same], left[same])
            self.slots[left[same]] = at[same]
            left, at = left[~same], (at[~same] + 1) & mask
        used = np.flatnonzero(self.owner >= 0)
        held = map(grams.grams.__getitem__, self.owner[used].tolist())
        self.bucket = np.zeros(size, np.int64)
        self.bucket[used] = np.fromiter(map(zlib.crc32, held), np.int64, len(used)) % BUCKETS
        self.count = np.bincount(self.slots, minlength=size)

    def _equal(self, grams: Grams, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether the bytes of two n-grams each are the same, eight bytes at a time."""
        start_a, start_b = grams.start[a], grams.start[b]
        length = grams.end[a] - start_a
        equal = length == grams.end[b] - start_b
        windows = np.ndarray(len(self._bytes) - 7, "<u8", self._bytes, strides=(1,))
        live, done = np.flatnonzero(equal & (a != b)), 0
        while len(live):
            rest = np.minimum(length[live] - done, 8)
            drop = ((8 - rest) * 8).astype(np.uint64)
            differ = (windows[start_a[live] + done] ^ windows[start_b[live] + done]) << drop
            equal[live[differ != 0]] = False
            live = live[(differ == 0) & (length[live] > done + 8)]
            done += 8
        return equal


def _together(texts: list[bytes | None]) -> Iterator[list[bytes | None]]:
    """Neighbouring texts in groups of some megabytes."""
    part, size = [], 0
    for text in texts:
        part.append(text)
        size += len(text or b"")
        if size >= TOGETHER:
            yield part
            part, size = [], 0
    if part:
        yield part


def bucket_counts(docs: DataFrame) -> np.ndarray:
    """Occurrences of all features of all texts by bucket: one array of fixed length.

    A task adds up its own texts, so that at most `BUCKETS` rows leave it.
    """

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(BUCKETS, np.int64)
        for batch in batches:
            for texts in _together(batch.column(0).to_pylist()):
                table = Table(Grams(texts))
                np.add.at(total, table.bucket, table.count)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], ["bucket", "n"])

    parts = docs.select(F.col("text").cast("binary")).mapInArrow(add, "bucket long, n long")
    found = np.zeros(BUCKETS, np.int64)
    for row in parts.groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        found[row["bucket"]] = row["n"]
    return found


def gains(raw: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Log of target over corpus probability of each bucket, smoothed by one, in thousandths and floored."""
    all_raw, all_target = float(raw.sum()), float(target.sum())
    made = [
        math.floor(1000 * math.log((t + 1.0) * (all_raw + BUCKETS) / ((s + 1.0) * (all_target + BUCKETS))))
        for s, t in zip(raw.tolist(), target.tolist(), strict=True)
    ]
    return np.array(made, np.int64)


def noise(doc_id: object, seed: int = SEED) -> int:
    """The document's own Gumbel draw, in thousandths and floored."""
    h = int(hashlib.sha256(f"{seed}:{'null' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


def weigh(docs: DataFrame, target: DataFrame) -> DataFrame:
    """Rows (doc_id, n_words, n_features, weight, score) of all documents."""
    importable(docs)
    gain = gains(bucket_counts(docs), bucket_counts(target))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words, features, weights = [], [], []
            for texts in _together(batch.column(1).to_pylist()):
                grams = Grams(texts)
                table = Table(grams)
                gained = np.zeros(len(texts), np.int64)
                np.add.at(gained, grams.owner, gain[table.bucket[table.slots]])
                words.append(grams.n_words)
                features.append(grams.n_features)
                weights.append(gained // np.maximum(grams.n_features, 1))
            if not words:
                continue
            weight = np.concatenate(weights)
            drawn = np.fromiter(map(noise, batch.column(0).to_pylist()), np.int64, len(weight))
            arrays = map(pa.array, (np.concatenate(words), np.concatenate(features), weight, weight + drawn))
            yield pa.RecordBatch.from_arrays([batch.column(0), *arrays], ["doc_id", "n_words", "n_features", "weight", "score"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, n_words long, n_features long, weight long, score long"
    return docs.select("doc_id", F.col("text").cast("binary")).mapInArrow(score, schema)


def _repeat(rows: DataFrame, times: Column) -> DataFrame:
    """Every row `times` times, with the number of the copy; very many copies of one row are dealt over tasks."""
    few = rows.where(times <= PIECE).withColumn("_copy", F.explode(F.sequence(F.lit(0).cast("long"), times - 1)))
    last = F.floor((times - 1) / PIECE).cast("long")
    many = rows.where(times > PIECE).withColumn("_piece", F.explode(F.sequence(F.lit(0).cast("long"), last)))
    dealt = many.repartition(F.col("_piece"))
    first, end = F.col("_piece") * PIECE, F.least((F.col("_piece") + 1) * PIECE, times) - 1
    return few.unionByName(dealt.withColumn("_copy", F.explode(F.sequence(first, end))).drop("_piece"))


def resample(docs: DataFrame, target: DataFrame, percent: int = DRAWN_PERCENT) -> DataFrame:
    """Draw `percent` of the documents with at least MIN_WORDS words by weight and Gumbel noise.

    Returns doc_id, n_features, weight, score and rank, all of every document; rank is null where a document was not
    drawn. Ties of the score go to the smaller doc_id, null ids last; repeated rows, equal in all columns, take
    neighbouring ranks. A null or empty text has no features and weight 0. Whole texts of any length count. An empty
    table gives no rows; an empty target only smooths. Other columns are not read, whatever their names.

    Scores are whole numbers from a range that does not grow with the table, so a count per score says where each score
    begins, and only equal scores are sorted together.
    """
    scored = weigh(docs, target)
    named = ["doc_id", "n_features", "weight", "score"]
    folded = stored(scored.groupBy(*named, (F.col("n_words") >= MIN_WORDS).alias("able")).agg(F.count("*").alias("times")))
    able = folded.where("able")
    by_score = able.groupBy("score").agg(F.sum("times").alias("n"))
    down = Window.orderBy(F.desc("score")).rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy()
    bases = by_score.select("score", F.coalesce(F.sum("n").over(down), F.lit(0)).alias("base"), F.sum("n").over(whole).alias("all"))
    bases = bases.select("score", "base", F.expr(f"all * {percent} div 100").alias("drawn"))
    reached = stored(bases.where("base < drawn"))
    inside = Window.partitionBy("score").orderBy(F.asc_nulls_last("doc_id"), "n_features", "weight").rowsBetween(
        Window.unboundedPreceding, -1)
    placed = able.join(F.broadcast(reached), "score").withColumn(
        "_first", F.col("base") + F.coalesce(F.sum("times").over(inside), F.lit(0)))
    number = F.col("_first") + F.col("_copy") + 1
    ranked = _repeat(placed, F.col("times")).select(*named, F.when(number <= F.col("drawn"), number).alias("rank"))
    others = able.join(F.broadcast(reached), "score", "left_anti").unionByName(folded.where("not able"))
    unranked = _repeat(others, F.col("times")).select(*named, F.lit(None).cast("long").alias("rank"))
    return ranked.unionByName(unranked)
