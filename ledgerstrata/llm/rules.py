"""Quality rules: base counts, and the log-likelihood ratio of hashed n-grams between trusted texts and the corpus."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import importable
from .textstats import SYMBOLS, Words, count_of, duplicate_lines, mixed, word_chars

#: Hash buckets of each order of n-grams; words and word pairs are counted.
BUCKETS = 1 << 14
#: Least mean log-likelihood ratio of a document that is kept.
LEAST = -0.12
#: Fixed rules of the base verdict.
MIN_WORDS, MOST_REPEATED_PERCENT = 20, 30
#: Trusted ids are broadcast up to this many (16 MB); beyond it they are joined by a shuffle.
BROADCAST_IDS = 1_000_000


def grams(words: Words) -> np.ndarray:
    """Bucket numbers of all words and word pairs of a text."""
    h = words.hashes
    mask = np.uint64(BUCKETS - 1)
    pairs = mixed(h[:-1] * np.uint64(3) + mixed(h[1:])) & mask
    return np.concatenate([h & mask, pairs + np.uint64(BUCKETS)]).astype(np.uint16)


def counts(docs: DataFrame, trusted: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """n-gram counts of all documents and of the trusted ones: two arrays of fixed length.

    Every task adds up its own documents, so that at most 2 x BUCKETS rows leave it.
    """
    ids = trusted.select(F.col("doc_id").alias("_id")).where("_id is not null").distinct()
    small = ids.count() <= BROADCAST_IDS
    side = F.broadcast(ids) if small else ids
    marked = docs.select("doc_id", "text").join(side, F.col("doc_id") == F.col("_id"), "left")

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((2, 2 * BUCKETS), np.int64)
        for b in batches:
            found: tuple[list, list] = ([], [])
            for data, trust in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                found[bool(trust)].append(grams(Words(data or b"")))
            for k, parts in enumerate(found):
                if parts:
                    total[k] += np.bincount(np.concatenate(parts), minlength=2 * BUCKETS)
        total[0] += total[1]
        at = np.flatnonzero(total[0])
        arrays = [pa.array(at), pa.array(total[0, at]), pa.array(total[1, at])]
        yield pa.RecordBatch.from_arrays(arrays, ["gram", "raw", "target"])

    parts = marked.select(F.col("text").cast("binary"), F.isnotnull("_id").alias("trust")).mapInArrow(add, "gram long, raw long, target long")
    raw, target = np.zeros(2 * BUCKETS, np.int64), np.zeros(2 * BUCKETS, np.int64)
    for r in parts.groupBy("gram").agg(F.sum("raw").alias("raw"), F.sum("target").alias("target")).collect():
        raw[r["gram"]], target[r["gram"]] = r["raw"], r["target"]
    return raw, target


def ratios(raw: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Log of target over raw probability of each n-gram, smoothed by one. All zero where nothing is trusted."""
    if not target.any():
        return np.zeros(len(raw))
    out = np.zeros(len(raw))
    for part in (slice(0, BUCKETS), slice(BUCKETS, 2 * BUCKETS)):
        t, r = target[part] + 1.0, raw[part] + 1.0
        out[part] = np.log(t / t.sum()) - np.log(r / r.sum())
    return out


def judge(docs: DataFrame, trusted: DataFrame, least: float = LEAST) -> DataFrame:
    """Judge every whole document.

    Returns doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept and llr, the mean
    log-likelihood ratio of the document's words and word pairs under the trusted and the corpus multinomial. A
    document is kept if the base rules hold and llr is at least `least`; without trusted documents llr is 0. A null text
    is an empty one: all counts 0, base_failed. Null ids and repeated rows are judged like others. An empty table gives
    no rows. `trusted` needs doc_id; other columns are not read.
    """
    importable(docs)
    table = ratios(*counts(docs, trusted))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            for text in b.column(1).to_pylist():
                text = text or ""
                words = Words(text.encode())
                n, again = len(words), words.repeated()
                failed = n < MIN_WORDS or 100 * again > MOST_REPEATED_PERCENT * n
                llr = float(table[grams(words)].mean()) if n else 0.0
                rows.append((n, word_chars(text), count_of(text, SYMBOLS), duplicate_lines(text), again, failed,
                             not failed and llr >= least, llr))
            kinds = [pa.int64()] * 5 + [pa.bool_()] * 2 + [pa.float64()]
            columns = zip(*rows, strict=True) if rows else [()] * 8
            arrays = [pa.array(list(c), kind) for c, kind in zip(columns, kinds, strict=True)]
            yield pa.RecordBatch.from_arrays([b.column(0), *arrays], names)

    names = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "llr"]
    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = (f"doc_id {kind}, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long,"
              " base_failed boolean, kept boolean, llr double")
    return docs.select("doc_id", "text").mapInArrow(score, schema)
