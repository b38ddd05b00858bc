"""Periodic runs: stretches of words that repeat a block of words three times or more.

Words too rare inside a segment to be part of a run split it, again and again until nothing is rare; the segments that
survive are scanned lag by lag.
"""

from __future__ import annotations

from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import WORD, importable

#: A run has at least this many words, and at least this many times its period.
LEAST, TIMES = 24, 3
#: Words compared at once when a run is followed to its end; doubled with every step.
STEP = 64

RUN = T.StructType([T.StructField(name, T.LongType(), False) for name in ("start", "length", "period")])
_ARROW_RUN = pa.list_(pa.struct([(name, pa.int64()) for name in RUN.names]))


def segments(words: np.ndarray, least: int = LEAST, times: int = TIMES) -> Iterator[tuple[int, int]]:
    """Stretches (start, end) of at least `least` words in which every word occurs `times` times or more.

    A run holds each of its words `times` times, so no run reaches over a word that its segment holds more rarely. Each
    round cuts a segment at all such words. The longest piece goes on with the counts of the whole less those of the
    shorter pieces, and only words whose counts fell are looked at again; shorter pieces are counted anew. So a word is
    counted again only when its piece is at most half as long, however deep the splitting goes.
    """
    work = [(0, words)]
    while work:
        shift, part = work.pop()
        if len(part) < least:
            continue
        _, part = np.unique(part, return_inverse=True)
        count = np.bincount(part)
        order = np.argsort(part, kind="stable")
        places = part[order] * np.int64(len(part)) + order  # by word, then by place
        a, b, suspects = 0, len(part), np.arange(len(count))
        while b - a >= least:
            rare = suspects[(count[suspects] > 0) & (count[suspects] < times)]
            if not len(rare):
                yield shift + a, shift + b
                break
            first = np.searchsorted(places, rare * np.int64(len(part)) + a)
            cuts = np.sort(np.concatenate([order[first[count[rare] > k] + k] for k in range(times - 1)]))
            edges = np.concatenate([[a - 1], cuts, [b]])
            largest = int(np.argmax(np.diff(edges)))
            low, high = int(edges[largest]) + 1, int(edges[largest + 1])
            for left, right in zip(edges[:-1] + 1, edges[1:], strict=True):
                if left != low and right - left >= least:
                    work.append((shift + int(left), part[left:right]))
            suspects, gone = np.unique(np.concatenate([part[a:low], part[high:b]]), return_counts=True)
            count[suspects] -= gone
            a, b = low, high


def _reach(words: np.ndarray, at: int, lag: int, step: int) -> int:
    """How many places in a row from `at` on, in the direction of `step`, equal the word `lag` places later."""
    n, size = len(words) - lag, STEP
    reached = 0
    while True:
        if step > 0:
            low, high = at + reached, min(at + reached + size, n)
            same = words[low:high] == words[low + lag : high + lag]
        else:
            high, low = at - reached + 1, max(at - reached + 1 - size, 0)
            same = (words[low:high] == words[low + lag : high + lag])[::-1]
        if not len(same):
            return reached
        if not same.all():
            return reached + int(np.argmin(same))
        reached += len(same)
        size *= 2


def runs_in(words: np.ndarray, least: int = LEAST, times: int = TIMES) -> dict[tuple[int, int], int]:
    """All runs of one segment: (start, length) and the smallest period.

    A run of lag q is a row of at least `need` places that equal the place q later; such a row covers a multiple of
    `need`, so only those places are tried. Lags go up, so the first period found for a stretch is its smallest.
    """
    found: dict[tuple[int, int], int] = {}
    for lag in range(1, len(words) // times + 1):
        whole = max(least, times * lag)
        if whole > len(words):
            break
        need, done = whole - lag, -1
        tried = words[: len(words) - lag : need]
        for hit in (np.flatnonzero(tried == words[lag::need][: len(tried)]) * need).tolist():
            if hit < done:
                continue
            right = _reach(words, hit, lag, 1)
            left = _reach(words, hit - 1, lag, -1) if hit else 0
            done = hit + right
            if left + right >= need:
                found.setdefault((hit - left, left + right + lag), lag)
    return found


def find(words: np.ndarray, least: int = LEAST, times: int = TIMES) -> list[tuple[int, int, int]]:
    """All runs of a text given as numbers of its words: (start, length, period), by start, then period."""
    made = [
        (start + at, length, lag)
        for start, end in segments(words, least, times)
        for (at, length), lag in runs_in(words[start:end], least, times).items()
    ]
    return sorted(made, key=lambda r: (r[0], r[2]))


def _numbered(words: list[bytes]) -> np.ndarray:
    """The words as numbers, equal ones alike."""
    number: dict[bytes, int] = {}
    return np.fromiter((number.setdefault(w, len(number)) for w in words), np.int64, len(words))


def _kept(n: int, runs: list[tuple[int, int, int]]) -> np.ndarray:
    """The words that no run drops: all but those after the first period of a run that holds them."""
    steps = np.zeros(n + 1, np.int64)
    for start, length, period in runs:
        steps[start + period] += 1
        steps[start + length] -= 1
    return np.cumsum(steps[:-1]) == 0


def collapse(docs: DataFrame, least: int = LEAST, times: int = TIMES) -> DataFrame:
    """Find the periodic runs of every whole text and drop their repetitions.

    Returns doc_id; runs, an array of (start, length, period) in words, by start, then period; best, the run of the
    greatest length by period (ties: smallest start, then period), null without a run; and text, the kept words joined
    by single spaces. A null or blank text has no runs and becomes an empty one. Null ids and repeated rows are treated
    like others, texts of any length whole. An empty table gives no rows. Other columns are not read, whatever their
    names.
    """
    importable(docs)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            all_runs, best, texts = [], [], []
            for data in batch.column(1).to_pylist():
                words = (data or b"").split()
                runs = find(_numbered(words), least, times) if len(words) >= least else []
                if runs:
                    words = [words[i] for i in np.flatnonzero(_kept(len(words), runs)).tolist()]
                as_rows = [dict(zip(RUN.names, run, strict=True)) for run in runs]
                all_runs.append(as_rows)
                best.append(min(as_rows, key=lambda r: (-Fraction(r["length"], r["period"]), r["start"], r["period"]), default=None))
                texts.append(b" ".join(words).decode())
            arrays = [batch.column(0), pa.array(all_runs, _ARROW_RUN), pa.array(best, _ARROW_RUN.value_type), pa.array(texts, pa.string())]
            yield pa.RecordBatch.from_arrays(arrays, schema.names)

    schema = T.StructType([
        T.StructField("doc_id", docs.schema["doc_id"].dataType), T.StructField("runs", T.ArrayType(RUN)),
        T.StructField("best", RUN), T.StructField("text", T.StringType()),
    ])
    return docs.select("doc_id", F.col("text").cast("binary")).mapInArrow(work, schema)


def with_repeats(docs: DataFrame) -> DataFrame:
    """Documents (doc_id, text) where every tenth one, by the CRC of its id, repeats a block of its words to its end.

    With n words and g = crc32(doc_id) div 10, words from a = g mod n on become copies of the p words from a on, where
    p = 1 + (n - a) div (3 + g mod 8). The words of such a text are joined by single spaces. A null id changes nothing.
    """
    crc = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    named = docs.select("doc_id", "text", F.floor(crc / 10).alias("g"), F.coalesce(crc % 10 == 0, F.lit(False)).alias("chosen"))
    words = F.when(F.col("chosen"), F.regexp_extract_all("text", F.lit(WORD), F.lit(0)))
    held = named.select("doc_id", "text", "g", words.alias("words"), F.coalesce(F.size(words) > 0, F.lit(False)).alias("due"))
    n = F.size("words").cast("long")
    a = F.when(F.col("due"), F.col("g") % n)
    placed = held.select("*", n.alias("n"), a.alias("a"), (F.lit(1) + F.floor((n - a) / (F.lit(3) + F.col("g") % 8))).alias("p"))
    copied = F.transform(F.sequence(F.lit(0).cast("long"), F.col("n") - 1), lambda i: F.get(
        "words", F.when(i < F.col("a"), i).otherwise(F.col("a") + (i - F.col("a")) % F.col("p")).cast("int")))
    return placed.select("doc_id", F.when(F.col("due"), F.array_join(copied, " ")).otherwise(F.col("text")).alias("text"))


def digest(collapsed: DataFrame) -> DataFrame:
    """Number of runs, the best run, and checksums of all runs and of the kept words."""
    listed = F.array_join(F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"])), "\n")
    ended = F.when(F.size("runs") > 0, F.concat(listed, F.lit("\n"))).otherwise(F.lit(""))
    best = [F.col("best").getField(name).alias(name) for name in RUN.names]
    exponent = F.floor(F.col("best.length") * 1000 / F.col("best.period")).cast("long")
    return collapsed.select("doc_id", F.size("runs").cast("long").alias("n_runs"), *best, exponent.alias("exponent_milli"),
                            F.sha2(ended, 256).alias("runs_sha256"), F.sha2("text", 256).alias("collapsed_sha256"))
