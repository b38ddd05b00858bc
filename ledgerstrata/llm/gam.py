"""Quality classifier: a generalised additive model with pairwise interactions, boosted feature by feature."""

from __future__ import annotations

import pickle
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import gapless, importable, stored
from .textstats import BLANKS, SYMBOLS, Words, duplicate_lines

#: Labelled rows of a block. Every one is in a block, each block is fitted by a task, and the models are averaged.
BLOCK = 20_000
#: Up to so many labels (24 MB) are broadcast, and only their documents described; beyond it all are, so that no text moves.
BROADCAST_LABELS = 300_000
#: Bins of a feature; of each side of a pair; pairs; boosting rounds of features and of pairs; step; smoothing.
BINS, PAIR_BINS, PAIRS, ROUNDS, PAIR_ROUNDS, RATE, SMOOTH = 32, 8, 8, 120, 40, 0.15, 2.0
#: Rows with this remainder of crc32(doc_id as text) are held out of fitting; a score from CUT on is label 1.
HELD_OUT, FOLDS, CUT = 2, 4, 0.7

FEATURES = (
    "log_words", "word_length", "distinct", "top_word", "adjacent", "repeated", "symbols", "exclaims", "bars", "upper",
    "digits", "dup_lines", "line_length", "stops", "commas", "longest", "short_words", "capital_words", "wide_chars",
    "single_chars", "marked_words",
)


def features(text: str) -> np.ndarray:
    """Numbers that describe the whole text, its language and origin apart. All zero for a text without words."""
    data = text.encode()
    words = Words(data)
    n = len(words)
    if not n:
        return np.zeros(len(FEATURES))
    raw = np.frombuffer(data, np.uint8)
    seen = np.bincount(raw, minlength=256)
    at = lambda characters: seen[list(characters.encode())].sum()
    chars = max(1, len(text) - at(BLANKS))
    # Capitals of ASCII and of the accented letters whose lead byte is C3.
    wide = ((raw[:-1] == 0xC3) & (raw[1:] < 0x9F)).sum() if seen[0xC3] else 0
    lines = seen[ord("\n")] + 1
    sizes = np.fromiter(map(len, words.words), np.int64, n)
    _, times = np.unique(words.hashes, return_counts=True)
    first = np.concatenate([[0], np.flatnonzero(_BLANK[raw[:-1]] & ~_BLANK[raw[1:]]) + 1])
    return np.array([
        np.log1p(n), chars / n, len(times) / n, times.max() / n, (words.hashes[1:] == words.hashes[:-1]).sum() / n,
        words.repeated() / n, at(SYMBOLS) / chars, at("!") / n, at("|") / n, (seen[65:91].sum() + wide) / chars,
        at("0123456789") / chars, duplicate_lines(text) / lines, np.log1p(n / lines), at(".") / n, at(",") / n,
        np.log1p(sizes.max()), (sizes <= 3).sum() / n, ((raw[first] > 64) & (raw[first] < 91)).sum() / n,
        (len(data) - len(text)) / chars, (sizes == 1).sum() / n, _MARK[raw[:-1][_BLANK[raw[1:]]]].sum() / n,
    ])


_BLANK = np.isin(np.arange(256), list(BLANKS.encode()))
_MARK = np.array([33 <= i < 127 and not chr(i).isalnum() for i in range(256)])


def _halve(grad: np.ndarray, hess: np.ndarray, leaves: int) -> np.ndarray:
    """A shallow tree over ordered bins: Newton values of at most `leaves` runs of bins."""
    g, h = np.concatenate([[0], np.cumsum(grad)]), np.concatenate([[0], np.cumsum(hess)])
    cuts = [0, len(grad)]
    for _ in range(leaves - 1):
        best, where = 1e-9, None
        for a, z in zip(cuts, cuts[1:], strict=False):
            k = np.arange(a + 1, z)
            if not len(k):
                continue
            part = lambda i, j: (g[j] - g[i]) ** 2 / (h[j] - h[i] + SMOOTH)
            gain = part(a, k) + part(k, z) - part(a, z)
            if gain.max() > best:
                best, where = gain.max(), int(k[gain.argmax()])
        if where is None:
            break
        cuts = sorted([*cuts, where])
    out = np.zeros(len(grad))
    for a, z in zip(cuts, cuts[1:], strict=False):
        out[a:z] = (g[z] - g[a]) / (h[z] - h[a] + SMOOTH)
    return out


def _quarter(grad: np.ndarray, hess: np.ndarray) -> tuple[np.ndarray, float]:
    """A tree over a grid, cut once along each side: Newton values and gain of the best four quadrants."""
    g, h = (np.pad(x.cumsum(0).cumsum(1), ((1, 0), (1, 0))) for x in (grad, hess))
    i, j = (x[:, None] if k == 0 else x[None, :] for k, x in enumerate(np.arange(1, s) for s in grad.shape))
    a, b = grad.shape

    def box(x: np.ndarray) -> list[np.ndarray]:
        return [x[i, j], x[i, b] - x[i, j], x[a, j] - x[i, j], x[a, b] - x[i, b] - x[a, j] + x[i, j]]

    gs, hs = box(g), box(h)
    gain = sum(x**2 / (y + SMOOTH) for x, y in zip(gs, hs, strict=True))
    at = np.unravel_index(gain.argmax(), gain.shape)
    out = np.empty(grad.shape)
    cut = (slice(0, at[0] + 1), slice(at[0] + 1, None)), (slice(0, at[1] + 1), slice(at[1] + 1, None))
    for k, (x, y) in enumerate(zip(gs, hs, strict=True)):
        out[cut[0][k // 2], cut[1][k % 2]] = x[at] / (y[at] + SMOOTH)
    return out, float(gain[at])


@dataclass
class Model:
    """Lookup tables of single features and of pairs; a score is the logistic of their sum."""

    base: float
    edges: list[np.ndarray] = field(default_factory=list)
    coarse: list[np.ndarray] = field(default_factory=list)
    tables: list[np.ndarray] = field(default_factory=list)
    pairs: list[tuple[int, int, np.ndarray]] = field(default_factory=list)

    def score(self, x: np.ndarray) -> np.ndarray:
        """Scores in (0, 1) of rows of features: bins looked up and added."""
        total = np.full(len(x), self.base)
        for k, table in enumerate(self.tables):
            total += table[np.searchsorted(self.edges[k], x[:, k], side="right")]
        for i, j, table in self.pairs:
            bins = (np.searchsorted(self.coarse[k], x[:, k], side="right") for k in (i, j))
            total += table[tuple(bins)]
        return 1 / (1 + np.exp(-total))


def quantiles(x: np.ndarray) -> np.ndarray:
    """The bounds of BINS and of PAIR_BINS bins of equal numbers of rows, for each feature."""
    parts = np.concatenate([np.arange(1, bins) / bins for bins in (BINS, PAIR_BINS)])
    return np.quantile(x, parts, axis=0).T


def fit(x: np.ndarray, y: np.ndarray, bounds: np.ndarray | None = None) -> Model:
    """Boost each feature in turn with small steps, then the pairs that explain most of what is left.

    `bounds` of the bins are the quantiles of the rows unless given.
    """
    if not len(y):
        return Model(50.0)
    rate = (y.sum() + 0.5) / (len(y) + 1)
    model = Model(float(np.log(rate / (1 - rate))))
    if y.min() == y.max():
        return model
    bounds = quantiles(x) if bounds is None else bounds
    model.edges, model.coarse = (list(map(np.unique, part)) for part in (bounds[:, : BINS - 1], bounds[:, BINS - 1 :]))
    bins = [np.searchsorted(e, x[:, k], side="right") for k, e in enumerate(model.edges)]
    model.tables = [np.zeros(len(e) + 1) for e in model.edges]
    total = np.full(len(y), model.base)
    for _ in range(ROUNDS):
        for k, at in enumerate(bins):
            p = 1 / (1 + np.exp(-total))
            size = len(model.tables[k])
            step = RATE * _halve(np.bincount(at, y - p, size), np.bincount(at, p * (1 - p), size), 3)
            model.tables[k] += step
            total += step[at]
    rough = [np.searchsorted(e, x[:, k], side="right") for k, e in enumerate(model.coarse)]
    sides = [len(e) + 1 for e in model.coarse]

    def grids(i: int, j: int) -> tuple[np.ndarray, np.ndarray]:
        p = 1 / (1 + np.exp(-total))
        cell, shape = rough[i] * sides[j] + rough[j], (sides[i], sides[j])
        return tuple(np.bincount(cell, w, shape[0] * shape[1]).reshape(shape) for w in (y - p, p * (1 - p)))

    able = [k for k in range(x.shape[1]) if sides[k] > 1]
    ranked = sorted(combinations(able, 2), key=lambda ij: -_quarter(*grids(*ij))[1])[:PAIRS]
    model.pairs = [(i, j, np.zeros((sides[i], sides[j]))) for i, j in ranked]
    for _ in range(PAIR_ROUNDS):
        for i, j, table in model.pairs:
            step = RATE * _quarter(*grids(i, j))[0]
            table += step
            total += step[rough[i], rough[j]]
    return model


def merge(models: Iterable[Model]) -> Model:
    """The model whose sums are the means of those of all models, which have the same bins. One stays as it is."""
    n, out, pairs = 0, Model(0.0), {}
    for model in models:
        n += 1
        out.base += model.base
        if model.tables:
            out.edges, out.coarse = model.edges, model.coarse
            out.tables = [a + b for a, b in zip(out.tables, model.tables, strict=True)] if out.tables else model.tables
        for i, j, table in model.pairs:
            pairs[i, j] = pairs[i, j] + table if (i, j) in pairs else table
    out.base, out.tables = out.base / n, [table / n for table in out.tables]
    out.pairs = [(i, j, table / n) for (i, j), table in pairs.items()]
    return out


def remainder():
    return F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(FOLDS))


def _described(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, quality, x): the features of all documents with a label outside the held-out fold."""

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = [features(t or "").tolist() for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(rows, pa.list_(pa.float64()))], ["doc_id", "x"])

    single = labels.where("doc_id is not null and quality is not null").groupBy("doc_id").agg(
        F.min("quality").alias("quality"), F.max("quality").alias("most")
    )
    usable = stored(single.where("quality = most").where(remainder() != HELD_OUT).select("doc_id", F.col("quality").cast("double")))
    wanted = docs.where(remainder() != HELD_OUT)
    if usable.count() <= BROADCAST_LABELS:
        wanted = wanted.join(F.broadcast(usable.select("doc_id")), "doc_id", "left_semi")
    kind = docs.schema["doc_id"].dataType.simpleString()
    described = wanted.select("doc_id", "text").mapInArrow(describe, f"doc_id {kind}, x array<double>")
    return described.join(usable, "doc_id").select("doc_id", "quality", "x")


def train(docs: DataFrame, labels: DataFrame, block: int = BLOCK) -> Model:
    """Fit on all labelled documents outside the held-out fold.

    They are dealt into blocks of at most `block` rows. A task fits a block by itself, in the same bins for all, whose
    bounds are the means of the blocks' quantiles; the sums of the models are averaged. The driver holds one model at a
    time. Labels that are null or contradict each other are left out. Without labels every score is about 1.
    """
    importable(docs)
    rows = stored(_described(docs, labels))
    blocks = -(-rows.count() // block)
    if not blocks:
        return fit(np.zeros((0, len(FEATURES))), np.zeros(0))
    dealt = rows.withColumn("block", F.lit(0).cast("long"))
    if blocks > 1:
        numbered = gapless(rows, [], ["doc_id", "quality", "x"], "place")
        dealt = stored(numbered.select("doc_id", "quality", "x", F.pmod("place", F.lit(blocks)).alias("block")))

    def each(work) -> Iterator:
        """What `work` makes of the features and labels of each block, block by block."""

        def run(found: pa.Table) -> pa.Table:
            given = sorted(zip(*(found.column(c).to_pylist() for c in ("doc_id", "x", "quality")), strict=True))
            made = work(np.array([r[1] for r in given]), np.array([r[2] for r in given]))
            return pa.table({"block": found.column("block").slice(0, 1), "made": pa.array([pickle.dumps(made)], pa.binary())})

        made = stored(dealt.groupBy("block").applyInArrow(run, "block long, made binary"))
        return (pickle.loads(r["made"]) for r in made.orderBy("block").toLocalIterator())

    bounds = sum(each(lambda x, y: quantiles(x))) / blocks
    return merge(each(lambda x, y: fit(x, y, bounds)))


def _scores(model: Model, texts: pa.Array) -> np.ndarray:
    x = np.array([features(t or "") for t in texts.to_pylist()]).reshape(-1, len(FEATURES))
    return model.score(x)


def classify(docs: DataFrame, labels: DataFrame, block: int = BLOCK) -> DataFrame:
    """Score every whole document: doc_id, held_out, score and predicted.

    A null text is an empty one and gets the score of a text without words. A null doc_id is not held out. Repeated rows
    get equal scores. An empty table gives no rows. Only doc_id and text are read, and doc_id decides the fold alone.
    """
    model = train(docs, labels, block)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(_scores(model, b.column(2)))],
                                             ["doc_id", "held_out", "score"])

    held = F.coalesce(remainder() == HELD_OUT, F.lit(False)).alias("held_out")
    kind = docs.schema["doc_id"].dataType.simpleString()
    scored = docs.select("doc_id", held, "text").mapInArrow(run, f"doc_id {kind}, held_out boolean, score double")
    return scored.withColumn("predicted", (F.col("score") >= CUT).cast("int"))


def accept(docs: DataFrame, labels: DataFrame, cut: float = CUT, block: int = BLOCK) -> DataFrame:
    """The documents whose score is at least `cut`, with all columns. No row is shuffled."""
    model = train(docs, labels, block)
    text = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield b.filter(pa.array(_scores(model, b.column(text)) >= cut))

    return docs.mapInArrow(run, docs.schema)
