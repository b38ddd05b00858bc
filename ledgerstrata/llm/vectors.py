"""Exact top-k search by inner product over a pivot-distance index."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import importable, stored

SCALE = 256
#: Least and most pivots, the rows of one more, and the distinct vectors of least hash among which they are chosen: the
#: only sample.
PIVOTS, MOST_PIVOTS, PIVOT_ROWS, SAMPLE = 16, 256, 65_536, 2048
#: Rings of a pivot; vectors of an annulus; vectors and bytes of a part, a row of annuli in sorted order; queries of a pack.
RINGS, ANNULUS, PART, PART_BYTES, PACK = 16, 512, 8192, 1 << 22, 256
#: Widest search of the first step, in rings to either side of a query's own.
STEP = 1
#: Integers up to this size are exact in double precision, and scores are cut to the second one.
EXACT, LEAST, MOST = 2.0**53, -(2**63), 2**63 - 1
#: Vectors of greater squared length are compared without pivots.
LONGEST = 1e150


def encoded(x: list[float]) -> bytes:
    """A vector as its length and floor(256 x) of its components: 16-bit integers if all fit, else doubles."""
    wide = np.nan_to_num(np.floor(SCALE * np.array(x, float))) + 0.0
    narrow = np.abs(wide).max() <= 32767
    return len(x).to_bytes(4, "little") + wide.astype("<i2" if narrow else "<f8").tobytes()


def decoded(rows: list[bytes]) -> np.ndarray:
    """The integer components, as doubles, of encoded vectors of one length."""
    n = int.from_bytes(rows[0][:4], "little")
    sizes = np.array([(len(r) - 4) // n for r in rows])
    out = np.zeros((len(rows), n))
    for size, kind in ((2, "<i2"), (8, "<f8")):
        if (at := np.flatnonzero(sizes == size)).size:
            out[at] = np.frombuffer(b"".join(rows[i][4:] for i in at.tolist()), kind).reshape(len(at), n)
    return out


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products of integer rows: by doubles or 64-bit integers where these hold them, else by long integers.

    What is beyond 64 bits is cut to the least or greatest of them.
    """
    most = (np.abs(a).max(initial=0), np.abs(b).max(initial=0))
    bound = most[0] * most[1] * a.shape[1]
    if bound <= EXACT:
        return (a @ b.T).astype(np.int64)
    if max(bound, *most) < 2.0**62:
        return a.astype(np.int64) @ b.astype(np.int64).T
    whole = np.vectorize(int, otypes=[object])
    return np.clip(whole(a) @ whole(b).T, LEAST, MOST).astype(np.int64)


def quantised(rows: DataFrame) -> DataFrame:
    """(vec_id, n, v): length and encoded vector, without those that are null, empty or hold a null or non-finite component.

    Null ids are left out, too.
    """
    usable = rows.select("vec_id", "embedding").where(
        "vec_id is not null and size(embedding) > 0 and not exists(embedding, x -> x is null or isnan(x)"
        " or abs(cast(x as double)) = cast('Infinity' as double))"
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            vectors = b.column(1).to_pylist()
            yield pa.RecordBatch.from_arrays([
                b.column(0).cast(pa.int64()), pa.array(list(map(len, vectors)), pa.int32()),
                pa.array(list(map(encoded, vectors)), pa.binary())], ["vec_id", "n", "v"])

    return usable.mapInArrow(run, "vec_id long, n int, v binary")


def _distinct(vectors: DataFrame, most: int) -> DataFrame:
    """(n, v, ids): the least `most` ids of each distinct vector, joined map-side before the shuffle."""

    def least(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            kept: dict[bytes, list[int]] = {}
            for i, v in zip(b.column(0).to_pylist(), b.column(2).to_pylist(), strict=True):
                kept.setdefault(v, []).append(i)
            ids = [sorted(x)[:most] for x in kept.values()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(kept), pa.binary()), pa.array(ids, pa.list_(pa.int64()))], ["v", "ids"]
            )

    local = vectors.mapInArrow(least, "v binary, ids array<long>")
    gathered = local.groupBy("v").agg(F.flatten(F.collect_list("ids")).alias("ids"))
    length = F.conv(F.hex(F.reverse(F.substring("v", 1, 4))), 16, 10).cast("int")
    return gathered.select(length.alias("n"), "v", F.slice(F.array_sort("ids"), 1, most).alias("ids"))


class Pivots:
    """Pivots and the distances to them, after lifting vectors to one length so that inner products rank distances.

    Only vectors of n components have pivots. All others lie in cell 0 at distance 0, where no bound leaves them out.
    """

    def __init__(self, n: int, sample: np.ndarray, longest: float, pivots: int = PIVOTS):
        self.n, self.longest = n, longest
        points = self.lifted(sample)
        chosen = [0]
        near = self._to(points, points[0])
        while len(chosen) < min(pivots, len(points)) and near.max() > 0:
            chosen.append(int(near.argmax()))
            near = np.minimum(near, self._to(points, points[chosen[-1]]))
        self.points = points[chosen]
        self.width = max(1e-12, 2 * np.sqrt(max(self.longest, 1.0)) / RINGS)

    @staticmethod
    def _to(points: np.ndarray, one: np.ndarray) -> np.ndarray:
        return np.sqrt(((points - one) ** 2).sum(axis=1))

    def lifted(self, x: np.ndarray) -> np.ndarray:
        """x with one more component, the square root of what its squared length lacks of the longest."""
        lack = np.maximum(self.longest - (x**2).sum(axis=1), 0.0)
        return np.hstack([x, np.sqrt(lack)[:, None]])

    def distances(self, lifted: np.ndarray) -> np.ndarray:
        """Distances of rows to all pivots."""
        squares = (lifted**2).sum(axis=1)[:, None] + (self.points**2).sum(axis=1)[None, :] - 2 * lifted @ self.points.T
        return np.sqrt(np.maximum(squares, 0.0))

    def asked(self, q: np.ndarray) -> np.ndarray:
        """Distances of query rows, which have no part in the lifted component, to all pivots."""
        return self.distances(np.hstack([q, np.zeros((len(q), 1))]))

    def rings(self, distance: np.ndarray) -> np.ndarray:
        return np.minimum(distance // self.width, RINGS - 1).astype(np.int64)

    def radius(self, q: np.ndarray, worst: np.ndarray) -> np.ndarray:
        """Distance beyond which no vector scores `worst` or more; without bound where that is -inf.

        Widened by what the rounding of squared distances can come to.
        """
        length2 = (q**2).sum(axis=1) + self.longest
        known = worst > float(LEAST)
        reach = np.sqrt(np.maximum(length2 - 2 * np.where(known, worst, 0.0), 0.0))
        return np.where(known, reach + np.sqrt(16 * (q.shape[1] + 8) * length2 / EXACT), np.inf)


def _groups(keys: np.ndarray, most: int) -> list[tuple[int, int]]:
    """(start, end) of the runs of equal keys, in pieces of at most `most`."""
    edges = [0, *(np.flatnonzero(np.diff(keys)) + 1).tolist(), len(keys)]
    return [(i, min(i + most, z)) for a, z in zip(edges, edges[1:], strict=False) for i in range(a, z, most)]


def _index(distinct: DataFrame, pivots: Pivots) -> DataFrame:
    """The index: parts (part, n, cell, lo, hi, edges, vs, ids), each of annuli in the order of distance to the pivot.

    `edges` has the least and the greatest distance of each annulus; its vectors are ANNULUS of vs and ids.
    """

    def key(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            cells, least = np.zeros(b.num_rows, np.int64), np.zeros(b.num_rows)
            at = np.flatnonzero(b.column(0).to_numpy() == pivots.n)
            if len(at):
                d = pivots.distances(pivots.lifted(decoded(b.column(1).take(pa.array(at)).to_pylist())))
                own = d.argmin(axis=1)
                least[at] = d[np.arange(len(d)), own]
                cells[at] = own * RINGS + pivots.rings(least[at])
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(cells), pa.array(least), b.column(1), b.column(2)], ["n", "cell", "d", "v", "ids"])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            n, cells, d = (b.column(k).to_numpy() for k in (0, 1, 2))
            v, ids = b.column(3).to_pylist(), b.column(4).to_pylist()
            spans = []
            for a, z in _groups(n.astype(np.int64) * (MOST_PIVOTS * RINGS) + cells, len(n) + 1) if len(n) else []:
                most = max(ANNULUS, min(PART, PART_BYTES // max(map(len, v[a:z])) // ANNULUS * ANNULUS))
                spans += [(i, min(i + most, z)) for i in range(a, z, most)]
            edges = [[[float(d[i]), float(d[min(i + ANNULUS, z) - 1])] for i in range(a, z, ANNULUS)] for a, z in spans]
            yield pa.RecordBatch.from_pydict({
                "n": pa.array([int(n[a]) for a, _ in spans], pa.int32()),
                "cell": pa.array([int(cells[a]) for a, _ in spans], pa.int64()),
                "lo": pa.array([float(d[a]) for a, _ in spans], pa.float64()),
                "hi": pa.array([float(d[z - 1]) for _, z in spans], pa.float64()),
                "edges": pa.array(edges, pa.list_(pa.list_(pa.float64()))),
                "vs": pa.array([v[a:z] for a, z in spans], pa.list_(pa.binary())),
                "ids": pa.array([ids[a:z] for a, z in spans], pa.list_(pa.list_(pa.int64()))),
            })

    keyed = distinct.select("n", "v", "ids").mapInArrow(key, "n int, cell long, d double, v binary, ids array<long>")
    dealt = keyed.repartitionByRange("n", "cell", "d", F.xxhash64("v")).sortWithinPartitions("n", "cell", "d", "v")
    schema = "n int, cell long, lo double, hi double, edges array<array<double>>, vs array<binary>, ids array<array<long>>"
    return stored(dealt.mapInArrow(cut, schema).withColumn("part", F.monotonically_increasing_id()))


def _visit(asked: DataFrame, index: DataFrame, most: int, pivots: Pivots) -> DataFrame:
    """(qv, score, ids): the best of each part for each query that its bounds admit.

    `asked` has rows (n, cell, v, d, radius, worst): a query, its distance to the pivot of a cell, and the last score
    known. Inside a part annuli are opened from the nearest outwards, and the last score found closes the others.
    """

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            parts, v = b.column(0).to_numpy(), b.column(1).to_pylist()
            d, worst = (b.column(k).to_pylist() for k in (2, 3))
            spans = _groups(parts, PACK) if len(parts) else []
            yield pa.RecordBatch.from_pydict({
                "part": pa.array([int(parts[a]) for a, _ in spans], pa.int64()),
                "qs": pa.array([v[a:z] for a, z in spans], pa.list_(pa.binary())),
                "d": pa.array([d[a:z] for a, z in spans], pa.list_(pa.float64())),
                "worst": pa.array([worst[a:z] for a, z in spans], pa.list_(pa.float64())),
            })

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for row in b.to_pylist():
                yield _expanded(row, most, pivots)

    extents = index.select("part", "n", "cell", "lo", "hi")
    met = asked.join(extents, ["n", "cell"]).where("d - radius <= hi and d + radius >= lo")
    dealt = met.select("part", "v", "d", "worst").repartition("part").sortWithinPartitions("part")
    packed = dealt.mapInArrow(pack, "part long, qs array<binary>, d array<double>, worst array<double>")
    joined = packed.join(index.select("part", "edges", "vs", "ids"), "part")
    return joined.mapInArrow(compare, "qv binary, score long, ids array<long>")


def _expanded(row: dict, most: int, pivots: Pivots) -> pa.RecordBatch:
    """(qv, score, ids) of a pack's queries in a part: of each query the `most` best vectors and all ties of the last."""
    q, x, d, worst = decoded(row["qs"]), decoded(row["vs"]), np.array(row["d"]), np.array(row["worst"])
    edges = np.array(row["edges"])
    gaps = np.maximum(0.0, np.maximum(edges[None, :, 0] - d[:, None], d[:, None] - edges[None, :, 1]))
    best = np.full((len(q), most), LEAST, np.int64)
    have = np.zeros(len(q), np.int64)
    rows, columns, scores = [], [], []
    order = np.argsort(gaps, axis=1, kind="stable")
    live = np.arange(len(q))
    for step in range(len(edges)):
        # Gaps only grow from here on, so that a query beyond its bound is done.
        live = live[gaps[live, order[live, step]] <= pivots.radius(q[live], worst[live])]
        for annulus in np.unique(order[live, step]).tolist():
            at = live[order[live, step] == annulus]
            start = annulus * ANNULUS
            score = products(q[at], x[start : start + ANNULUS])
            i, j = np.nonzero(score >= worst[at][:, None])
            rows.append(at[i])
            columns.append(start + j)
            scores.append(score[i, j])
            best[at] = np.partition(np.hstack([best[at], score]), score.shape[1], axis=1)[:, -most:]
            have[at] += score.shape[1]
            full = at[have[at] >= most]
            worst[full] = np.maximum(worst[full], best[full].min(axis=1))
    i, j, s = (np.concatenate(c) if c else np.zeros(0, np.int64) for c in (rows, columns, scores))
    keep = s >= worst[i]
    return pa.RecordBatch.from_arrays([
        pa.array([row["qs"][r] for r in i[keep].tolist()], pa.binary()), pa.array(s[keep], pa.int64()),
        pa.array([row["ids"][c] for c in j[keep].tolist()], pa.list_(pa.int64())),
    ], ["qv", "score", "ids"])


def _top(found: DataFrame, most: int) -> DataFrame:
    """(qv, top): the best `most` (score, vec_id) of each query vector, best first, folded map-side."""

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            best: dict[bytes, list[tuple[int, int]]] = {}
            for q, tops in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                best.setdefault(q, []).extend((-t["score"], t["vec_id"]) for t in tops)
            tops = [[{"score": -s, "vec_id": i} for s, i in sorted(set(x))[:most]] for x in best.values()]
            kind = pa.list_(pa.struct([("score", pa.int64()), ("vec_id", pa.int64())]))
            yield pa.RecordBatch.from_arrays([pa.array(list(best), pa.binary()), pa.array(tops, kind)], ["qv", "top"])

    schema = "qv binary, top array<struct<score: long, vec_id: long>>"
    rows = found.select("qv", F.transform("ids", lambda i: F.struct("score", i.alias("vec_id"))).alias("top"))
    some = rows.mapInArrow(fold, schema)
    ordered = F.array_sort(F.array_distinct(F.flatten(F.collect_list("top"))), lambda a, b: F.when(
        (a["score"] > b["score"]) | ((a["score"] == b["score"]) & (a["vec_id"] < b["vec_id"])), -1
    ).when((a["score"] == b["score"]) & (a["vec_id"] == b["vec_id"]), 0).otherwise(1))
    return some.groupBy("qv").agg(F.slice(ordered, 1, most).alias("top"))


def search(rows: DataFrame, asked: DataFrame, k: int = 5) -> DataFrame:
    """The k best vectors of `rows` by integer inner product for each row of `asked`, itself apart.

    Both have vec_id and embedding; other columns are not read. Returns query_id, rank (from 1), vec_id and score; ties
    go to the smaller vec_id; fewer than k if there are no more. Vectors that are null, empty or hold null or non-finite
    components take no part; neither do null ids. Vectors are compared with those of their own length. Repeated vectors
    are searched once, with their k + 1 least ids, and so are repeated queries; very long vectors make shorter parts.
    Scores are exact, and cut to 64 bits where they are beyond. An empty table gives no rows.

    Vectors are lifted to one length, so that the best inner product is the least distance. The index keys each by its
    nearest pivot and its distance to it, in sorted annuli. A query first visits the rings around its own place; the
    last score found bounds the distance of anything better, so that only parts come next whose distances to their
    pivot are within it of the query's, by the triangle inequality. In each part annuli are opened from the nearest
    outwards until the bound of the last score then known closes the rest. Pivots are those of the most frequent length;
    vectors of other lengths are compared in blocks with all of theirs.
    """
    importable(rows)
    distinct = stored(_distinct(quantised(rows), k + 1))
    lengths = distinct.groupBy("n").agg(F.count("*").alias("c")).orderBy(F.desc("c"), "n").first()
    if lengths is None:
        return rows.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    own = distinct.where(F.col("n") == lengths["n"])

    def squares(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                yield pa.RecordBatch.from_arrays([pa.array((decoded(b.column(0).to_pylist()) ** 2).sum(axis=1))], ["s"])

    longest = own.select("v").mapInArrow(squares, "s double").agg(F.max("s")).first()[0]
    sample = decoded([r["v"] for r in own.select("v").orderBy(F.xxhash64("v"), "v").limit(SAMPLE).collect()])
    if longest <= LONGEST:
        pivots = Pivots(lengths["n"], sample, longest, min(MOST_PIVOTS, max(PIVOTS, lengths["c"] // PIVOT_ROWS)))
    else:
        pivots = Pivots(0, np.zeros((1, 1)), 0.0)
    index = _index(distinct, pivots)
    # At most a row for each ring of a pivot: the extent of each cell.
    extent = sorted((r["cell"], r["lo"], r["hi"]) for r in index.where(F.col("n") == pivots.n).groupBy("cell").agg(
        F.min("lo").alias("lo"), F.max("hi").alias("hi")).collect())
    cells = np.array([e[0] for e in extent], np.int64)
    lo, hi = (np.array([e[s] for e in extent]) for s in (1, 2))
    at = cells // RINGS
    queries = stored(quantised(asked))
    vs = queries.select("n", "v").distinct()

    def ask(n: np.ndarray, v: list[bytes], worst: np.ndarray, later: bool) -> pa.RecordBatch:
        """Rows (n, cell, v, d, radius, worst) of the cells that queries visit first or, `later`, of all others in reach."""
        mine = np.flatnonzero(n == pivots.n)
        i, c, d, r = ([np.zeros(0, t)] for t in (np.int64, np.int64, float, float))
        if len(mine) and len(cells):
            q = decoded([v[m] for m in mine.tolist()])
            to = pivots.asked(q)
            near = to.argmin(axis=1)
            ring = pivots.rings(to[np.arange(len(to)), near])
            hits = (at[None, :] == near[:, None]) & (np.abs(cells[None, :] % RINGS - ring[:, None]) <= STEP)
            radius = pivots.radius(q, worst[mine])
            if later:
                reach = radius[:, None]
                hits = ~hits & (to[:, at] - reach <= hi) & (to[:, at] + reach >= lo)
            x, y = np.nonzero(hits)
            i, c, d, r = i + [mine[x]], c + [cells[y]], d + [to[x, at[y]]], r + [radius[x]]
        if not later:
            other = np.flatnonzero(n != pivots.n)
            i, c, d, r = i + [other], c + [np.zeros_like(other)], d + [np.zeros(len(other))], r + [np.full(len(other), np.inf)]
        i, c, d, r = map(np.concatenate, (i, c, d, r))
        return pa.RecordBatch.from_arrays(
            [pa.array(n[i], pa.int32()), pa.array(c), pa.array([v[m] for m in i.tolist()], pa.binary()), pa.array(d), pa.array(r),
             pa.array(worst[i])], ["n", "cell", "v", "d", "radius", "worst"])

    def asks(later: bool):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                n, v, worst = b.column(0).to_numpy(), b.column(1).to_pylist(), b.column(2).to_numpy()
                for s in range(0, len(n), PACK):
                    yield ask(n[s : s + PACK], v[s : s + PACK], worst[s : s + PACK], later)

        return run

    schema = "n int, cell long, v binary, d double, radius double, worst double"
    unknown = F.lit(float("-inf"))
    start = vs.select("n", "v", unknown.alias("worst")).mapInArrow(asks(False), schema)
    begun = stored(_top(_visit(start, index, k + 1, pivots), k + 1))
    last = F.when(F.size("top") > k, F.element_at("top", -1)["score"].cast("double"))
    known = vs.join(begun.select(F.col("qv").alias("v"), last.alias("worst")), "v", "left")
    further = known.select("n", "v", F.coalesce("worst", unknown).alias("worst")).mapInArrow(asks(True), schema)
    more = _visit(further, index, k + 1, pivots)
    before = begun.select(F.col("qv"), F.explode("top").alias("t")).select(
        "qv", F.col("t.score").alias("score"), F.array("t.vec_id").alias("ids"))
    best = _top(more.unionByName(before), k + 1)
    joined = queries.join(best, queries["v"] == best["qv"])
    others = F.slice(F.filter("top", lambda t: t["vec_id"] != F.col("q_id")), 1, k)
    ranked = joined.withColumnRenamed("vec_id", "q_id").select("q_id", F.posexplode(others).alias("at", "t"))
    return ranked.select(
        F.col("q_id").alias("query_id"), (F.col("at") + 1).cast("int").alias("rank"),
        F.col("t.vec_id").alias("vec_id"), F.col("t.score").alias("score"),
    )
