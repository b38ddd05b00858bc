"""Line dedup: a segment-partition edit join of lines."""

from __future__ import annotations

import struct
from collections.abc import Iterator
from functools import reduce
from itertools import count

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import importable, stored
from .textstats import BLANKS

#: Edits (inserted, deleted or changed characters) between near lines; shorter lines are compared for equality only.
EDITS, MIN_CHARS = 2, 24
#: A key of more lines than this is refined by a second segment, and so on; one that is too short for it is dealt in
#: pairs of blocks of about so many lines.
HOT = 2000
#: Lines to be verified are found by a broadcast up to this many (16 MB); beyond it by a shuffle of lines.
BROADCAST_LINES = 1_000_000
#: Cells of character matrices verified at once.
CELLS = 1 << 21
#: Pairs of a key verified at once.
BATCH = 20_000
_HALVES = struct.Struct(">qq")


def lines_of(text: str) -> list[tuple[int, str]]:
    """(place, line without blanks at its ends) of the lines with a word."""
    return [(i, s) for i, line in enumerate(text.split("\n")) if (s := line.strip(BLANKS))]


def line_hash(line: str) -> tuple[int, int]:
    """The two 64-bit halves of a line's hash: together they name it, and the first alone finds candidates."""
    return _HALVES.unpack(xxhash.xxh3_128_digest(line.encode()))


def segments(n: int, parts: int) -> list[tuple[int, int]]:
    """(start, size) of `parts` segments of n characters, sizes one apart at most, longer ones last."""
    size, longer = divmod(n, parts)
    sizes = [size + (i >= parts - longer) for i in range(parts)]
    return [(sum(sizes[:i]), s) for i, s in enumerate(sizes)]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


class Keys:
    """Segment keys of lines: equal for an indexed segment and a substring that it may match.

    With `edits` + 1 segments at least one segment of a line is untouched in any line within `edits`. A line is probed
    against indexed lengths from its own down to `edits` less; the places of a segment in it are those that leave at
    most i edits before segment i and edits - i behind it. Keys in `hot` are replaced by keys of a segment more: the
    longer side of the matched segment is cut in its turn, for the edits that side may hold.
    """

    def __init__(self, edits: int, hot: frozenset[int] = frozenset()):
        self.edits, self.hot = edits, hot
        self.places: dict[int, tuple[list[tuple[int, int, int]], list[tuple[int, int, int]]]] = {}

    def first(self, line: str) -> dict[int, bool]:
        """`of` with nothing hot, its keys unsigned: where the segments of a line are depends on its length alone."""
        data, n = line.encode("utf-32-le"), len(line)
        if n not in self.places:
            self.places[n] = self._places(n)
        probes, own = self.places[n]
        found = dict.fromkeys([xxhash.xxh3_64_intdigest(data[a:z], seed) for a, z, seed in probes], False)
        for a, z, seed in own:
            found[xxhash.xxh3_64_intdigest(data[a:z], seed)] = True
        return found

    def _places(self, n: int) -> tuple[list[tuple[int, int, int]], list[tuple[int, int, int]]]:
        """(start, end, seed) of the segments a line of n characters probes with, its own ones apart, in bytes."""
        own, probes = [], []
        for length in range(n - self.edits, n + 1):
            if length < MIN_CHARS and length < n:
                continue
            for i, (p, size) in enumerate(segments(length, self.edits + 1)):
                if length == n:
                    own.append((4 * p, 4 * (p + size), self._seed(n, i, 0)))
                if length >= MIN_CHARS:
                    spots = (at for at in self._spots(n, length, p, size, i, self.edits) if length < n or at != p)
                    probes += [(4 * at, 4 * (at + size), self._seed(length, i, 0)) for at in spots]
        return probes, own

    def of(self, line: str) -> dict[int, bool]:
        """Keys of a line: true for its own segments, false for those it only probes with."""
        data, n = line.encode("utf-32-le"), len(line)
        found: dict[int, bool] = {}
        for length in range(n - self.edits, n + 1):
            if length >= MIN_CHARS:
                self._probe(data, n, length, self.edits, 0, found)
        self._own(data, n, self.edits, 0, found)
        return found

    @staticmethod
    def _seed(length: int, i: int, parent: int) -> int:
        return (parent ^ (length * 16 + i) * 0x9E3779B97F4A7C15) & ((1 << 64) - 1)

    def _key(self, data: bytes, start: int, size: int, length: int, i: int, parent: int) -> int:
        return _signed(xxhash.xxh3_64_intdigest(data[4 * start : 4 * (start + size)], self._seed(length, i, parent)))

    @staticmethod
    def _spots(n: int, length: int, p: int, size: int, i: int, edits: int) -> range:
        """Where segment i of an indexed length, at p there, may stand in n characters."""
        delta = n - length
        low = max(0, p - i, p + delta - (edits - i))
        return range(low, min(n - size, p + i, p + delta + (edits - i)) + 1)

    def _own(self, data: bytes, n: int, edits: int, parent: int, found: dict[int, bool]) -> None:
        for i, (p, size) in enumerate(segments(n, edits + 1)):
            key = self._key(data, p, size, n, i, parent)
            side = self._side(n, p, size, i, edits)
            if key in self.hot and side:
                right, inside, left = side
                part = data[4 * (p + size) :] if right else data[: 4 * p]
                self._own(part, inside, left, key, found)
            else:
                found[key] = True

    def _probe(self, data: bytes, n: int, length: int, edits: int, parent: int, found: dict[int, bool]) -> None:
        for i, (p, size) in enumerate(segments(length, edits + 1)):
            for at in self._spots(n, length, p, size, i, edits):
                key = self._key(data, at, size, length, i, parent)
                side = self._side(length, p, size, i, edits)
                if key in self.hot and side:
                    right, inside, left = side
                    part = data[4 * (at + size) :] if right else data[: 4 * at]
                    if abs(len(part) // 4 - inside) <= left:
                        self._probe(part, len(part) // 4, inside, left, key, found)
                else:
                    found.setdefault(key, False)

    @staticmethod
    def _side(length: int, p: int, size: int, i: int, edits: int) -> tuple[bool, int, int] | None:
        """The longer side of segment i: whether it is the right one, its length and its edits; None if too short."""
        right = length - p - size >= p
        inside, left = (length - p - size, edits - i) if right else (p, i)
        return (right, inside, left) if inside > left else None


def within(pairs: list[tuple[str, str]], edits: int) -> np.ndarray:
    """Which pairs are at most `edits` edits apart, by banded bit-parallel dynamic programming over many pairs at once.

    A column's band of 2 x edits + 1 vertical differences is two bit vectors. The distance is followed down the band's
    lowest diagonal to the end of the first line and then along its last row. Pairs leave when it is over for good.
    """
    out = np.zeros(len(pairs), bool)
    order = sorted(range(len(pairs)), key=lambda k: len(pairs[k][0]))
    at = 0
    while at < len(order):
        longest = max(len(pairs[order[at]][0]), len(pairs[order[at]][1]))
        to = at + 1
        while to < len(order) and (to + 1 - at) * (len(pairs[order[to]][0]) + 2 * edits) <= CELLS:
            to += 1
        chosen = order[at:to]
        out[chosen] = _band([pairs[k] for k in chosen], edits)
        at = to
    return out


def _matrix(lines: list[str], width: int, fill: int) -> np.ndarray:
    out = np.full((len(lines), width), fill, np.uint32)
    for row, line in zip(out, lines, strict=True):
        row[: len(line)] = np.frombuffer(line.encode("utf-32-le"), np.uint32)
    return out


def _band(pairs: list[tuple[str, str]], edits: int) -> np.ndarray:
    m, n = (np.array([len(p[k]) for p in pairs]) for k in (0, 1))
    result = np.zeros(len(pairs), bool)
    alive = np.flatnonzero((np.abs(m - n) <= edits) & (m > edits))
    for k in np.flatnonzero((m <= edits) & (np.abs(m - n) <= edits)).tolist():
        result[k] = _plain(*pairs[k]) <= edits
    if not len(alive):
        return result
    width = 2 * edits + 1
    every, top = np.uint64((1 << width) - 1), np.uint64(1 << (width - 1))
    one, zero = np.uint64(1), np.uint64(0)
    # The pattern is padded by `edits` on the left, so that the band's first row is at column i of the matrix.
    first = np.hstack([np.full((len(alive), edits), 0xFFFFFFFE, np.uint32),
                       _matrix([pairs[k][0] for k in alive], int(m.max()) + 2 * edits + 1, 0xFFFFFFFE)])
    second = _matrix([pairs[k][1] for k in alive], int(n.max()), 0xFFFFFFFF)
    m, n = m[alive], n[alive]
    vp = np.full(len(alive), (every << np.uint64(width - edits - 1)) & every, np.uint64)
    vn = np.zeros(len(alive), np.uint64)
    distance = np.full(len(alive), edits)
    level = np.full(len(alive), top, np.uint64)
    for i in range(int(n.max())):
        x = np.zeros(len(alive), np.uint64)
        for b in range(width):
            x |= (first[:, i + b] == second[:, i]).astype(np.uint64) << np.uint64(b)
        d0 = ((((x & vp) + vp) ^ vp) | x | vn) & every
        hp, hn = (vn | ~(d0 | vp)) & every, d0 & vp
        down, live = i < m - edits, i < n
        level = np.where(down, top, level >> one)
        step = np.where(down, (d0 & top) == zero, ((hp & level) != zero).astype(int) - ((hn & level) != zero))
        distance += np.where(live, step, 0)
        vp, vn = (hn | ~((d0 >> one) | hp)) & every, (d0 >> one) & hp
        if i % 16 == 15 or i + 1 == n.max():
            # The last 2 x edits columns can lower the distance by as much; a pair over that is out.
            over, done = distance > 3 * edits, n <= i + 1
            result[alive[done & (distance <= edits)]] = True
            keep = ~(over | done)
            if not keep.any():
                break
            if not keep.all():
                alive, first, second, m, n, vp, vn, distance, level = (
                    a[keep] for a in (alive, first, second, m, n, vp, vn, distance, level))
    return result


def _plain(a: str, b: str) -> int:
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def _rows(b: pa.RecordBatch) -> Iterator[tuple]:
    return zip(*[c.to_pylist() for c in b.columns], strict=True)


def _placed(docs: DataFrame) -> DataFrame:
    """(h, g, k, l, pos, doc_id): every line with a word."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            row, h, g, pos = [], [], [], []
            for r, text in enumerate(b.column(2).to_pylist()):
                for i, line in lines_of(text or ""):
                    one, other = line_hash(line)
                    row.append(r)
                    h.append(one)
                    g.append(other)
                    pos.append(i)
            at = pa.array(row, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [pa.array(h, pa.int64()), pa.array(g, pa.int64()), b.column(0).take(at), b.column(1).take(at),
                 pa.array(pos, pa.int32()), b.column(3).take(at)], ["h", "g", "k", "l", "pos", "doc_id"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("k", "l", "text", "doc_id").mapInArrow(run, f"h long, g long, k long, l long, pos int, doc_id {kind}")


def _spoken(docs: DataFrame) -> DataFrame:
    """(h, g, line): lines long enough to be near others, each once in a task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[tuple[int, int]] = set()
        for b in batches:
            names, found = [], []
            for (text,) in _rows(b):
                for _, line in lines_of(text or ""):
                    if len(line) >= MIN_CHARS and (name := line_hash(line)) not in seen:
                        seen.add(name)
                        names.append(name)
                        found.append(line)
            yield pa.RecordBatch.from_arrays(
                [*(pa.array([n[k] for n in names], pa.int64()) for k in (0, 1)), pa.array(found, pa.string())], ["h", "g", "line"])

    return docs.select("text").mapInArrow(run, "h long, g long, line string")


def _told(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """(h, g, line): the lines of the hashes `wanted` (w), each once."""
    wanted = stored(wanted)
    side = F.broadcast(wanted) if wanted.count() <= BROADCAST_LINES else wanted
    known = _spoken(docs).join(side, F.col("h") == F.col("w"), "left_semi")
    return known.groupBy("h", "g").agg(F.min("line").alias("line"))


def _keyed(docs: DataFrame, edits: int) -> DataFrame:
    """(key, own, h): keys of lines, each line once in a task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        maker = Keys(edits)
        seen: set[tuple[int, int]] = set()
        for b in batches:
            keys, owns, hs, sizes = [], [], [], []
            for (text,) in _rows(b):
                for _, line in lines_of(text or ""):
                    if len(line) < MIN_CHARS or (name := line_hash(line)) in seen:
                        continue
                    seen.add(name)
                    found = maker.first(line)
                    keys += found
                    owns += found.values()
                    hs.append(name[0])
                    sizes.append(len(found))
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.array(keys, np.uint64).view(np.int64)), pa.array(np.array(owns, bool)),
                 pa.array(np.repeat(np.array(hs, np.int64), np.array(sizes, np.int64)))], ["key", "own", "h"])

    return docs.select("text").mapInArrow(run, "key long, own boolean, h long")


def _refined(docs: DataFrame, hot: DataFrame, edits: int) -> DataFrame:
    """(key, own, h, short): the keys that replace the newest hot ones of each line; `short` ones cannot be replaced.

    `hot` has rows (key, h, round) of all rounds. Whether a key of a line is hot stands with the line, so that nobody
    needs the hot keys of all.
    """
    newest = hot.agg(F.max("round")).first()[0]
    of_line = stored(hot.groupBy(F.col("h").alias("w")).agg(
        F.collect_set(F.when(F.col("round") < newest, F.col("key"))).alias("was"),
        F.collect_set(F.when(F.col("round") == newest, F.col("key"))).alias("now")).where("size(now) > 0"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keys, owns, hs, short = [], [], [], []
            for h, line, was, now in _rows(b):
                old, new = frozenset(was), frozenset(now)
                before = Keys(edits, old).of(line)
                for key, own in Keys(edits, old | new).of(line).items():
                    if key in new or key not in before:
                        keys.append(key)
                        owns.append(own)
                        hs.append(h)
                        short.append(key in new)
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array(owns, pa.bool_()), pa.array(hs, pa.int64()),
                                              pa.array(short, pa.bool_())], ["key", "own", "h", "short"])

    lines = _told(docs, of_line.select("w")).join(of_line, F.col("h") == F.col("w"))
    return lines.select("h", "line", "was", "now").mapInArrow(run, "key long, own boolean, h long, short boolean")


def _meetings(keyed: DataFrame, hot: int) -> DataFrame:
    """(key, own, h, hot): the lines of keys that two lines share, at least one of them by its own segment.

    `hot` marks all lines of keys of more than `hot` lines; they pass through in pieces.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest, flowing = [np.zeros(0, np.int64), np.zeros(0, bool), np.zeros(0, np.int64)], None

        def met(key: np.ndarray, own: np.ndarray, h: np.ndarray) -> pa.RecordBatch:
            starts = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.zeros(0, int)
            sizes = np.diff(np.append(starts, len(key)))
            # Own segments come first. A line that owns a segment and probes with it at another place is once in a key.
            passing = key[starts] == flowing if flowing is not None else np.zeros(len(starts), bool)
            over = passing | ((sizes > hot) & own[starts])
            kept = np.repeat(over | ((sizes > 1) & own[starts]), sizes)
            return pa.RecordBatch.from_arrays(
                [pa.array(key[kept]), pa.array(own[kept]), pa.array(h[kept]), pa.array(np.repeat(over, sizes)[kept])],
                ["key", "own", "h", "hot"])

        for b in batches:
            key, own, h = (np.concatenate([r, c.to_numpy(zero_copy_only=False)]) for r, c in zip(rest, b.columns, strict=True))
            if not len(key):
                continue
            # The same line from several tasks stands in a row.
            new = np.concatenate([[True], (key[1:] != key[:-1]) | (h[1:] != h[:-1]) | (own[1:] != own[:-1])])
            key, own, h = key[new], own[new], h[new]
            last = int(np.searchsorted(key, key[-1]))
            if key[-1] == flowing or len(key) - last > hot + 1:
                # All but the last row go on; that one is there to be compared with the next.
                hold = len(key) - 1
                yield met(key[:hold], own[:hold], h[:hold])
                if own[last]:
                    flowing = key[-1]
            else:
                hold = last
                yield met(key[:hold], own[:hold], h[:hold])
            rest = [c[hold:] for c in (key, own, h)]
        yield met(*rest)

    dealt = keyed.repartition("key").sortWithinPartitions("key", F.desc("own"), "h")
    return dealt.mapInArrow(run, "key long, own boolean, h long, hot boolean")


def _blocks(keyed: DataFrame) -> DataFrame:
    """(key, own, h, i, j, block): lines of keys of any size, each in all pairs (i, j) of blocks with its own block.

    A pair of blocks is one group to compare, of about 2 x HOT lines however many the key has.
    """
    lines = stored(keyed.distinct())
    sizes = lines.groupBy("key").agg(F.ceil(F.count("*") / HOT).cast("int").alias("blocks"))
    placed = lines.join(sizes, "key").withColumn("block", F.pmod(F.xxhash64("h"), F.col("blocks")).cast("int"))
    met = placed.select("key", "own", "h", "block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"))
    return met.select("key", "own", "h", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "block")


def candidates(docs: DataFrame, edits: int = EDITS) -> DataFrame:
    """The lines of keys in which lines meet, as (key, own, h, i, j, block).

    Lines within `edits` of each other meet in at least one key and pair of blocks. Rows are lines in keys, not pairs.
    Rounds go on until each key is within HOT or too short to be refined; the sides of a segment shrink in each.
    """
    one = [F.lit(0).alias(c) for c in ("i", "j", "block")]
    met = stored(_meetings(_keyed(docs, edits), HOT))
    parts, short, hot = [met], [], None
    for turn in count():
        more = met.where("hot").select("key", "h", F.lit(turn).alias("round"))
        if more.isEmpty():
            break
        hot = more if hot is None else hot.union(more)
        found = stored(_refined(docs, hot, edits))
        short.append(found.where("short").select("key", "own", "h"))
        met = stored(_meetings(found.where("not short").select("key", "own", "h"), HOT))
        parts.append(met)
    members = reduce(DataFrame.union, [part.where("not hot").select("key", "own", "h", *one) for part in parts])
    return members.union(_blocks(reduce(DataFrame.union, short))) if short else members


def links(docs: DataFrame, firsts: DataFrame, edits: int = EDITS) -> DataFrame:
    """(h, g, links, near): lines with others within `edits`: how many, and whether one of them begins earlier.

    `firsts` has for each line its first place (h, g, first). The lines of a key, or of two blocks of a large key, are
    compared in one task; what leaves it is a row for each line, however many of them are near. A pair that meets in
    several keys counts in the least of them: each line comes with the keys in which it meets others.
    """
    members = candidates(docs, edits)
    held = stored(members.groupBy("h").agg(F.collect_set(F.struct("key", "own")).alias("keys")))
    told = _told(docs, held.select(F.col("h").alias("w"))).join(firsts.select("h", "g", "first"), ["h", "g"])
    told = stored(told.join(held, "h"))

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, group = None, []
        pairs: list[tuple[int, tuple, tuple]] = []
        for b in batches:
            for key, i, j, block, own, h, g, line, first, keys in _rows(b):
                if (key, i, j) != last:
                    for pair in _within_length(group, edits):
                        pairs.append((last[0], *pair))
                        if len(pairs) == BATCH:
                            yield _settled(pairs, edits)
                            pairs = []
                    last, group = (key, i, j), []
                known = first["doc_id"] is not None
                place = (known, first["doc_id"] if known else 0, first["k"], first["l"], first["pos"])
                group.append((own, (h, g), line, place, block if i != j else None, keys))
        for pair in _within_length(group, edits):
            pairs.append((last[0], *pair))
            if len(pairs) == BATCH:
                yield _settled(pairs, edits)
                pairs = []
        yield _settled(pairs, edits)

    both = members.join(told, "h").select("key", "i", "j", "block", "own", "h", "g", "line", "first", "keys")
    dealt = both.repartition("key", "i", "j").sortWithinPartitions("key", "i", "j")
    return dealt.mapInArrow(compare, "h long, g long, links long, near boolean").groupBy("h", "g").agg(
        F.sum("links").alias("links"), F.max("near").alias("near"))


def _within_length(group: list[tuple], edits: int) -> Iterator[tuple[tuple, tuple]]:
    """Pairs of a group's lines (own, name, line, first, block, keys) whose lengths allow `edits`, one by its own segment.

    In a group of two blocks only lines of different blocks are paired; in a group of one, block is None.
    """
    group = sorted(group, key=lambda g: (len(g[2]), g[1]))
    for i, b in enumerate(group):
        for a in reversed(group[:i]):
            if len(b[2]) - len(a[2]) > edits:
                break
            if (a[0] or b[0]) and (a[4] is None or a[4] != b[4]):
                yield a, b


def _settled(pairs: list[tuple[int, tuple, tuple]], edits: int) -> pa.RecordBatch:
    """(h, g, links, near) of the lines in near pairs (key, a, b) that have no smaller key in common."""
    found: dict[tuple[int, int], tuple[int, bool]] = {}
    keys: dict[tuple[int, int], dict[int, bool]] = {}
    for (key, a, b), near in zip(pairs, within([(a[2], b[2]) for _, a, b in pairs], edits), strict=True):
        if near:
            for x in (a, b):
                if x[1] not in keys:
                    keys[x[1]] = {k["key"]: k["own"] for k in x[5]}
            ka, kb = keys[a[1]], keys[b[1]]
            if min(k for k in ka if k in kb and (ka[k] or kb[k])) == key:
                for x, y in ((a, b), (b, a)):
                    n, earlier = found.get(x[1], (0, False))
                    found[x[1]] = (n + 1, earlier or y[3] < x[3])
    return pa.RecordBatch.from_pydict({
        **{c: pa.array([name[k] for name in found], pa.int64()) for k, c in enumerate("hg")},
        "links": pa.array([n for n, _ in found.values()], pa.int64()), "near": pa.array([x for _, x in found.values()], pa.bool_())})


#: Columns that `thin` adds: lines with a word, dropped copies, dropped near lines, links of the document's lines.
ADDED = ("_llm_n_lines", "_llm_n_copies", "_llm_n_near", "_llm_n_links")


def listed(marked: DataFrame) -> DataFrame:
    """(_llm_m, _llm_n, _llm_marks): the marks of each (k, l), each once however many rows repeat the document."""
    return marked.groupBy(F.col("k").alias("_llm_m"), F.col("l").alias("_llm_n")).agg(
        F.collect_set(F.struct("pos", "copy", "near", "links")).alias("_llm_marks"))


def thin(docs: DataFrame, edits: int = EDITS) -> DataFrame:
    """The documents without repeated lines, and with the columns ADDED.

    A line (blanks at its ends apart) goes if it equals an earlier line of any document, or if a different line within
    `edits` edits begins earlier; earlier is by doc_id (null first), then place. Lines under MIN_CHARS are compared for
    equality only, and lines without a word stay. Every document stays, maybe with an empty text; null texts stay null.
    Rows of equal doc_id and text are one document and keep the same lines. Links are those between different lines; a
    document's number is the sum over its lines. An empty table gives no rows.
    """
    importable(docs)
    # Two hashes name a document: one of 64 bits would meet another's by chance among some billions.
    key, other = F.xxhash64("doc_id", "text"), F.xxhash64("text", "doc_id")
    keyed = docs.select(key.alias("k"), other.alias("l"), "text", "doc_id")
    placed = stored(_placed(keyed))
    firsts = stored(placed.groupBy("h", "g").agg(F.min(F.struct("doc_id", "k", "l", "pos")).alias("first"), F.count("*").alias("n")))
    linked = links(keyed, firsts, edits)
    notable = firsts.join(linked, ["h", "g"], "left").where("n > 1 or links is not null").select("h", "g", "first", "links", "near")
    begins = (F.col("k") == F.col("first.k")) & (F.col("l") == F.col("first.l")) & (F.col("pos") == F.col("first.pos"))
    marked = placed.join(notable, ["h", "g"]).select(
        "k", "l", "pos", (~begins).alias("copy"),
        F.coalesce("near", F.lit(False)).alias("near"), F.coalesce("links", F.lit(0)).alias("links"))
    marks, names = listed(marked), docs.columns
    joined = docs.join(marks, (key == marks["_llm_m"]) & (other == marks["_llm_n"]), "left").select(
        *[docs[f"`{c}`"] for c in names], marks["_llm_marks"])
    text, kinds = docs.columns.index("text"), joined.schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts, added = [], []
            for whole, marks in zip(b.column(text).to_pylist(), b.column(b.num_columns - 1).to_pylist(), strict=True):
                marks = marks or []
                gone = {m["pos"] for m in marks if m["copy"] or m["near"]}
                added.append((len(lines_of(whole or "")), sum(m["copy"] for m in marks),
                              sum(m["near"] and not m["copy"] for m in marks), sum(m["links"] for m in marks)))
                if gone:
                    whole = "\n".join(line for i, line in enumerate(whole.split("\n")) if i not in gone)
                texts.append(whole)
            columns = list(b.columns[:-1])
            columns[text] = pa.array(texts, columns[text].type)
            counts = [pa.array(list(c), pa.int64()) for c in zip(*added, strict=True)] or [pa.array([], pa.int64())] * 4
            yield pa.RecordBatch.from_arrays([*columns, *counts], [*b.schema.names[:-1], *ADDED])

    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in kinds.fields[:-1]), *(f"{c} long" for c in ADDED)])
    return joined.mapInArrow(run, schema)


def documents(docs: DataFrame, edits: int = EDITS) -> DataFrame:
    """`thin` with the columns of `docs` alone; n_chars, if it is there, counts the text that is left."""
    thinned = thin(docs, edits).drop(*ADDED)
    return thinned.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else thinned
