"""Best-fit packing of token sequences by exact-complement hashing."""

from __future__ import annotations

import base64
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import gapless, importable, stored

#: Tokens of a sequence.
ROOM = 2048
#: Pieces whose token bytes a worker remembers; rarer ones are encoded each time.
REMEMBERED = 300_000
#: Rank buckets of a length: one task ranks about 1/256 of the pieces of one length.
LENGTH_BUCKETS = 256


class Encoder(dict):
    """Token ids of texts as little-endian unsigned 32-bit bytes, with the ids of words remembered.

    Byte-level pieces never reach over a space except that one space leads the following word, so that a text whose
    white space is single spaces and line breaks is the ids of its words one after the other. Other texts are encoded
    whole. `vocabulary` is a rank file, `tokenizer` the file of the same vocabulary for texts with a special token.
    """

    def __init__(self, vocabulary: str, pattern: str, tokenizer: str, special: str = "<|endoftext|>"):
        import tiktoken

        with open(vocabulary, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.plain = tiktoken.Encoding("plain", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.tokenizer, self.special, self.full = tokenizer, special, None

    def __missing__(self, piece: str) -> bytes:
        found = np.array(self.plain.encode_ordinary(piece), "<u4").tobytes()
        if len(self) < REMEMBERED:
            self[piece] = found
        return found

    def with_specials(self, text: str) -> bytes:
        if self.full is None:
            from tokenizers import Tokenizer

            self.full = Tokenizer.from_file(self.tokenizer)
        return np.array(self.full.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def encode(self, text: str) -> bytes:
        if self.special in text:
            return self.with_specials(text)
        lines = [line.split(" ") for line in text.split("\n")]
        if [w for words in lines for w in words] != text.split():
            return np.array(self.plain.encode_ordinary(text), "<u4").tobytes()
        look = self.__getitem__
        return look("\n").join(
            b"".join([look(words[0]), *map(look, map(" ".__add__, words[1:]))]) for words in lines
        )


def encoder() -> Encoder:
    """The encoder of the public 50k byte-level vocabulary installed on every machine."""
    import public_tokenizers

    at = public_tokenizers.path
    return Encoder(at("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN, at("byte_bpe_50k.json"))


def pieces(docs: DataFrame, room: int = ROOM, make=encoder) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32): each document's ids and a closing 0, cut only if over `room`.

    The first piece of a cut document takes the remainder, so that all others fill a sequence. Ids are made and
    dropped text by text.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = make()
        for b in batches:
            at, piece, start, length, crc = [], [], [], [], []
            for row, text in enumerate(b.column(1).to_pylist()):
                data = coder.encode(text or "") + bytes(4)
                n = len(data) // 4
                first = n % room or room
                cuts = [0, *range(first, n + 1, room)]
                for i, (a, z) in enumerate(zip(cuts, cuts[1:], strict=False)):
                    at.append(row)
                    piece.append(i)
                    start.append(a)
                    length.append(z - a)
                    crc.append(zlib.crc32(data[4 * a : 4 * z]))
            yield pa.RecordBatch.from_arrays([
                b.column(0).take(pa.array(at, pa.int64())), pa.array(piece, pa.int32()), pa.array(start, pa.int64()),
                pa.array(length, pa.int64()), pa.array(crc, pa.int64()),
            ], ["doc_id", "piece", "start", "length", "ids_crc32"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, piece int, start long, length long, ids_crc32 long"
    return docs.select("doc_id", "text").mapInArrow(run, schema)


class Stock:
    """Counts of lengths, with the single, pair and triple sums that exactly fill a gap found through them."""

    def __init__(self, counts: np.ndarray):
        self.n = counts

    def single(self, gap: int) -> tuple[int, ...] | None:
        return (gap,) if self.n[gap] else None

    def pair(self, gap: int, most: int | None = None) -> tuple[int, ...] | None:
        """Two lengths of sum `gap`, the larger as large as may be (`most`)."""
        top = min(gap - 1, gap if most is None else most)
        low = (gap + 1) // 2
        if top < low:
            return None
        larger = self.n[low : top + 1]
        smaller = self.n[gap - top : gap - low + 1][::-1]
        fits = (larger > 0) & (smaller > 0)
        if gap % 2 == 0 and low <= top:
            fits[0] = self.n[low] > 1
        at = np.flatnonzero(fits)
        return (low + int(at[-1]), gap - low - int(at[-1])) if len(at) else None

    def triple(self, gap: int) -> tuple[int, ...] | None:
        for a in np.flatnonzero(self.n[: max(0, gap - 1)])[::-1].tolist():
            if 3 * a < gap:
                break
            self.n[a] -= 1
            rest = self.pair(gap - a, a)
            self.n[a] += 1
            if rest:
                return (a, *rest)
        return None

    def exact(self, gap: int) -> tuple[int, ...] | None:
        return self.single(gap) or self.pair(gap) or self.triple(gap)


def recipe(counts: dict[int, int], room: int = ROOM) -> list[tuple[tuple[int, ...], int]]:
    """Patterns of lengths and how often each is made, together using up all counts.

    Lengths go from the largest down. A gap is closed by one, two or three lengths that fill it exactly; if there are
    none, the longest that fits goes in (best fit) and the gap left over is tried again. A pattern is made as often as
    the counts allow, so that each step uses up a length, and the work depends on `room`, not on the number of pieces.
    """
    stock = Stock(np.zeros(room + 1, np.int64))
    for length, n in counts.items():
        stock.n[length] = n
    made: list[tuple[tuple[int, ...], int]] = []
    for length in range(room, 0, -1):
        while stock.n[length]:
            pattern, gap = [length], room - length
            stock.n[length] -= 1
            while gap:
                fill = stock.exact(gap)
                if fill is None:
                    fits = np.flatnonzero(stock.n[: gap + 1])
                    if not len(fits):
                        break
                    fill = (int(fits[-1]),)
                for x in fill:
                    stock.n[x] -= 1
                pattern += fill
                gap -= sum(fill)
            each = Counter(pattern)
            for x, k in each.items():
                stock.n[x] += k
            times = min(int(stock.n[x]) // k for x, k in each.items())
            for x, k in each.items():
                stock.n[x] -= k * times
            made.append((tuple(pattern), times))
    return made


def places(made: list[tuple[tuple[int, ...], int]]) -> dict[str, np.ndarray]:
    """The recipe as ranges of ranks: pieces of `length` from `rank` on go to sequence + (rank - own), at `offset`."""
    used: Counter[int] = Counter()
    rows, sequence = [], 0
    for pattern, times in made:
        offset = 0
        for x in pattern:
            rows.append((x, used[x], sequence, offset))
            used[x] += times
            offset += x
        sequence += times
    rows.sort()
    table = np.array(rows, np.int64).reshape(-1, 4)
    return dict(zip(("length", "rank", "sequence", "offset"), table.T, strict=True))


def pack(docs: DataFrame, room: int = ROOM, make=encoder) -> DataFrame:
    """Pack all documents into sequences of at most `room` tokens.

    Returns doc_id, piece, start, length, ids_crc32, sequence_id and offset, one row per piece. A null or empty text is
    the closing 0 alone. A null doc_id and repeated rows are packed like others. An empty table gives no rows.

    Only the counts of lengths (at most `room` numbers) reach the driver, which turns them into a recipe; each piece
    finds its sequence from its rank among the pieces of its length, ranked in buckets.
    """
    importable(docs)
    cut = stored(pieces(docs, room, make))
    counts = {r["length"]: r["n"] for r in cut.groupBy("length").agg(F.count("*").alias("n")).collect()}
    place = places(recipe(counts, room))
    top = int(place["rank"].max(initial=0)) + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys = place["length"] * top + place["rank"]
        for b in batches:
            length, rank = b.column("length").to_numpy(), b.column("rank").to_numpy()
            # Within a length the last range that begins at or before the rank; ranks end under the next length's keys.
            at = np.searchsorted(keys, length * top + np.minimum(rank, top - 1), side="right") - 1
            sequence = place["sequence"][at] + rank - place["rank"][at]
            columns = [b.column(c) for c in ("doc_id", "piece", "start", "length", "ids_crc32")]
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(sequence), pa.array(place["offset"][at])],
                ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"],
            )

    ranked = gapless(cut, ["length"], ["doc_id", "piece", "ids_crc32"], "rank", LENGTH_BUCKETS)
    kind = cut.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"
    return ranked.select("doc_id", "piece", "start", "length", "ids_crc32", "rank").mapInArrow(run, schema)
