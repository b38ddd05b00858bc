from __future__ import annotations

import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from ledgerstrata.llm import packing

from . import edge


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def ids(tokenizer, text):
    return [*tokenizer.encode(text or "", add_special_tokens=False).ids, 0]


def test_encoder_equals_the_tokenizer(tokenizer):
    coder = packing.encoder()
    odd = ["a  b", " lead", "trail ", "a\n\nb", "\tx y", "it's  we'll", "a b", "x　y z", "é ü ß", "12 3,4", "a \n b", "\x1c a b"]
    for text in [*(t or "" for t in edge.texts()), *odd]:
        assert np.frombuffer(coder.encode(text), "<u4").tolist() == ids(tokenizer, text)[:-1], text


def test_rows(spark, tokenizer):
    docs = edge.docs(spark)
    found = edge.rows(packing.pack(docs))
    expected = Counter()
    for r in edge.rows(docs):
        whole = ids(tokenizer, r["text"])
        first = len(whole) % 2048 or 2048
        cuts = [0, *range(first, len(whole) + 1, 2048)]
        for i, (a, z) in enumerate(zip(cuts, cuts[1:], strict=False)):
            expected[(r["doc_id"], i, a, z - a, zlib.crc32(np.array(whole[a:z], "<u4").tobytes()))] += 1
    assert Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in found) == expected
    sequences = {}
    for r in found:
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for places in sequences.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 2048
    assert len(sequences) <= -(-sum(r["length"] for r in found) // 2048) + 1


def test_empty(spark):
    assert packing.pack(edge.empty(spark)).collect() == []


def test_recipe_uses_up_all_counts():
    rng = np.random.default_rng(2)
    for room, spread in ((64, 64), (2048, 700), (2048, 2048)):
        lengths = Counter((1 + (rng.random(4000) ** 2 * spread).astype(int)).clip(1, room).tolist())
        made = packing.recipe(dict(lengths), room)
        used = Counter()
        for pattern, times in made:
            assert times > 0 and sum(pattern) <= room
            for x in pattern:
                used[x] += times
        assert used == lengths
        sequences, total = sum(t for _, t in made), sum(x * n for x, n in lengths.items())
        assert sequences <= 1.05 * total / room + 1


def test_exact_complements():
    stock = packing.Stock(np.bincount([3, 4, 4, 6, 10], minlength=21))
    assert stock.exact(10) == (10,) and stock.exact(8) == (4, 4) and stock.exact(13) == (10, 3)
    assert sorted(stock.exact(11)) == [3, 4, 4] and stock.exact(12) is None and stock.exact(2) is None
    assert packing.Stock(np.bincount([4, 9], minlength=21)).exact(8) is None
