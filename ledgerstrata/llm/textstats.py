"""Counts over whole texts, by numpy over the words of one text at a time."""

from __future__ import annotations

import numpy as np
import xxhash

#: Fixed by the rules: words of a window, characters that count as symbols, ASCII white space.
WINDOW, SYMBOLS, BLANKS = 8, "#*$%&|<>", " \t\n\x0b\x0c\r"
#: Words whose hashes a worker remembers; rarer ones are hashed each time.
REMEMBERED = 100_000
_ODD = np.uint64(0x9E3779B97F4A7C15)
_MIX = np.uint64(0xBF58476D1CE4E5B9)


def mixed(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit numbers over all bits."""
    x = (x ^ (x >> np.uint64(30))) * _MIX
    return x ^ (x >> np.uint64(29))


class _Hashes(dict):
    """64-bit hashes of words, remembered up to a fixed number of words."""

    def __missing__(self, word: bytes) -> int:
        found = xxhash.xxh3_64_intdigest(word)
        if len(self) < REMEMBERED:
            self[word] = found
        return found


_HASHES = _Hashes()


class Words:
    """The words of a text and their hashes, which stand for the words."""

    def __init__(self, data: bytes):
        self.words = data.split()
        self.hashes = np.fromiter(map(_HASHES.__getitem__, self.words), np.uint64, len(self.words))

    def __len__(self) -> int:
        return len(self.words)

    def repeated(self, window: int = WINDOW) -> int:
        """Words in windows of `window` words that the text holds twice or more, the first included."""
        n = len(self.words) - window + 1
        if n < 2:
            return 0
        rolled = np.zeros(n, np.uint64)
        for k in range(window):
            rolled *= _ODD
            rolled += self.hashes[k : k + n]
        ordered = np.sort(rolled)
        if not (ordered[1:] == ordered[:-1]).any():
            return 0
        order = np.argsort(rolled)
        views = np.lib.stride_tricks.sliding_window_view(self.hashes, window)
        at = np.flatnonzero(ordered[1:] == ordered[:-1])
        if not (views[order[at]] == views[order[at + 1]]).all():  # sums met by chance: sort by the words' hashes
            order = np.lexsort(views.T)
            at = np.flatnonzero((views[order][1:] == views[order][:-1]).all(axis=1))
        steps = np.zeros(len(self.words) + 1, np.int64)
        starts = np.unique(np.concatenate([order[at], order[at + 1]]))
        steps[starts] += 1
        np.subtract.at(steps, starts + window, 1)
        return int((np.cumsum(steps[:-1]) > 0).sum())


def count_of(text: str, characters: str) -> int:
    return sum(map(text.count, characters))


def word_chars(text: str) -> int:
    return len(text) - count_of(text, BLANKS)


def duplicate_lines(text: str) -> int:
    """Lines with a word that equal an earlier line."""
    lines = [line for line in text.split("\n") if line.strip(BLANKS)]
    return len(lines) - len(set(lines))
