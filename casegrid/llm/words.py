"""A bounded table from words to rows of numbers, kept by a Python worker from one task to the next."""

from __future__ import annotations

from collections.abc import Callable
from itertools import repeat

import numpy as np

from .common import kept


class WordTable:
    """rows[i] belongs to the word that ``find`` gave i; ``compute`` gives the rows of new words. Row 0 is zero. A table
    of more than ``most`` words, or of words of MOST_CHARS characters in all, is emptied before the next batch."""

    MOST_CHARS = 20_000_000

    def __init__(self, compute: Callable[[list[str]], np.ndarray], width: int, most: int):
        self.compute, self.width, self.most = compute, width, most
        self.known: dict[str, int] = {}
        self.rows = np.zeros((1, width), np.float32)
        self.used, self.chars = 1, 0

    def start(self) -> None:
        """Called between batches: the only time at which rows may go."""
        if len(self.known) > self.most or self.chars > self.MOST_CHARS:
            self.known, self.rows, self.used, self.chars = {}, np.zeros((1, self.width), np.float32), 1, 0

    def find(self, words: list[str]) -> np.ndarray:
        ids = np.fromiter(map(self.known.get, words, repeat(-1)), np.int32, len(words))
        missing = np.flatnonzero(ids < 0)
        if len(missing):
            new = list(dict.fromkeys(words[i] for i in missing.tolist()))
            for k in range(0, len(new), 20_000):
                part = new[k : k + 20_000]
                if self.used + len(part) > len(self.rows):
                    self.rows = np.concatenate([self.rows, np.zeros((max(len(part), len(self.rows) // 2), self.width), np.float32)])
                self.rows[self.used : self.used + len(part)] = self.compute(part)
                self.known.update(zip(part, range(self.used, self.used + len(part)), strict=True))
                self.used += len(part)
                self.chars += sum(map(len, part))
            ids[missing] = np.fromiter((self.known[words[i]] for i in missing.tolist()), np.int32, len(missing))
        return ids


def kept_table(name: str, compute: Callable[[list[str]], np.ndarray], width: int, most: int = 150_000) -> WordTable:
    """The worker's table of that name (a digest of the model is part of it)."""
    return kept(name, lambda: WordTable(compute, width, most))
