"""Cutting texts where a byte-level BPE pattern can never match across.

The split pattern of the vocabularies used here attaches one space to the run that follows
it. A single space between two characters that are no white space always begins a new
match, so a text may be cut in front of it and each chunk be looked up by itself. Texts
repeat most of their chunks; only new ones need work.
"""

from __future__ import annotations

import gc
from collections.abc import Callable
from contextlib import contextmanager

import numpy as np

# A memo starts anew beyond so many characters of chunks.
MOST_CHARS = 8_000_000


@contextmanager
def no_cycles():
    """Many small objects without cycles are made inside; looking for cycles is wasted."""
    gc.disable()
    try:
        yield
    finally:
        gc.enable()


def ranges(starts: np.ndarray, lens: np.ndarray) -> np.ndarray:
    """``starts[0], starts[0] + 1, ...`` for ``lens[0]`` numbers, and so on for each start."""
    ends = np.cumsum(lens)
    total = int(ends[-1]) if len(ends) else 0
    return np.arange(total) + np.repeat(starts - (ends - lens), lens)


class Codes(dict):
    """Numbers strings in the order in which they are first looked up."""

    def __missing__(self, key: str) -> int:
        code = self[key] = len(self)
        return code


class Memo:
    """The ids of each chunk. ``learn`` gives the ids of a list of strings, one after
    another, and how many each has."""

    def __init__(self, learn: Callable[[list[str]], tuple[np.ndarray, np.ndarray]]):
        self.learn = learn
        self.forget()

    def forget(self) -> None:
        # Chunks that follow a space, without it; then chunks and texts that follow none.
        self.codes, self.size = Codes(), 0
        self.odd: set[int] = set()
        self.flat, self.lens = np.zeros(0, np.int32), np.zeros(0, np.int64)

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts one after another, and where each text begins and ends."""
        if self.size > MOST_CHARS:
            self.forget()
        firsts: list[str] = []
        cuts: list[np.ndarray] = []
        look = self.codes.__getitem__
        known = len(self.codes)
        with no_cycles():
            for text in texts:
                first, *rest = text.split(" ")
                firsts.append(first)
                cuts.append(np.fromiter(map(look, rest), np.int32, len(rest)))
            self.take_in(list(self.codes)[known:])
            odd = np.array(sorted(self.odd), dtype=np.int32)
            for i, (text, first, rest) in enumerate(zip(texts, firsts, cuts)):
                if len(rest) and (first[-1:].isspace() or len(odd) and np.isin(rest, odd).any()):
                    firsts[i], cuts[i] = text, rest[:0]
            apart, lens = self.learn(firsts)
        begin = np.cumsum(lens) - lens
        # One row of pieces per text: what begins it, then its other chunks.
        flat = np.concatenate([self.flat, apart])
        begins = np.concatenate([np.cumsum(self.lens) - self.lens, begin + len(self.flat)])
        lengths = np.concatenate([self.lens, lens])
        n = np.array([len(rest) for rest in cuts], dtype=np.int64) + 1
        at = np.cumsum(n) - n
        pieces = np.empty(int(n.sum()), dtype=np.int64)
        pieces[at] = len(self.lens) + np.arange(len(texts))
        inner = np.ones(len(pieces), dtype=bool)
        inner[at] = False
        pieces[inner] = np.concatenate(cuts) if cuts else []
        ids = flat[ranges(begins[pieces], lengths[pieces])]
        bounds = np.concatenate([[0], np.cumsum(lengths[pieces])])[np.concatenate([at, [len(pieces)]])]
        return ids, bounds

    def take_in(self, new: list[str]) -> None:
        """Learn chunks that follow a space; those that can't be cut off are marked odd."""
        known = len(self.lens)
        self.odd.update(known + i for i, c in enumerate(new) if not c or c[0].isspace() or c[-1].isspace())
        ids, lens = self.learn([" " + chunk for chunk in new])
        self.flat, self.lens = np.concatenate([self.flat, ids]), np.concatenate([self.lens, lens])
        self.size += sum(map(len, new))
