"""Words of many texts as numbers. A word is a run of bytes other than 0x20 and 0x09-0x0D,
which is what ``bytes.split`` cuts at; UTF-8 never uses those bytes inside a character."""

from __future__ import annotations

import numpy as np

from chainlake.llm.chunks import Codes, no_cycles


def coded(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, Codes]:
    """The words of all texts one after another as codes (equal words, equal codes), where
    each text begins and ends, and the code of each word."""
    codes = Codes()
    look = codes.__getitem__
    found = []
    with no_cycles():
        for text in texts:
            words = text.split()
            found.append(np.fromiter(map(look, words), np.int32, len(words)))
    bounds = np.concatenate([[0], np.cumsum([len(f) for f in found])]).astype(np.int64)
    return (np.concatenate(found) if found else np.zeros(0, np.int32)), bounds, codes


def document_of(bounds: np.ndarray) -> np.ndarray:
    return np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))


def dense(values: np.ndarray) -> np.ndarray:
    """Equal numbers for equal values, counted from 0 without gaps."""
    order = np.argsort(values, kind="stable")
    ranked = values[order]
    step = np.concatenate([[0], (ranked[1:] != ranked[:-1]).astype(np.int64)]) if len(values) else ranked
    out = np.empty(len(values), dtype=np.int64)
    out[order] = np.cumsum(step)
    return out


def joined(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Equal numbers for equal pairs."""
    return dense(left.astype(np.int64) * (int(right.max(initial=0)) + 1) + right)
