"""Word and shingle hashes of many texts at once, in NumPy."""

from __future__ import annotations

import sys
import types
from dataclasses import dataclass

import numpy as np

U = np.uint64
_BASE, _STEP = U(0x9E3779B97F4A7C15), U(0xD1342543DE82EF95)
CHARS = 1 << 19


def worker_state() -> dict:
    """Tables that live as long as the Python worker, however often task code is unpickled."""
    module = sys.modules.setdefault("_text_worker_state", types.ModuleType("_text_worker_state"))
    return module.__dict__


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values (splitmix finaliser)."""
    x = x ^ (x >> U(30))
    x = x * U(0xBF58476D1CE4E5B9)
    x = x ^ (x >> U(27))
    x = x * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


def powers(base: np.uint64, n: int, label: str) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64."""
    state = worker_state()
    have = state.get(label)
    if have is None or len(have) < n:
        steps = np.full(max(n, CHARS + CHARS // 4), base, U)
        steps[0] = 1
        state[label] = have = np.multiply.accumulate(steps)
    return have[:n]


def _tables() -> tuple[np.ndarray, np.ndarray]:
    state = worker_state()
    if "alnum" not in state:
        state["alnum"] = np.fromiter((chr(i).isalnum() for i in range(0x110000)), bool, 0x110000)
        state["code"] = mix((np.arange(0x110000, dtype=U) + U(1)) * _BASE)
    return state["alnum"], state["code"]


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


@dataclass
class Words:
    """Words of several texts: hash, owner, and place in the joined text."""

    hashes: np.ndarray
    doc: np.ndarray
    first: np.ndarray  # per text: index of its first word, and the total at the end
    start: np.ndarray
    end: np.ndarray
    line_end: np.ndarray  # places of the line feeds, one after every text included


def words(texts: list[str]) -> Words:
    """Runs of letters and digits in lower case, with a 64-bit hash each.

    A hash is a polynomial in the word's characters, read off running sums,
    so no word is built as a string.
    """
    lowered = [t.lower() for t in texts]
    points = code_points("\n".join(lowered) + "\n")
    alnum, code = _tables()
    inside = alnum[points]
    change = np.flatnonzero(inside[1:] != inside[:-1]) + 1
    if len(inside) and inside[0]:
        change = np.concatenate(([0], change))
    start, end = change[0::2], change[1::2]
    total = np.empty(len(points) + 1, U)
    total[0] = 0
    np.cumsum(code[points] * powers(_BASE, len(points), "base"), out=total[1:])
    inverse = powers(U(pow(int(_BASE), -1, 1 << 64)), len(points), "inverse")
    hashes = mix((total[end] - total[start]) * inverse[start] + (end - start).astype(U))
    limits = np.concatenate(([0], np.cumsum(np.fromiter((len(t) + 1 for t in lowered), np.int64, len(lowered)))))
    first = np.searchsorted(start, limits)
    doc = np.repeat(np.arange(len(texts)), np.diff(first))
    return Words(hashes, doc, first, start, end, np.flatnonzero(points == 10))


def shingles(w: Words, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(text index, hash) of every run of ``width`` words; a shorter text is one run of all its words."""
    n = len(w.hashes)
    lengths = np.diff(w.first)
    run = np.zeros(n, U)
    padded = np.concatenate((w.hashes, np.zeros(width, U)))
    left = np.repeat(w.first[1:], lengths) - np.arange(n)  # words from here to the end of the text
    for j in range(width):
        run = run * _STEP + np.where(left > j, padded[j:j + n], U(0))
    at = np.arange(n) - np.repeat(w.first[:-1], lengths)
    keep = (left >= width) | (at == 0)
    return w.doc[keep], mix(run[keep])


def counted(doc: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (text, hash) with their counts, ordered by text and hash."""
    order = np.lexsort((hashes, doc))
    doc, hashes = doc[order], hashes[order]
    new = np.ones(len(doc), bool)
    new[1:] = (doc[1:] != doc[:-1]) | (hashes[1:] != hashes[:-1])
    at = np.flatnonzero(new)
    return doc[at], hashes[at], np.diff(np.concatenate((at, [len(doc)])))
