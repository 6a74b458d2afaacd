"""Words and word shingles of many texts at once, as 64-bit hashes in numpy arrays.

A word is a run of letters and digits, lower-cased. Code points beyond the basic plane count as
letters. Texts are worked on in pieces of bounded size, cut between words.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

SHINGLE = 5
SIMILARITY = 0.8
PIECE = 1 << 16  # code points worked on at once

U = np.uint64
_PRIME = U(0x9E3779B97F4A7C15)
_INVERSE = U(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_NON_WORD = re.compile(r"\W")
_tables: dict = {}


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values (the finishing steps of splitmix64)."""
    x = x ^ (x >> U(30))
    x = x * U(0xBF58476D1CE4E5B9)
    x = x ^ (x >> U(27))
    x = x * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def _plane() -> tuple[np.ndarray, np.ndarray]:
    """For each code point of the basic plane: its lower-case form, and whether it is in words."""
    if "plane" not in _tables:
        chars = [chr(c) for c in range(0x10000)]
        lower = np.array([ord(c.lower()[0]) for c in chars], np.uint64)
        _tables["plane"] = lower, np.array([c.isalnum() for c in chars])
    return _tables["plane"]


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_tables.get("powers", ((),))[0]) < n:
        size = 1 << max(20, n.bit_length())
        both = [np.full(size, base) for base in (_PRIME, _INVERSE)]
        for one in both:
            one[0] = 1
            np.multiply.accumulate(one, out=one)
        _tables["powers"] = tuple(both)
    return _tables["powers"]


def _cut(text: str) -> Iterator[tuple[int, str]]:
    """(offset, piece) of a text; pieces end before a character that is in no word."""
    at = 0
    while len(text) - at > PIECE:
        found = _NON_WORD.search(text, at + PIECE)
        end = found.start() if found else len(text)
        yield at, text[at:end]
        at = end
    yield at, text[at:]


def grouped(texts: list[str], limit: int = PIECE) -> Iterator[tuple[int, int]]:
    """Ranges of neighbouring texts of about ``limit`` code points together, one text at least."""
    first = total = 0
    for i, text in enumerate(texts):
        if i > first and total + len(text) > limit:
            yield first, i
            first, total = i, 0
        total += len(text)
    if first < len(texts):
        yield first, len(texts)


def _piece_words(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    codes = code_points("\0".join(texts))
    low = np.minimum(codes, 0xFFFF)
    lower, alnum = _plane()
    chars, inside = lower[low], alnum[low]
    if (beyond := codes > 0xFFFF).any():
        chars[beyond] = codes[beyond]
        inside = inside | beyond
    edge = np.diff(inside.astype(np.int8), prepend=0, append=0)
    starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    power, inverse = _powers(len(codes) + 1)
    total = np.zeros(len(codes) + 1, np.uint64)
    np.cumsum((chars + U(1)) * power[: len(codes)], out=total[1:])
    words = mix((total[ends] - total[starts]) * inverse[starts] + (ends - starts).astype(np.uint64))
    first = np.cumsum([0, *(len(t) + 1 for t in texts)])
    return words, np.searchsorted(starts, first), starts, first


def word_hashes(texts: list[str], spans: bool = False):
    """Hashes of all words and the bounds of each text in them.

    With ``spans`` also the code point at which each word starts in its text.
    """
    parts, counts, begins = [], [], []
    for first, last in grouped(texts):
        if last == first + 1 and len(texts[first]) > PIECE:
            n = 0
            for offset, piece in _cut(texts[first]):
                words, bounds, starts, _ = _piece_words([piece])
                parts.append(words)
                begins.append(starts + offset)
                n += len(words)
            counts.append([n])
        else:
            words, bounds, starts, at = _piece_words(texts[first:last])
            parts.append(words)
            counts.append(np.diff(bounds))
            begins.append(starts - np.repeat(at[:-1], counts[-1]))
    none = np.zeros(0, np.int64)
    bounds = np.concatenate([[0], np.cumsum(np.concatenate([none, *counts]))]).astype(np.int64)
    words = np.concatenate([none.astype(np.uint64), *parts])
    return (words, bounds, np.concatenate([none, *begins])) if spans else (words, bounds)


def stretch_hashes(values: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """Hash of ``values`` from ``first`` to before ``last``, the same wherever they stand."""
    power, inverse = _powers(len(values) + 1)
    total = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * power[: len(values)], out=total[1:])
    return mix((total[last] - total[first]) * inverse[first])


def shingle_hashes(
    words: np.ndarray, bounds: np.ndarray, k: int = SHINGLE, short: bool = False
) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every run of ``k`` words of each text, and the bounds of each text in them.

    ``short``: a text of fewer than ``k`` words, but one at least, has one shingle of all of them.
    """
    sizes = np.diff(bounds)
    n = len(words)
    joined = np.zeros(max(n - k + 1, 0), np.uint64)
    for j in range(k if n >= k else 0):
        joined = (joined + words[j : n - k + 1 + j] + U(j)) * _PRIME
    counts = np.maximum(sizes - k + 1, 0)
    ends = np.repeat(bounds[1:], sizes)[: len(joined)]
    kept = mix(joined[np.arange(len(joined)) + k <= ends])
    if short and (few := np.flatnonzero((sizes > 0) & (sizes < k))).size:
        whole = [np.cumprod(words[bounds[i] : bounds[i + 1]] | U(1))[-1:] + U(sizes[i]) for i in few]
        kept = np.insert(kept, np.cumsum(counts)[few], np.concatenate(whole))
        counts[few] = 1
    return kept, np.concatenate([[0], np.cumsum(counts)]).astype(np.int64)


def texts_of(column: pa.Array | pa.ChunkedArray) -> list[str]:
    """Python strings of an Arrow column, empty for nulls."""
    return ["" if t is None else t for t in column.to_pylist()]


def signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)
