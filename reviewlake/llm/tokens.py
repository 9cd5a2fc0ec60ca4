"""Words of many texts at once, as arrays."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa

#: Bytes of text that are taken at once; a longer text is taken alone.
SLICE = 4_000_000


def mixed(x: np.ndarray) -> np.ndarray:
    """The 64-bit finaliser of splitmix: equal in, equal out, all bits depend on all bits."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def slices(texts: list[bytes], size: int = SLICE) -> Iterator[tuple[int, int]]:
    """Runs of texts of about ``size`` bytes."""
    start = held = 0
    for i, text in enumerate(texts):
        if held and held + len(text) > size:
            yield start, i
            start, held = i, 0
        held += len(text)
    if start < len(texts):
        yield start, len(texts)


def texts_of(column: pa.Array) -> list[bytes]:
    """The bytes of a binary column, empty for null."""
    return [x or b"" for x in column.to_pylist()]


def numbered(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, list[bytes]]:
    """The number of each word, the end of each text in them, and the distinct words.

    A word is a run of bytes other than ASCII white space, just what ``split`` cuts at.
    """
    numbers: dict[bytes, int] = {}
    flat: list[int] = []
    ends = []
    for text in texts:
        flat += [numbers.setdefault(w, len(numbers)) for w in text.split()]
        ends.append(len(flat))
    return np.array(flat, dtype=np.int64), np.array(ends, dtype=np.int64), list(numbers)


def hashed_words(texts: list[bytes], hash_of: Callable[[bytes], int]) -> tuple[np.ndarray, np.ndarray]:
    """A 64-bit hash of each word, and the end of each text in them."""
    ids, ends, words = numbered(texts)
    hashes = np.fromiter((hash_of(w) for w in words), dtype=np.uint64, count=len(words))
    return hashes[ids] if len(words) else np.empty(0, np.uint64), ends


def starts_of(ends: np.ndarray) -> np.ndarray:
    return np.concatenate([[0], ends[:-1]]).astype(np.int64) if len(ends) else ends


def windows(ends: np.ndarray, width: int) -> np.ndarray:
    """Places at which ``width`` words of one text begin."""
    n = int(ends[-1]) if len(ends) else 0
    ok = np.ones(n, dtype=bool)
    for back in range(1, width):
        at = ends - back
        ok[at[at >= 0]] = False
    # A place that is too near to an earlier text's end is cleared above as well.
    return np.flatnonzero(ok)


def rolled(hashes: np.ndarray, at: np.ndarray, width: int, seed: int) -> np.ndarray:
    """A hash of the ``width`` word hashes from each place on."""
    out = np.zeros(len(at), dtype=np.uint64)
    factor = mixed(np.array([seed], dtype=np.uint64))[0] | np.uint64(1)
    for j in range(width):
        out = out * factor + hashes[at + j]
        if j % 8 == 7:
            out = mixed(out)
    return mixed(out)
