"""Hashes of words and of runs of words, for whole batches of texts at once."""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa

# A polynomial over a word's bytes, modulo 2^64; the base is odd, so its powers can be taken back.
BASE = 0x9E3779B97F4A7C15
BASE_BACK = pow(BASE, -1, 1 << 64)
PIECE = 1 << 20  # bytes hashed at a time

SPACE, LETTER, MARK = 0, 1, 2


def _classes() -> np.ndarray:
    """Of a byte: ASCII white space, a letter, digit or byte of a longer character, or a mark."""
    table = np.full(256, LETTER, np.uint8)
    for code in range(128):
        if not chr(code).isalnum():
            table[code] = MARK
    for code in b" \t\n\x0b\x0c\r":
        table[code] = SPACE
    return table


CLASS = _classes()


@lru_cache(maxsize=2)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    def powers(base: int) -> np.ndarray:
        out = np.full(n, base, np.uint64)
        out[0] = 1
        return np.cumprod(out, dtype=np.uint64)

    return powers(BASE), powers(BASE_BACK)


def mixed(values: np.ndarray) -> np.ndarray:
    """Spread 64-bit values (the finaliser of splitmix64)."""
    x = values + np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def buffer_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts, and where each begins and the last ends; null texts are empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    if texts.null_count:
        texts = texts.fill_null("")
    wide = pa.types.is_large_string(texts.type)
    offsets = np.frombuffer(texts.buffers()[1], np.int64 if wide else np.int32)[texts.offset : texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    if not len(offsets):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    return raw[offsets[0] : offsets[-1]], offsets.astype(np.int64) - int(offsets[0])


def word_hashes(raw: np.ndarray, bounds: np.ndarray, marks: bool) -> tuple[np.ndarray, np.ndarray]:
    """A hash of each word, in order, and at which word each text begins (and the last ends).

    Words are runs without ASCII white space; with marks, runs of marks and runs of other characters are words of their own.
    """
    hashes, firsts, at = [], [], 0
    while at < len(raw):
        end = min(at + PIECE, len(raw))
        if end < len(raw):  # a piece ends where a text ends, or else at white space
            inside = bounds[np.searchsorted(bounds, at, "right") : np.searchsorted(bounds, end, "right")]
            if len(inside):
                end = int(inside[-1])
            else:
                limit = int(bounds[np.searchsorted(bounds, end, "left")])
                step = end
                while step < limit and CLASS[raw[step]] != SPACE:
                    step += 1
                end = step
        piece = raw[at:end]
        kind = CLASS[piece]
        if not marks:
            kind = np.minimum(kind, LETTER)
        change = np.ones(len(piece), bool)
        change[1:] = kind[1:] != kind[:-1]
        own = bounds[np.searchsorted(bounds, at, "left") : np.searchsorted(bounds, end, "left")] - at
        change[own[own < len(piece)]] = True
        starts = np.flatnonzero(change)
        ends = np.append(starts[1:], len(piece))
        word = kind[starts] != SPACE
        starts, ends = starts[word], ends[word]
        size = PIECE
        while size < len(piece):
            size *= 2
        power, back = _powers(size)
        total = np.zeros(len(piece) + 1, np.uint64)
        np.cumsum((piece.astype(np.uint64) + np.uint64(1)) * power[: len(piece)], out=total[1:])
        hashes.append((total[ends] - total[starts]) * back[starts])
        firsts.append(starts + at)
        at = end
    if not hashes:
        return np.zeros(0, np.uint64), np.zeros(len(bounds), np.int64)
    return mixed(np.concatenate(hashes)), np.searchsorted(np.concatenate(firsts), bounds, "left")
