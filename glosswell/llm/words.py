"""Words and runs of words as 64-bit hashes, for many texts at once.

A text is taken as UTF-8 bytes; a table says which bytes belong to words and lower-cases A-Z. The
hash of a word is a polynomial of random byte values, read off running sums, so a piece of text costs
a few array passes. Pieces end between words and are small, whatever the length of a text.
"""

from __future__ import annotations

import numpy as np

PIECE_BYTES = 1 << 19

# Odd multipliers and their inverses modulo 2 ** 64.
BYTE_STEP = 0x9E3779B97F4A7C15
WORD_STEP = 0xD6E8FEB86659FD93


def values(inside: bytes) -> np.ndarray:
    """A value for each byte: 0 outside words, A-Z as a-z, random else."""
    drawn = np.random.default_rng(20_240_601).integers(1, 1 << 63, 256, np.uint64) * np.uint64(2) + np.uint64(1)
    table = np.zeros(256, np.uint64)
    for b in inside:
        table[b] = drawn[b + 32 if 65 <= b <= 90 else b]
    return table


#: [^\x20\x09-\x0D]+
SPACED = values(bytes(b for b in range(256) if b != 0x20 and not 0x09 <= b <= 0x0D))
#: [^\x00-\x2F\x3A-\x60\x7B-\x7F]+ after lower-casing
ALPHANUMERIC = values(bytes(b for b in range(256) if 48 <= b <= 57 or 65 <= b <= 90 or 97 <= b <= 122 or b >= 128))

POWERS: dict[int, np.ndarray] = {}


def powers(step: int, n: int) -> np.ndarray:
    """step ** 0 .. step ** (n - 1) modulo 2 ** 64."""
    held = POWERS.get(step)
    if held is None or len(held) < n:
        grown = np.full(max(n, PIECE_BYTES + 1), step, np.uint64)
        grown[0] = 1
        held = POWERS[step] = np.cumprod(grown, dtype=np.uint64)
    return held[:n]


def mixed(x: np.ndarray) -> np.ndarray:
    """A one-to-one scrambling of 64-bit values."""
    x = x ^ (x >> np.uint64(31))
    x = x * np.uint64(0x7FB5D329728EA185)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x81DADEF4BC2DD44D)
    return x ^ (x >> np.uint64(33))


def words_of(text: bytes, table: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash, first byte and end of every word of ``text``."""
    found = []
    raw = np.frombuffer(text, np.uint8)
    begin = 0
    while begin < len(raw):
        end = min(len(raw), begin + PIECE_BYTES)
        while end < len(raw) and table[raw[end]]:  # not inside a word
            gap = np.flatnonzero(table[raw[end : end + PIECE_BYTES]] == 0)
            end = end + int(gap[0]) if len(gap) else min(len(raw), end + PIECE_BYTES)
        value = table[raw[begin:end]]
        inside = np.zeros(len(value) + 2, np.int8)
        inside[1:-1] = value != 0
        edges = np.flatnonzero(np.diff(inside))
        first, last = edges[::2], edges[1::2]
        sums = np.zeros(len(value) + 1, np.uint64)
        np.cumsum(value * powers(BYTE_STEP, len(value)), out=sums[1:])
        inverse = powers(pow(BYTE_STEP, -1, 1 << 64), len(value) + 1)
        hashes = mixed((sums[last] - sums[first]) * inverse[first] + (last - first).astype(np.uint64))
        found.append((hashes, first + begin, last + begin))
        begin = end
    if not found:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    return tuple(np.concatenate(x) for x in zip(*found))


def texts_words(texts: list[str | None], table: np.ndarray) -> tuple[bytes, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """All texts in one byte string; hash, first byte and end of its words; where each text's words begin."""
    raw = [(t or "").encode() for t in texts]
    joined = b"\n".join(raw)
    hashes, first, last = words_of(joined, table)
    ends = np.cumsum([len(x) + 1 for x in raw]) if raw else np.zeros(0, np.int64)
    bounds = np.concatenate([[0], np.searchsorted(first, ends)]).astype(np.int64)
    return joined, hashes, first, last, bounds


def runs(hashes: np.ndarray, bounds: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every run of ``width`` words within a text, and the index of its first word."""
    n = len(hashes) - width + 1
    if n <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    total = hashes[:n].copy()
    for j in range(1, width):
        total += hashes[j : j + n] * np.uint64(pow(WORD_STEP, j, 1 << 64))
    whole = np.ones(n, bool)
    for cut in range(1, width):
        at = bounds[1:-1] - cut
        whole[at[(at >= 0) & (at < n)]] = False
    at = np.flatnonzero(whole)
    return mixed(total[at] + np.uint64(width)), at
