"""Word shingles of whole texts as sorted arrays of 64-bit hashes, in bulk.

Words are runs of anything but ASCII white space, lower-cased A-Z only. A word's hash is a
polynomial over its bytes, taken from running sums over a piece of text; a shingle's hash
combines the hashes of its words. Pieces are cut between words and hold at most ``PIECE``
bytes, so memory does not grow with a text; a word longer than that is hashed by itself.
"""

from __future__ import annotations

import numpy as np
import xxhash

PIECE = 1 << 20
SHINGLE = 5
_MUL = 0x9E3779B97F4A7C15
_ODD = 0xD6E8FEB86659FD93
_M64 = (1 << 64) - 1
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
# Separators of plain words: every ASCII byte but letters and digits.
PLAIN = np.array([b < 128 and not chr(b).isalnum() for b in range(256)])


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of uint64 (xor-shifts and multiplications)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, np.uint64(base))
    out[0] = 1
    return np.multiply.accumulate(out)


_BYTE = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(_MUL))
_UP = _powers(_ODD, PIECE + 1)
_DOWN = _powers(pow(_ODD, -1, 1 << 64), PIECE + 1)
_PLACE = mix(np.arange(1, SHINGLE + 2, dtype=np.uint64) * np.uint64(_ODD)) | np.uint64(1)


def _pieces(text: bytes, separators: np.ndarray = _SPACE) -> list[bytes]:
    """``text`` cut between words into pieces of at most ``PIECE`` bytes, or single words."""
    out, start, flat = [], 0, np.frombuffer(text, np.uint8)
    while len(text) - start > PIECE:
        between = np.flatnonzero(separators[flat[start : start + PIECE]])
        if len(between):
            cut = int(between[-1]) + 1
        else:  # a word longer than a piece
            cut = PIECE
            while start + cut < len(text) and not separators[flat[start + cut : start + cut + PIECE]].any():
                cut += PIECE
            after = np.flatnonzero(separators[flat[start + cut : start + cut + PIECE]])
            cut = min(len(text) - start, cut + (int(after[0]) if len(after) else PIECE))
        out.append(text[start : start + cut])
        start += cut
    out.append(text[start:])
    return out


def _hash_piece(data: bytes, separators: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes and start places of the words of at most ``PIECE`` bytes."""
    flat = np.frombuffer(data, np.uint8)
    inside = ~separators[flat]
    edge = np.flatnonzero(np.diff(np.concatenate([[False], inside, [False]]).view(np.int8)))
    start, end = edge[::2], edge[1::2]
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(_BYTE[flat] * _UP[: len(flat)])])
    return mix((sums[end] - sums[start]) * _DOWN[start] + (end - start).astype(np.uint64)), start


def word_hashes(texts: list[bytes], separators: np.ndarray = _SPACE) -> list[np.ndarray]:
    """Word hashes of each text (already lower-cased), in order. ``separators`` tells the
    bytes between words, white space among them."""
    out: list[np.ndarray] = [np.zeros(0, np.uint64)] * len(texts)
    held: list[int] = []
    size = 0

    def flush() -> None:
        if not held:
            return
        joined = b" ".join(texts[i] for i in held)
        hashes, start = _hash_piece(joined, separators)
        first = np.cumsum([0, *[len(texts[i]) + 1 for i in held]])
        cuts = np.searchsorted(start, first)
        for k, i in enumerate(held):
            out[i] = hashes[cuts[k] : cuts[k + 1]]

    for i, text in enumerate(texts):
        if len(text) > PIECE:
            parts = [_hash_piece(p, separators)[0] if len(p) <= PIECE else np.array([xxhash.xxh3_64_intdigest(p)], np.uint64) for p in _pieces(text, separators)]
            out[i] = np.concatenate(parts)
            continue
        if size + len(text) + 1 > PIECE:
            flush()
            held, size = [], 0
        held.append(i)
        size += len(text) + 1
    flush()
    return out


def shingle_hashes(words: np.ndarray, width: int = SHINGLE) -> np.ndarray:
    """Hashes of the runs of ``width`` words, in order; fewer words are one shingle."""
    n = len(words)
    if not n:
        return words
    run = min(n, width)
    total = np.zeros(n - run + 1, np.uint64)
    for j in range(run):
        total += words[j : n - run + 1 + j] * _PLACE[j]
    return mix(total + _PLACE[SHINGLE] ^ np.uint64(run))


def shingle_sets(texts: list[bytes | None], width: int = SHINGLE) -> list[np.ndarray]:
    """Distinct shingle hashes of each whole text, ascending; empty for no words."""
    lowered = [(t or b"").lower() for t in texts]
    return [np.unique(shingle_hashes(w, width)) for w in word_hashes(lowered)]
