"""Word shingles of whole texts, hashed in numpy a chunk of texts at a time."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

from .shared import mix64

#: Bytes of text handled at a time.
CHUNK_BYTES = 2_000_000
_STEP = np.uint64(0x9E3779B97F4A7C15)


def chunks(sizes: np.ndarray, most: int = CHUNK_BYTES) -> Iterator[slice]:
    """Runs of texts of about `most` bytes; a longer text is a run of its own."""
    begin = total = 0
    for i, n in enumerate(sizes.tolist()):
        total += n + 1
        if total >= most:
            yield slice(begin, i + 1)
            begin, total = i + 1, 0
    if begin < len(sizes):
        yield slice(begin, len(sizes))


def word_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(hash of each word, index of its text) of UTF-8 texts; A-Z count as a-z, words end at space and tab to carriage return."""
    raw = np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)
    low = raw + np.uint8(32) * ((raw >= 65) & (raw <= 90))
    inside = (low != 32) & ((low < 9) | (low > 13))
    at = np.flatnonzero(inside)
    if not len(at):
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    first = np.empty(len(at), bool)
    first[0] = True
    first[1:] = np.diff(at) != 1
    begin = np.flatnonzero(first)
    size = np.diff(np.append(begin, len(at)))
    with np.errstate(over="ignore"):
        powers = np.cumprod(np.full(int(size.max()), _STEP))
        place = np.arange(len(at)) - np.repeat(begin, size)
        words = mix64(np.add.reduceat((low[at].astype(np.uint64) + np.uint64(1)) * powers[place], begin))
    ends = np.cumsum(np.fromiter(map(len, texts), np.int64, len(texts)) + 1)
    return words, np.searchsorted(ends, at[begin], side="right")


def shingle_sets(texts: list[bytes], width: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """(hash, index of its text) of each distinct shingle of each text, sorted by hash; a text of fewer words is one shingle."""
    words, text = word_hashes(texts)
    scale = np.cumprod(np.full(width, np.uint64(0xD6E8FEB86659FD93)))
    count = np.bincount(text, minlength=len(texts))
    begin = np.cumsum(count) - count
    found, owner = [], []
    with np.errstate(over="ignore"):
        if len(words) >= width:
            n = len(words) - width + 1
            whole = text[:n] == text[width - 1 :]
            total = sum((words[j : j + n] * scale[j] for j in range(1, width)), words[:n] * scale[0])
            found.append(mix64(total[whole]))
            owner.append(text[:n][whole])
        for k in range(1, width):
            short = np.flatnonzero(count == k)
            if len(short):
                total = sum((words[begin[short] + j] * scale[j] for j in range(1, k)), words[begin[short]] * scale[0])
                found.append(mix64(total + np.uint64(k)))
                owner.append(short)
    if not found:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    hashes, owner = np.concatenate(found), np.concatenate(owner)
    order = np.argsort(hashes, kind="stable") if len(found) == 1 else np.lexsort((owner, hashes))
    hashes, owner = hashes[order], owner[order]
    new = np.ones(len(hashes), bool)
    new[1:] = (hashes[1:] != hashes[:-1]) | (owner[1:] != owner[:-1])
    return hashes[new], owner[new]
