"""Words and hashes of many texts at once, from the bytes of an Arrow column."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

U = np.uint64
MULT = 0x9E3779B97F4A7C15
WINDOW_MULT, OTHER_MULT = 0xD6E8FEB86659FD93, 0xCA5A826395121157
PIECE = 1 << 20

BLANK_TABLE = np.zeros(256, bool)
BLANK_TABLE[[9, 10, 13, 32]] = True

WORD_GAP = np.zeros(256, bool)
WORD_GAP[:128] = True
for _lo, _hi in ((48, 57), (65, 90), (97, 122)):
    WORD_GAP[_lo : _hi + 1] = False
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """base**i and base**-i modulo 2**64."""
    if base not in _powers or len(_powers[base][0]) < n:
        size = max(n, PIECE + 4096)
        inverse = pow(base, -1, 1 << 64)
        with np.errstate(over="ignore"):
            up = np.full(size, base, U)
            up[0] = 1
            down = np.full(size, inverse, U)
            down[0] = 1
            _powers[base] = np.multiply.accumulate(up), np.multiply.accumulate(down)
    return _powers[base]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64 bits that spreads every bit."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
        return x ^ (x >> U(31))


def few(yes: np.ndarray) -> np.ndarray:
    """Places of the true values of a flat array that has few: eight are looked at together."""
    whole = len(yes) // 8 * 8
    eights = np.flatnonzero(yes[:whole].view(U) != 0)
    at = (eights[:, None] * 8 + np.arange(8)).ravel()
    return np.concatenate([at[yes[at]], whole + np.flatnonzero(yes[whole:])])


def buffers(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts and n + 1 offsets into them; a null is an empty text."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    if texts.null_count:
        texts = pc.fill_null(texts, "")
    texts = texts.cast(pa.large_string())
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    raw = texts.buffers()[2]
    if raw is None or not len(texts):
        return np.zeros(0, np.uint8), np.zeros(len(texts) + 1, np.int64)
    return np.frombuffer(raw, np.uint8)[offsets[0] : offsets[-1]], offsets - offsets[0]


def pieces(offsets: np.ndarray, limit: int = PIECE) -> Iterator[tuple[int, int]]:
    """Ranges of whole texts of up to `limit` bytes together, or one longer text."""
    i, n = 0, len(offsets) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + limit, "right")) - 1)
        yield i, j
        i = j


def fold(data: np.ndarray) -> np.ndarray:
    """Lower case for ASCII and for the Latin-1 letters of two bytes."""
    low = LOWER[data]
    after = np.flatnonzero(data[:-1] == 0xC3) + 1
    letters = after[(data[after] >= 0x80) & (data[after] <= 0x9E) & (data[after] != 0x97)]
    low[letters] += 0x20
    return low


def words(data: np.ndarray, offsets: np.ndarray, gap: np.ndarray, apart: bool = False) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(hash, start, end) of every maximal run of bytes outside `gap`, and each text's first word (n + 1).

    apart: each character from U+3000 on is a word by itself, for scripts that put no blanks between words.
    The bytes are worked through in blocks of PIECE, so that beside the words of a long text little memory is needed.
    """
    if not len(data):
        none = np.zeros(0, np.int64)
        return np.zeros(0, U), none, none, np.zeros(len(offsets), np.int64)
    filled = offsets[:-1] < offsets[1:]
    heads = offsets[:-1][filled]
    found: list[tuple[np.ndarray, ...]] = []
    up, down = powers(MULT, PIECE + 1)
    block_up, block_down, base, inside_before, lone_until = U(1), U(1), U(0), False, 0
    step_up, step_down = U(pow(MULT, PIECE, 1 << 64)), U(pow(pow(MULT, -1, 1 << 64), PIECE, 1 << 64))
    for lo in range(0, len(data), PIECE):
        part = data[lo : lo + PIECE]
        n = len(part)
        inside = ~gap[part]
        fresh = np.zeros(n + 1, bool)  # a word can't go on over this place
        fresh[heads[np.searchsorted(heads, lo) : np.searchsorted(heads, lo + n, "right")] - lo] = True
        if apart:
            if lone_until >= lo:
                fresh[lone_until - lo] = True
            lone = np.flatnonzero(part >= 0xE3)
            after = lone + np.where(part[lone] >= 0xF0, 4, 3)
            fresh[lone] = True
            fresh[after[after <= n]] = True
            lone_until = lo + int(after[-1]) if len(after) else -1
        before = np.concatenate([[inside_before], inside[:-1]])
        begin = np.flatnonzero(inside & (~before | fresh[:n]))
        # ends of words, as places after them; one at the block's first byte ends a word of the block before
        end = np.flatnonzero(before & (~inside | fresh[:n]))
        with np.errstate(over="ignore"):
            sums = np.zeros(n + 1, U)
            np.cumsum((part.astype(U) + U(1)) * up[:n], out=sums[1:])
            found.append((begin + lo, base + block_up * sums[begin], block_down * down[begin], end + lo, base + block_up * sums[end]))
            base = base + block_up * sums[n]
            block_up, block_down = block_up * step_up, block_down * step_down
        inside_before = bool(inside[-1])
    start, at_start, shift, end, at_end = (np.concatenate(x) for x in zip(*found))
    if inside_before:
        end, at_end = np.append(end, len(data)), np.append(at_end, base)
    with np.errstate(over="ignore"):
        hashes = mix((at_end - at_start) * shift + (end - start).astype(U))
    return hashes, start, end, np.searchsorted(start, offsets)


def windows(hashes: np.ndarray, first: np.ndarray, width: int, block: int = 1 << 18) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Two independent Rabin-Karp hashes of every `width` consecutive words within a text, block by block: (hash, other hash,
    text, word's place in it)."""
    n = len(hashes) - width + 1
    if n <= 0:
        return
    tables = [powers(base, block + width) for base in (WINDOW_MULT, OTHER_MULT)]
    for lo in range(0, n, block):
        hi = min(n, lo + block)
        own = hashes[lo : hi + width - 1]
        text = np.searchsorted(first, np.arange(lo, hi), "right") - 1
        at = np.flatnonzero(np.arange(lo, hi) + width <= first[1:][text])
        if not len(at):
            continue
        rolled = []
        with np.errstate(over="ignore"):
            for up, down in tables:
                sums = np.zeros(len(own) + 1, U)
                np.cumsum(own * up[: len(own)], out=sums[1:])
                rolled.append(mix((sums[at + width] - sums[at]) * down[at]))
        yield rolled[0], rolled[1], text[at], at + lo - first[:-1][text[at]]


def counted(hashes: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Each text's distinct words: (a position of the word, its count, first of each text (n + 1))."""
    n = len(first) - 1
    if not len(hashes):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(n + 1, np.int64)
    text = np.repeat(np.arange(n), np.diff(first)).astype(U)
    width = max(1, int(n).bit_length())
    key = (text << U(64 - width)) | (hashes >> U(width))
    order = np.argsort(key)
    key = key[order]
    new = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
    count = np.diff(np.append(new, len(key)))
    at = order[new]
    return at, count, np.searchsorted(text[at], np.arange(n + 1).astype(U))
