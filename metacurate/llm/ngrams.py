"""Words and word n-grams of whole Arrow batches, hashed with numpy over the raw UTF-8 bytes."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

_STEP = 1 << 17  # bytes of text handled at once; a longer text is handled alone
_BATCH = 256  # rows whose texts or results are Python objects at once

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_FOLD = np.arange(1, 257, dtype=np.uint64)
_FOLD[65:91] += 32  # A-Z as a-z

_weights = np.zeros(0, np.uint64)


def mix(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def small_batches(batches: Iterator[pa.RecordBatch], rows: int = _BATCH) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of at most ``rows``."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def _place_weights(n: int) -> np.ndarray:
    """An unrelated 64-bit weight for each of at least ``n`` places in a word."""
    global _weights
    if len(_weights) < n:
        places = np.arange(1, max(n, 2 * len(_weights), 1024) + 1, dtype=np.uint64)
        _weights = mix(places * np.uint64(0x9E3779B97F4A7C15))
    return _weights


def _word_hashes(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each word of the texts ``data[bounds[i]:bounds[i + 1]]``, and the place of each text's first word.

    Each byte counts with the weight of its place in the word. The weights follow no formula in the
    place that a text could balance, as the powers of one base would.
    """
    n = len(data)
    if n == 0:
        return np.zeros(0, np.uint64), np.zeros(len(bounds), np.int64)
    ink = ~_SPACE[data]
    cut = np.zeros(n + 1, bool)
    cut[bounds] = True
    first = ink.copy()
    first[1:] &= ~ink[:-1] | cut[1:n]
    last = ink.copy()
    last[:-1] &= ~ink[1:] | cut[1:n]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    if not len(starts):
        return np.zeros(0, np.uint64), np.zeros(len(bounds), np.int64)
    lead = int(starts[0])
    places = np.arange(lead, n) - np.repeat(starts, np.diff(starts, append=n))
    total = np.zeros(n + 1, np.uint64)
    np.cumsum(_FOLD[data[lead:]] * _place_weights(int(places.max()) + 1)[places], out=total[lead + 1 :])
    hashes = mix(total[ends] - total[starts] + (ends - starts).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))
    return hashes, np.searchsorted(starts, bounds)


def text_buffers(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string column and the bounds of its texts; nulls are empty."""
    if texts.null_count:
        texts = texts.fill_null("")
    texts = texts.cast(pa.large_string())
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    raw = texts.buffers()[2]
    data = np.frombuffer(raw, np.uint8) if raw is not None and raw.size else np.zeros(0, np.uint8)
    return data, offsets


def batch_words(texts: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Hashes of all words (runs without white space, A-Z folded), some texts at a time.

    Yields the index of the first text, the hashes, and the bounds of each text's words.
    """
    data, offsets = text_buffers(texts)
    at, n = 0, len(texts)
    while at < n:
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + _STEP, "right")) - 1)
        to = min(to, n)
        hashes, bounds = _word_hashes(data[offsets[at] : offsets[to]], offsets[at : to + 1] - offsets[at])
        yield at, hashes, bounds
        at = to


def chain(parts: list[np.ndarray]) -> np.ndarray:
    """Hash of a sequence of hashes; sequences of different length differ."""
    h = np.full(len(parts[0]), len(parts), np.uint64)
    for p in parts:
        h = mix(h * np.uint64(0x9FB21C651E98DF25) + p)
    return h


def shingle_sets(texts: pa.Array, n: int) -> Iterator[tuple[int, np.ndarray]]:
    """For each text its index and the sorted distinct hashes of its ``n``-word shingles.

    A text with fewer words has its whole sequence as one shingle, one without words has none.
    """
    for at, words, bounds in batch_words(texts):
        windows = (
            chain([words[i : len(words) - n + 1 + i] for i in range(n)]) if len(words) >= n else words[:0]
        )
        for i in range(len(bounds) - 1):
            a, b = int(bounds[i]), int(bounds[i + 1])
            if b - a >= n:
                yield at + i, np.unique(windows[a : b - n + 1])
            elif b > a:
                yield at + i, chain([words[j : j + 1] for j in range(a, b)])
            else:
                yield at + i, words[:0]
