"""Words of whole Arrow batches as arrays: where each word lies, whose it is, and a 64-bit hash.

Everything works on UTF-8 bytes, where both word patterns of this subpackage are byte classes, because
every byte of a character beyond ASCII is at least 0x80. Lower-casing touches A-Z only.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

SLICE_BYTES = 1 << 19

_BYTES = np.arange(256)
#: ``[^\x20\x09-\x0D]+``
SPACED = ~((_BYTES == 0x20) | ((_BYTES >= 0x09) & (_BYTES <= 0x0D)))
#: ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]+`` in lower-cased text
ALPHANUMERIC = ~(
    (_BYTES <= 0x2F) | ((_BYTES >= 0x3A) & (_BYTES <= 0x60)) | ((_BYTES >= 0x7B) & (_BYTES <= 0x7F))
)
_LOWER = np.where((_BYTES >= 0x41) & (_BYTES <= 0x5A), _BYTES | 0x20, _BYTES).astype(np.uint8)

# An odd base has an inverse modulo 2**64, so one prefix sum serves all words of a slice.
_BASE = 0x9E3779B97F4A7C15 | 1
_powers = np.ones(1, np.uint64)
_inverse_powers = np.ones(1, np.uint64)


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    global _powers, _inverse_powers
    if len(_powers) < n:
        size = max(n, 2 * len(_powers))
        tables = []
        for base in (_BASE, pow(_BASE, -1, 1 << 64)):
            table = np.full(size, base, np.uint64)
            table[0] = 1
            tables.append(np.cumprod(table, dtype=np.uint64))
        _powers, _inverse_powers = tables
    return _powers, _inverse_powers


def mixed(values: np.ndarray, seed: int = 0) -> np.ndarray:
    """A bijective mix of 64-bit values, another one for each seed."""
    x = values + np.uint64((seed * 0xBF58476D1CE4E5B9 + 0x94D049BB133111EB) % (1 << 64))
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@dataclass
class Words:
    """Words of some texts in order: text number, byte span in ``data``, hash; ``n`` texts."""

    data: np.ndarray
    bounds: np.ndarray
    text: np.ndarray
    start: np.ndarray
    end: np.ndarray
    hash: np.ndarray
    n: int

    @property
    def counts(self) -> np.ndarray:
        return np.bincount(self.text, minlength=self.n)


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of an array of texts and the bounds of each; null is empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    if texts.null_count:
        texts = texts.fill_null("")
    wide = pa.types.is_large_string(texts.type) or pa.types.is_large_binary(texts.type)
    if not len(texts):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = texts.buffers()
    bounds = np.frombuffer(offsets, np.int64 if wide else np.int32)
    bounds = bounds[texts.offset: texts.offset + len(texts) + 1].astype(np.int64)
    if data is None:
        return np.zeros(0, np.uint8), bounds - bounds[0]
    return np.frombuffer(data, np.uint8)[bounds[0]: bounds[-1]], bounds - bounds[0]


def slices(batch: pa.RecordBatch, column: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Runs of rows whose texts have about ``limit`` bytes; a longer text is a run of its own."""
    if not batch.num_rows:
        return
    _, bounds = text_bytes(batch.column(column))
    first = 0
    while first < batch.num_rows:
        last = int(np.searchsorted(bounds, bounds[first] + limit, "right")) - 1
        last = min(max(last, first + 1), batch.num_rows)
        yield batch.slice(first, last - first)
        first = last
    pa.default_memory_pool().release_unused()  # workers live on between tasks


def words_of(texts: pa.Array, inside: np.ndarray = SPACED, hashed: bool = True) -> Words:
    """Words of lower-cased texts; ``inside`` says which bytes belong to words."""
    raw, bounds = text_bytes(texts)
    data = _LOWER[raw]
    n, size = len(bounds) - 1, len(data)
    if not size:
        none = np.zeros(0, np.int64)
        return Words(data, bounds, none, none, none, none.astype(np.uint64), n)
    word = inside[data]
    cut = np.zeros(size + 1, bool)
    cut[bounds] = True
    first, last = word.copy(), word.copy()
    first[1:] &= ~word[:-1] | cut[1:-1]
    last[:-1] &= ~word[1:] | cut[1:-1]
    start, end = np.flatnonzero(first), np.flatnonzero(last) + 1
    text = np.searchsorted(bounds, start, "right") - 1
    hashes = _hashes(data, start, end) if hashed else np.zeros(0, np.uint64)
    return Words(data, bounds, text, start, end, hashes, n)


def _hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Polynomial hash of each span, mixed with its length; spans lie in order."""
    found = np.empty(len(start), np.uint64)
    i = 0
    while i < len(start):  # parts between words, so that a long text needs no long tables
        j = max(int(np.searchsorted(end, start[i] + SLICE_BYTES, "right")), i + 1)
        at, to = int(start[i]), int(end[j - 1])
        powers, inverse = _power_tables(to - at + 1)
        sums = np.zeros(to - at + 1, np.uint64)
        np.cumsum((data[at:to].astype(np.uint64) + np.uint64(1)) * powers[: to - at], out=sums[1:])
        s, e = start[i:j] - at, end[i:j] - at
        found[i:j] = (sums[e] - sums[s]) * inverse[s] + (e - s).astype(np.uint64)
        i = j
    return mixed(found)


def shingles(words: Words, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(text, hash) of all shingles of ``size`` words; a text of fewer words has one, all of it."""
    if not len(words.hash):
        return words.text, words.hash
    values = mixed(words.hash, 1)
    last = np.arange(len(values))
    ends = np.cumsum(words.counts)[words.text]
    for k in range(1, size):
        here = last + k < ends
        values[here] = mixed(values[here], 1) + words.hash[last[here] + k]
    counts = words.counts[words.text]
    place = last - (ends - counts)
    keep = np.where(counts >= size, place + size <= counts, place == 0)
    return words.text[keep], mixed(values[keep], 2)


def distinct(text: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The pairs once each, sorted."""
    order = np.lexsort((values, text))
    text, values = text[order], values[order]
    new = np.ones(len(text), bool)
    new[1:] = (text[1:] != text[:-1]) | (values[1:] != values[:-1])
    return text[new], values[new]
