"""Words of whole Arrow text batches as numpy arrays.

A word is a maximal run of bytes other than 0x20 and 0x09-0x0D; UTF-8 never
uses those bytes inside a character, so byte runs and character runs agree.
Texts are worked on in slices of about ``SLICE_BYTES`` so that a task's memory
does not depend on the size of its Arrow batch; one very long text costs a few
bytes per byte of it.  Null texts count as empty.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 1 << 20
SPACE = np.zeros(256, dtype=bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
SAME = np.arange(256, dtype=np.uint8)
LOWER = SAME.copy()
LOWER[65:91] += 32
_STEP = 4096
U64 = np.uint64


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values (multiply and xor-shift)."""
    x = x ^ (x >> U64(32))
    x = x * U64(0xD6E8FEB86659FD93)
    x = x ^ (x >> U64(32))
    x = x * U64(0xD6E8FEB86659FD93)
    return x ^ (x >> U64(32))


class Words:
    """Words of a slice of documents: word ``i`` is ``data[starts[i]:ends[i]]``;
    document ``d`` owns words ``first[d]:first[d + 1]``."""

    def __init__(self, data: np.ndarray, bounds: np.ndarray):
        self.data, self.bounds = data, bounds
        n = len(data)
        solid = ~SPACE[data]
        edge = np.zeros(n + 1, dtype=bool)
        edge[bounds] = True
        head = solid.copy()
        head[1:] &= ~solid[:-1] | edge[1:n]
        tail = solid
        tail[:-1] &= ~solid[1:] | edge[1:n]
        self.starts, self.ends = np.flatnonzero(head), np.flatnonzero(tail) + 1
        self.first = np.searchsorted(self.starts, bounds)

    def __len__(self) -> int:
        return len(self.starts)

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def hashes(self, seed: int = 0, fold: np.ndarray = SAME) -> np.ndarray:
        """64-bit hash of each word; ``fold`` maps bytes first (``LOWER``: A-Z)."""
        rng = np.random.default_rng(0x5EED + seed)
        table = np.where(SPACE, U64(0), (rng.integers(0, 2**63, 256, dtype=np.uint64) * U64(2) + U64(1))[fold])  # blanks add nothing
        base = int(rng.integers(0, 2**61)) * 8 + 5
        powers = lambda x, n: np.cumprod(np.concatenate([[U64(1)], np.full(n - 1, U64(x % (1 << 64)), dtype=np.uint64)]))
        power, back = powers(base, _STEP), powers(pow(base, -1, 1 << 64), _STEP)
        out = np.empty(len(self), dtype=np.uint64)
        a = 0
        while a < len(self):
            b = max(a + 1, int(np.searchsorted(self.ends, self.starts[a] + SLICE_BYTES, "right")))
            size, begin = self.ends[a:b] - self.starts[a:b], self.starts[a:b] - self.starts[a]
            n = int(self.ends[b - 1] - self.starts[a])
            blocks = -(-n // _STEP)
            # each byte's value times base^place in the slice, whose sum over a word is then
            # divided by base^(place of its start): base is odd, so it has an inverse
            value = np.zeros(blocks * _STEP, np.uint64)
            value[:n] = table[self.data[self.starts[a]:self.ends[b - 1]]]
            square = value.reshape(blocks, _STEP)
            square *= power
            square *= powers(pow(base, _STEP, 1 << 64), blocks)[:, None]
            start = powers(pow(base, -_STEP, 1 << 64), blocks)[begin // _STEP] * back[begin % _STEP]
            out[a:b] = mix(np.add.reduceat(value, begin) * start + size.astype(np.uint64) * U64(0x9E3779B97F4A7C15))
            a = b
        return out


def column(batch: pa.RecordBatch, name: str) -> pa.Array:
    return batch.column(batch.schema.get_field_index(name))


def text_slices(batch: pa.RecordBatch, name: str = "text") -> Iterator[tuple[int, int, Words]]:
    """``(from row, to row, Words)`` over consecutive slices of the batch."""
    texts = pc.fill_null(column(batch, name).cast(pa.large_binary()), b"")
    offsets = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset:texts.offset + len(texts) + 1]
    payload = texts.buffers()[2]
    data = np.frombuffer(payload, dtype=np.uint8) if payload is not None else np.empty(0, np.uint8)
    a = 0
    while a < len(texts):
        b = max(a + 1, int(np.searchsorted(offsets, offsets[a] + SLICE_BYTES, "right")) - 1)
        yield a, b, Words(data[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a])
        a = b


def chain(hashes: np.ndarray, size: int) -> np.ndarray:
    """Hash of every run of ``size`` neighbouring values (ignoring documents)."""
    n = len(hashes) - size + 1
    if n <= 0:
        return np.empty(0, dtype=np.uint64)
    # sum of value[i + j] * base^j for all i, by doubling the run length
    base, total, done, power = 0x9E3779B97F4A7C15 | 1, None, 0, hashes
    width = 1
    rest = size
    while rest:
        if rest & 1:
            part = power[done:done + n] * U64(pow(base, done, 1 << 64))
            total = part if total is None else total + part
            done += width
        rest >>= 1
        if rest:
            power = power[:-width] + power[width:] * U64(pow(base, width, 1 << 64))
            width *= 2
    return mix(total + U64(size))


def inside(counts: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Start positions of runs of ``size`` words that stay inside one document,
    and the document of each, for documents of ``counts`` words."""
    runs = np.maximum(counts - size + 1, 0)
    doc = np.repeat(np.arange(len(counts)), runs)
    first = np.cumsum(counts) - counts
    begin = np.cumsum(runs) - runs
    return np.arange(int(runs.sum())) - begin[doc] + first[doc], doc
