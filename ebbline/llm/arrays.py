"""Vectorised text helpers used inside Arrow tasks.

A task sees record batches; ``text_chunks`` cuts them into pieces of a few
megabytes so that the numpy temporaries stay small whatever the batch size.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

CHUNK_BYTES = 1 << 20

#: Odd multipliers and mixing constants of the 64-bit hashes.
_BASE = 0x9E3779B97F4A7C15
_BASE_INVERSE = pow(_BASE, -1, 1 << 64)
_SHINGLE = np.uint64(0xD6E8FEB86659FD93)

WORD_BYTE = np.zeros(256, dtype=bool)
WORD_BYTE[[*range(48, 58), *range(65, 91), *range(97, 123), 95]] = True
WORD_BYTE[128:] = True

#: The same rule as a pattern: runs of digits, letters, `_` and anything beyond ASCII.
WORD_PATTERN = "[0-9A-Za-z_\u0080-\U0010ffff]+"


def mix64(x: np.ndarray) -> np.ndarray:
    """The finaliser of splitmix64: every input bit reaches every output bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a string or binary column; a null is an empty value."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("" if pa.types.is_string(column.type) or pa.types.is_large_string(column.type) else b"")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, where, data = column.buffers()
    n = len(column)
    offsets = np.frombuffer(where, dtype=np.int64 if wide else np.int32)[column.offset : column.offset + n + 1].astype(np.int64)
    raw = np.frombuffer(data, dtype=np.uint8)[offsets[0] : offsets[-1]] if data is not None and n else np.zeros(0, np.uint8)
    return raw, offsets - (offsets[0] if n else 0)


def chunk_ranges(offsets: np.ndarray, most: int = CHUNK_BYTES):
    """Row ranges of at most ``most`` bytes, one row at least."""
    n, at = len(offsets) - 1, 0
    while at < n:
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + most, "right")) - 1)
        yield at, min(to, n)
        at = to


def free_name(name: str, taken) -> str:
    """``name`` with underscores before it until no column of ``taken`` bears it (in any case of letters)."""
    taken = {c.lower() for c in taken}
    while name.lower() in taken:
        name = "_" + name
    return name


def text_chunks(batches, column: str = "text", most: int = CHUNK_BYTES):
    """(record batch slice, bytes, offsets) pieces of the batches."""
    for batch in batches:
        if not batch.num_rows:
            continue
        data, offsets = utf8(batch.column(batch.schema.get_field_index(column)))
        for a, b in chunk_ranges(offsets, most):
            yield batch.slice(a, b - a), data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]


def _powers(base: int, n: int) -> np.ndarray:
    out = np.empty(max(1, n), dtype=np.uint64)
    out[0] = 1
    done = 1
    while done < n:
        step = min(done, n - done)
        out[done : done + step] = out[:step] * np.uint64(pow(base, done, 1 << 64))
        done += step
    return out


_POWERS: dict[str, np.ndarray] = {}


def _tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    if "up" not in _POWERS or len(_POWERS["up"]) < n:
        size = max(n, CHUNK_BYTES + 1)
        _POWERS.update(up=_powers(_BASE, size), down=_powers(_BASE_INVERSE, size))
    return _POWERS["up"], _POWERS["down"]


def word_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end (exclusive) and number per row of the words; no word crosses a row's border."""
    n = len(data)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(offsets) - 1, np.int64)
    inside = WORD_BYTE[data]
    edge = np.zeros(n + 1, dtype=bool)
    edge[offsets] = True
    first = inside.copy()
    first[1:] &= ~inside[:-1] | edge[1:n]
    last = inside.copy()
    last[:-1] &= ~inside[1:] | edge[1:n]
    starts = np.flatnonzero(first)
    return starts, np.flatnonzero(last) + 1, np.diff(np.searchsorted(starts, offsets))


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit polynomial hashes of byte spans, mixed; spans are sorted and do not overlap."""
    out = np.empty(len(starts), dtype=np.uint64)
    at = 0
    while at < len(starts):  # a stretch at a time, so that tables and sums stay small for long texts
        lo = int(starts[at])
        to = max(at + 1, int(np.searchsorted(ends, lo + CHUNK_BYTES, "right")))
        hi = int(ends[to - 1])
        up, down = _tables(hi - lo + 1)
        total = np.zeros(hi - lo + 1, dtype=np.uint64)
        np.cumsum((data[lo:hi].astype(np.uint64) + np.uint64(1)) * up[: hi - lo], out=total[1:])
        s, e = starts[at:to] - lo, ends[at:to] - lo
        out[at:to] = (total[e] - total[s]) * down[s]
        at = to
    return mix64(out)


def shingle_hashes(words: np.ndarray, counts: np.ndarray, size: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of ``size`` words of each row, and the rows' borders among them.

    A row of fewer words has one shingle, all its words; a row without words has none.
    """
    borders = np.concatenate([[0], np.cumsum(counts)])
    number = np.where(counts >= size, counts - size + 1, (counts > 0).astype(np.int64))
    out_borders = np.concatenate([[0], np.cumsum(number)])
    out = np.empty(out_borders[-1], dtype=np.uint64)
    if len(words) >= size:
        rolled = words[: len(words) - size + 1].copy()
        for k in range(1, size):
            rolled = rolled * _SHINGLE + words[k : len(words) - size + 1 + k]
        rolled = mix64(rolled)
    rows = np.repeat(np.arange(len(counts)), number)
    if len(rows):
        inner = np.arange(len(rows)) - out_borders[rows]
        full = counts[rows] >= size
        if full.any():
            out[full] = rolled[(borders[rows] + inner)[full]]
        for i in np.flatnonzero(~full):
            h = np.uint64(counts[rows[i]])
            with np.errstate(over="ignore"):
                for w in words[borders[rows[i]] : borders[rows[i] + 1]]:
                    h = h * _SHINGLE + w
            out[i] = mix64(np.array([h], dtype=np.uint64))[0]
    return out, out_borders
