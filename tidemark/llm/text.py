"""Words and their hashes for whole Arrow batches at once, with numpy inside Spark's tasks.

A block is a run of rows of about a megabyte of text; a longer text is a block of
its own. Words are runs of bytes that a 256-entry table marks, so multi-byte
characters stay whole in UTF-8. A word's hash is a polynomial over its bytes modulo
2**64 with a random value for each byte, mixed at the end.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Bytes of text worked on at once.
BLOCK_BYTES = 1 << 20
_ODD = np.uint64(0x9E3779B97F4A7C15)
_BYTE = np.random.default_rng(20240601).integers(1, 1 << 63, 256, dtype=np.uint64)
_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def marks(*ranges: tuple[int, int]) -> np.ndarray:
    """A table that is True outside the given byte ranges."""
    table = np.ones(256, bool)
    for low, high in ranges:
        table[low : high + 1] = False
    return table


#: Words between ASCII white space, and words of letters, digits and what is not ASCII.
PLAIN = marks((0x20, 0x20), (0x09, 0x0D))
LETTERS = marks((0x00, 0x2F), (0x3A, 0x60), (0x7B, 0x7F))
LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


def mix(h: np.ndarray) -> np.ndarray:
    """Spread each 64-bit value over all its bits."""
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xFF51AFD7ED558CCD)
    h = h ^ (h >> np.uint64(29))
    h = h * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(32))


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first n powers of the odd base and of its inverse."""
    if len(_powers[0]) < n:
        size = max(n, BLOCK_BYTES + 1)
        for i, base in enumerate((int(_ODD), pow(int(_ODD), -1, 1 << 64))):
            run = np.full(size, base, np.uint64)
            run[0] = 1
            _powers[i] = np.multiply.accumulate(run)
    return _powers[0][:n], _powers[1][:n]


def blocks(batch: pa.RecordBatch, column: str = "text", limit: int = BLOCK_BYTES) -> Iterator[tuple[int, int, bytes, np.ndarray]]:
    """(first row, end row, bytes, offset of each row and the end); a null text is empty."""
    texts = batch.column(column)
    if texts.null_count:
        texts = texts.fill_null("")
    wide = pa.types.is_large_string(texts.type)
    offsets = np.frombuffer(texts.buffers()[1], np.int64 if wide else np.int32)[texts.offset : texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    at = 0
    while at < len(texts):
        end = max(at + 1, int(np.searchsorted(offsets, offsets[at] + limit, "right")) - 1)
        low, high = int(offsets[at]), int(offsets[end])
        yield at, end, data[low:high].to_pybytes() if data is not None else b"", offsets[at : end + 1].astype(np.int64) - low
        at = end


def words(data: bytes, offsets: np.ndarray, table: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, 64-bit hash, row) of each word, in order. No word reaches over the end of a row."""
    raw = np.frombuffer(data, np.uint8)
    inside = table[raw]
    first = np.zeros(len(raw) + 1, bool)
    first[offsets[:-1]] = True  # a row's first byte begins a word of its own
    before = np.empty(len(raw), bool)
    before[:1], before[1:] = False, inside[:-1]
    start = np.flatnonzero(inside & (~before | first[:-1]))
    after = np.empty(len(raw), bool)
    after[-1:], after[:-1] = False, inside[1:]
    end = np.flatnonzero(inside & (~after | first[1:])) + 1
    up, down = powers(len(raw) + 1)
    total = np.zeros(len(raw) + 1, np.uint64)
    np.cumsum(_BYTE[raw] * up[:-1], out=total[1:])
    row = np.searchsorted(offsets, start, "right") - 1
    return start, end, mix((total[end] - total[start]) * down[start]), row


def shingles(hashes: np.ndarray, row: np.ndarray, k: int) -> np.ndarray:
    """The hash of the k words from each on; 0 where they would leave the row."""
    n = len(hashes)
    out = np.zeros(n, np.uint64)
    if n < k:
        return out
    total = hashes[: n - k + 1].copy()
    for j in range(1, k):
        total = total * _ODD + hashes[j : n - k + 1 + j]
    total = mix(total + np.uint64(k)) | np.uint64(1)
    out[: n - k + 1] = np.where(row[: n - k + 1] == row[k - 1 :], total, np.uint64(0))
    return out


def by_part(part: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """(part, its rows in order)"""
    by = np.argsort(part.astype(np.uint16) if len(part) and part.max() < 1 << 16 else part, kind="stable")
    at = np.flatnonzero(np.append(True, np.diff(part[by]) != 0)) if len(by) else np.zeros(0, np.int64)
    for a, b in zip(at, np.append(at[1:], len(by))):
        yield int(part[by[a]]), by[a:b]


def pack(*columns: np.ndarray) -> bytes:
    """Columns of one length, of numbers of 0 or more, as bytes: the lowest byte of all, then the next one, compressed."""
    n, widths, planes = len(columns[0]), [], []
    for column in columns:
        width = max(1, (int(column.max()).bit_length() + 7) // 8) if n else 1
        widths.append(width)
        planes.append(column.astype("<u8").view(np.uint8).reshape(n, 8)[:, :width].T.tobytes())
    data = b"".join(planes)
    return np.array([n, len(columns), *widths], "<u8").tobytes() + pa.compress(data, codec="zstd", asbytes=True)


def unpack(data: bytes) -> list[np.ndarray]:
    """The columns of `pack`, as 64-bit numbers without sign."""
    n, many = (int(x) for x in np.frombuffer(data, "<u8", 2))
    widths = np.frombuffer(data, "<u8", many, 16).astype(np.int64)
    raw = np.frombuffer(pa.decompress(data[16 + 8 * many :], int(widths.sum()) * n, codec="zstd", asbytes=True), np.uint8)
    out, at = [], 0
    for width in widths:
        column = np.zeros((n, 8), np.uint8)
        column[:, :width] = raw[at : at + width * n].reshape(width, n).T
        out.append(column.reshape(-1).view("<u8"))
        at += int(width) * n
    return out
