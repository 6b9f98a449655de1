"""Vectorised helpers over Arrow batches of texts (used inside Spark tasks).

A task never handles more than a bounded slice of text at a time: batches are
cut by bytes (``text_slices``); one row is the smallest slice.  Words are
found on the UTF-8 bytes and identified by 64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

U = np.uint64
SLICE_BYTES = 1 << 20

# Fixed odd multipliers of the 64-bit mixing and window hashes.
MIX_A = U(0xBF58476D1CE4E5B9)
MIX_B = U(0x94D049BB133111EB)
WORD_STEP = U(0x9E3779B97F4A7C15)
WINDOW_BASE = 0xD1342543DE82EF95


def column(batch: pa.RecordBatch | pa.Table, name: str) -> pa.Array:
    """A column of a batch as one array."""
    col = batch.column(batch.schema.get_field_index(name))
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
        if isinstance(col, pa.ChunkedArray):
            col = col.chunk(0) if col.num_chunks else pa.array([], col.type)
    return col


def text_bytes(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all texts end to end, and n + 1 offsets; a null is empty."""
    col = pc.fill_null(col.cast(pa.large_string()), "")
    buffers = col.buffers()
    offsets = np.frombuffer(buffers[1], np.int64)[col.offset : col.offset + len(col) + 1]
    if len(offsets) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    data = np.frombuffer(buffers[2] or b"", np.uint8)[offsets[0] : offsets[-1]]
    return data, offsets - offsets[0]


def text_slices(
    batches: Iterable[pa.RecordBatch], text_col: str, max_bytes: int = SLICE_BYTES
) -> Iterator[pa.RecordBatch]:
    """The batches cut into slices of about ``max_bytes`` of text, one row at least."""
    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        sizes = pc.fill_null(pc.binary_length(column(batch, text_col)), 0).to_numpy(zero_copy_only=False)
        ends = np.cumsum(sizes, dtype=np.int64)
        at = 0
        while at < n:
            done = int(ends[at - 1]) if at else 0
            to = max(at + 1, int(np.searchsorted(ends, done + max_bytes, side="right")))
            yield batch.slice(at, to - at)
            at = to


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective 64-bit finaliser."""
    x = x ^ (x >> U(30))
    x *= MIX_A
    x ^= x >> U(27)
    x *= MIX_B
    x ^= x >> U(31)
    return x


def byte_class(word: Iterable[int]) -> np.ndarray:
    table = np.zeros(256, bool)
    table[list(word)] = True
    return table


#: Word bytes of ``[^\x20\x09-\x0D]+``.
SPACED = byte_class(b for b in range(256) if b != 0x20 and not 0x09 <= b <= 0x0D)
#: Word bytes of ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]+`` (after lower-casing A-Z).
ALNUM = byte_class(b for b in range(256) if not (b <= 0x2F or 0x3A <= b <= 0x60 or 0x7B <= b <= 0x7F))

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32


def lower_ascii(data: np.ndarray) -> np.ndarray:
    """Bytes with A-Z lower-cased; all others unchanged."""
    return _LOWER[data]


def find_words(data: np.ndarray, offsets: np.ndarray, table: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, ends, first): byte spans of all words, and n + 1 word offsets of the documents.

    A word never crosses the end of its document.
    """
    n = len(data)
    if n == 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(offsets), np.int64)
    inside = table[data]
    edge = np.zeros(n + 1, bool)
    edge[offsets] = True
    edge[0] = edge[n] = True
    change = np.empty(n + 1, bool)
    change[0] = change[n] = True
    np.not_equal(inside[1:], inside[:-1], out=change[1:n])
    change |= edge
    cuts = np.flatnonzero(change)
    word = inside[cuts[:-1]]
    starts, ends = cuts[:-1][word], cuts[1:][word]
    return starts, ends, np.searchsorted(starts, offsets)


def hash_words(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit id of each byte span: eight bytes at a time, then mixed with the length."""
    if not len(starts):
        return np.zeros(0, U)
    padded = np.zeros(len(data) + 8, np.uint8)
    padded[: len(data)] = data
    eight = np.ndarray(shape=(len(data) + 1,), dtype="<u8", buffer=padded, strides=(1,))
    masks = np.array([(1 << (8 * k)) - 1 for k in range(9)], U)
    size = ends - starts
    ids = mix((eight[starts] & masks[np.minimum(size, 8)]) + size.astype(U) * WORD_STEP)
    rest = np.flatnonzero(size > 8)
    done = 8
    while len(rest):
        left = size[rest] - done
        part = eight[starts[rest] + done] & masks[np.minimum(left, 8)]
        ids[rest] = mix(ids[rest] * WORD_STEP + part)
        rest = rest[left > 8]
        done += 8
    return ids


_POWERS: dict[str, np.ndarray] = {}


def _powers(n: int, inverse: bool) -> np.ndarray:
    name = "inverse" if inverse else "plain"
    if len(_POWERS.get(name, ())) < n + 1:
        base = pow(WINDOW_BASE, -1, 1 << 64) if inverse else WINDOW_BASE
        out = np.full(max(n + 1, 1 << 16), U(base))
        out[0] = 1
        _POWERS[name] = np.multiply.accumulate(out)
    return _POWERS[name]


class Windows:
    """Hashes of any run of ids: a polynomial over a prefix sum, modulo 2**64."""

    def __init__(self, ids: np.ndarray):
        n = len(ids)
        self.n = n
        self.sums = np.zeros(n + 1, U)
        np.cumsum(ids * _powers(n, False)[:n], out=self.sums[1:])
        self.back = _powers(n, True)

    def of(self, width: int) -> np.ndarray:
        """Hash of every run of ``width`` ids, by start."""
        m = self.n - width + 1
        if m <= 0:
            return np.zeros(0, U)
        return mix((self.sums[width:] - self.sums[:m]) * self.back[:m])

    def spans(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Hash of the run [start, end) for each pair."""
        return mix((self.sums[ends] - self.sums[starts]) * self.back[starts])


def slide(values: np.ndarray, width: int, op: np.ufunc) -> np.ndarray:
    """op (np.minimum or np.maximum) over every run of ``width`` values, by start."""
    out, have = values, 1
    while have < width:
        step = min(have, width - have)
        out = op(out[: len(out) - step], out[step:])
        have += step
    return out


def window_starts(first: np.ndarray, width: int) -> np.ndarray:
    """Mask over all ids: whether a run of ``width`` that starts there stays in its document."""
    n = int(first[-1])
    left = np.repeat(first[1:], np.diff(first)) - np.arange(n)
    return left >= width


def covered(starts: np.ndarray, width: int, n: int) -> np.ndarray:
    """Mask over n positions: those inside [s, s + width) of any start."""
    if not len(starts):
        return np.zeros(n, bool)
    step = np.bincount(starts, minlength=n + 1)[: n + 1]
    step -= np.bincount(np.minimum(starts + width, n), minlength=n + 1)[: n + 1]
    return np.cumsum(step)[:n] > 0


def covered_spans(starts: np.ndarray, ends: np.ndarray, n: int) -> np.ndarray:
    """Mask over n positions: those inside [start, end) of any pair."""
    step = np.bincount(starts, minlength=n + 1)[: n + 1] - np.bincount(ends, minlength=n + 1)[: n + 1]
    return np.cumsum(step)[:n] > 0


def joined_words(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, first: np.ndarray, keep: np.ndarray) -> pa.Array:
    """Each document's kept words, joined by one space."""
    kept = np.flatnonzero(keep)
    doc = np.searchsorted(first, kept, side="right") - 1
    size = ends[kept] - starts[kept]
    # every word but its document's first stands after a space
    lead = np.concatenate([[False], doc[1:] == doc[:-1]])[: len(kept)].astype(np.int64)
    to = np.cumsum(size + lead)
    text = np.full(int(to[-1]) if len(to) else 0, 0x20, np.uint8)
    step = np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size)
    text[np.repeat(to - size, size) + step] = data[np.repeat(starts[kept], size) + step]
    n = len(first) - 1
    bounds = np.concatenate([[0], np.bincount(doc, weights=size + lead, minlength=n).cumsum()]).astype(np.int64)
    whole = pa.Array.from_buffers(pa.large_string(), n, [None, pa.py_buffer(bounds.tobytes()), pa.py_buffer(text.tobytes())])
    return whole.cast(pa.string())
