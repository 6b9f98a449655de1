"""Exact substring deduplication with suffix arrays of shards.

Each shard's suffixes are sorted to the length that counts
(Larsson-Sadakane), and Kasai's rule gives the common prefixes of equal
neighbours: windows that start earlier in the same shard.  Across shards,
sorted lists of sampled suffix keys are merged by binary search:

1. Every window of ``length`` bytes has a key, the smallest hash of the
   32-byte strings inside it.  Shards exchange their distinct keys; only
   windows whose key another shard holds stay open.
2. Neighbouring open windows with one key make a piece.  Shards exchange
   (key, hash of the piece's text, smallest document), one record for each
   key: equal pieces belong to the earliest document, and keys with one piece
   are settled.  A shard that holds different pieces with a key says only that.
3. Windows of pieces that share a key with a different piece go through step 2
   again with keys of longer strings, at last of the whole window.  A shard
   holds a window once by then, so a string in any number of documents costs
   one record a shard at every length, and what different documents have
   round a short string they share spreads over all buckets.

Texts stay where they are.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from raresift.llm._shards import (
    BUCKET_BYTES, MESSAGE_SCHEMA, OWN, ShardRow, ShardStore, answered_keys, exchange, merged, message, messages, repeated_keys, runs_of,
    shard_rows, to_senders, within,
)
from raresift.llm._suffix import common_prefixes, pack_bytes, suffix_array
from raresift.llm._text import MIX_A, Windows, mix, slide, window_starts
from raresift.operators.persist import materialize

LENGTH = 100
SAMPLE = 32

RESULT_SCHEMA = "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary"
#: Keys of every byte's windows, as a share of the bytes.
DENSITY = 0.03
#: The bucket of a shard's number of open windows.
OPEN = -2
#: Key, hash, document and mark of a piece.
PIECE_BYTES = 25

_BYTE_IDS = mix(np.arange(1, 257, dtype=np.uint64) * MIX_A)


def _windows(row: ShardRow, length: int) -> tuple[Windows, np.ndarray, np.ndarray]:
    """(byte hashes, key of every window, mask of the windows that stay in their document)."""
    hashes = Windows(_BYTE_IDS[row.data])
    keys = slide(hashes.of(SAMPLE), length - SAMPLE + 1, np.minimum) if len(row.data) >= length else np.zeros(0, np.uint64)
    valid = window_starts(row.offsets, length)[: len(keys)]
    return hashes, keys, valid


def _order_ids(row: ShardRow) -> np.ndarray:
    """Each document's id as a number that sorts like it; null ids come first."""
    others = row.others()
    ids = others.column(others.schema.get_field_index("doc_id"))
    return ids.fill_null(np.iinfo(np.int64).min).to_numpy(zero_copy_only=False).astype(np.int64)


def local_repeats(data: np.ndarray, offsets: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, earlier starts, lengths) of the strings of ``length`` bytes or more that start earlier in the shard."""
    order, rank = suffix_array(pack_bytes(data), 8, length)
    ends = np.repeat(offsets[1:], np.diff(offsets))
    return common_prefixes(data, order, rank, ends, length)


def _dedup(docs: DataFrame, length: int, task, schema: str | StructType) -> DataFrame:
    if length <= SAMPLE:
        raise ValueError(f"length must be over {SAMPLE}")
    store = ShardStore.write(docs, "doc_id")
    with store.joins():
        buckets = store.buckets(9 * DENSITY)
        sent = store.read().mapInArrow(_send_keys(length, buckets), MESSAGE_SCHEMA)
        answers = exchange(sent, repeated_keys)
        shards = store.answered(answers)
        pieces = materialize(shards.mapInArrow(_send_pieces(length, buckets), MESSAGE_SCHEMA), "pieces")
        tables = [pieces]
        for sample in _samples(length)[1:]:
            counted = pieces.filter(F.col("bucket") == OPEN).agg(F.sum(F.col("payload").cast("string").cast("long"))).first()[0]
            buckets = max(1, int((counted or 0) * PIECE_BYTES * min(1, 2 / (length - sample + 2))) // BUCKET_BYTES)
            pieces = materialize(_settled(store, pieces).mapInArrow(_send_longer(length, sample, buckets), MESSAGE_SCHEMA), "pieces")
            tables.append(pieces)
        result = materialize(_settled(store, pieces).mapInArrow(task, schema), "kept")
    store.drop(*tables)
    return result


def _samples(length: int) -> list[int]:
    """Lengths of the strings whose least hash is a window's key, step by step."""
    return sorted({SAMPLE, length - (length - SAMPLE) // 2, length - (length - SAMPLE) // 6, length})


def _settled(store: ShardStore, pieces: DataFrame) -> DataFrame:
    sent = pieces.filter(F.col("bucket") != OPEN)
    return store.answered(exchange(sent, _settle_pieces), sent)


def _send_keys(length: int, buckets: int):
    """Level 1: the distinct keys of a shard."""

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in shard_rows(batches):
            _, keys, valid = _windows(row, length)
            keys = np.sort(mix(_distinct(keys[valid])))
            yield message(row, keys, [np.zeros(len(keys), np.uint8)], buckets)[0]

    return send


def _distinct(keys: np.ndarray) -> np.ndarray:
    """Distinct keys; neighbours are mostly equal, so those go first."""
    if not len(keys):
        return keys
    return np.unique(keys[np.concatenate([[True], keys[1:] != keys[:-1]])])


def _send_pieces(length: int, buckets: int):
    """Level 2: drop windows that start earlier in the shard, and send the open pieces.

    For itself the shard keeps where its removed strings and its pieces lie.
    """

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in shard_rows(batches):
            hashes, keys, valid = _windows(row, length)
            at, _, shared = local_repeats(row.data, row.offsets, length)
            repeated = np.zeros(len(keys), bool)
            repeated[at] = True  # every window of a shared string is tied itself
            open_ = np.flatnonzero(valid & ~repeated)
            mixed = mix(keys[open_])
            # equal neighbours are looked up once
            new = np.concatenate([[True], mixed[1:] != mixed[:-1]]) if len(mixed) else np.zeros(0, bool)
            known = within(mixed[new], answered_keys(row.answers))
            kept = known[np.cumsum(new) - 1] if len(mixed) else np.zeros(0, bool)
            open_, mixed = open_[kept], mixed[kept]
            yield from _pieces(row, hashes, length, _marked(len(row.data), at, shared), open_, open_, mixed, None, buckets)

    return send


def _pieces(
    row: ShardRow, hashes: Windows, length: int, gone: np.ndarray, open_: np.ndarray, place: np.ndarray, mixed: np.ndarray,
    keys: np.ndarray | None, buckets: int,
) -> Iterator[pa.RecordBatch]:
    """Messages about the pieces of the open windows.

    ``place`` says where ``hashes`` hold each open window; ``keys``, one for
    each, stand for the texts of single windows.
    """
    doc = np.searchsorted(row.offsets, open_, side="right") - 1
    begins = np.ones(len(open_), bool)
    begins[1:] = (open_[1:] != open_[:-1] + 1) | (mixed[1:] != mixed[:-1]) | (doc[1:] != doc[:-1])
    begins = np.flatnonzero(begins)
    start = open_[begins]
    count = np.diff(np.append(begins, len(open_)))
    key, ids = mixed[begins], _order_ids(row)[doc[begins]]
    text = hashes.spans(place[begins], place[begins] + count + length - 1) if keys is None else keys[begins]
    by = np.argsort(key, kind="stable")
    # pieces of one shard with one key differ
    lead, many = _key_runs(key[by])
    batch, cuts = message(row, key[by][lead], [text[by][lead], ids[by][lead], (many > 1).astype(np.uint8)], buckets)
    yield batch
    own = _pack([*runs_of(gone), start[by], count[by], cuts, key[by].view(np.int64)])
    yield messages(row, np.array([OWN, OPEN]), [own, str(len(open_)).encode()])


def _key_runs(key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(begins, sizes) of the runs of equal keys."""
    begins = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.zeros(0, np.int64)
    return begins, np.diff(np.append(begins, len(key)))


def _settle_pieces(payloads: list[bytes]) -> list[bytes]:
    """Of each key's piece: 2 if an equal one comes earlier, 1 if it is first of several kinds with its key, else 0.

    A sender that holds several kinds itself gets 1 for all of them.
    """
    sender, (key, text, ids, many) = merged(payloads, ["<u8", "<u8", "<i8", "u1"])
    by = np.lexsort((sender, ids, text, many, key))
    several = many[by] > 0
    key_new = np.concatenate([[True], key[by][1:] != key[by][:-1]])
    text_new = key_new | several | np.concatenate([[True], text[by][1:] != text[by][:-1]])
    group = np.cumsum(key_new) - 1
    kinds = np.bincount(group[text_new])
    status = np.empty(len(key), np.uint8)
    status[by] = np.where(~text_new, 2, np.where(several | (kinds[group] > 1), 1, 0))
    return to_senders(sender, len(payloads), [status])


def _open(row: ShardRow, length: int) -> tuple[np.ndarray, np.ndarray]:
    """(mask of the bytes to remove, windows still open) by what the last step settled."""
    gone_start, gone_end, start, count, cuts, key = _unpack(row.own)
    _, many = _key_runs(key)
    status = np.zeros(len(many), np.uint8)
    for answer in row.answers:
        bucket = struct.unpack_from("<q", answer)[0]
        status[cuts[bucket] : cuts[bucket + 1]] = np.frombuffer(answer, np.uint8, offset=8)
    status = np.repeat(status, many)
    first, left = status == 2, status == 1
    gone = _marked(len(row.data), gone_start, gone_end - gone_start)
    gone |= _marked(len(row.data), start[first], count[first] + length - 1)
    start, count = start[left], count[left]
    return gone, np.sort(np.arange(int(count.sum())) + np.repeat(start - (np.cumsum(count) - count), count))


def _open_bytes(row: ShardRow, open_: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """(bytes of the open windows end to end, where each window lies in them)."""
    if not len(open_):
        return row.data[:0], open_
    begins = np.flatnonzero(np.concatenate([[True], open_[1:] > open_[:-1] + length]))
    start, last = open_[begins], open_[np.append(begins[1:], len(open_)) - 1]
    size = last + length - start
    base = np.cumsum(size) - size
    data = row.data[np.arange(int(size.sum())) + np.repeat(start - base, size)]
    return data, open_ - np.repeat(start - base, np.diff(np.append(begins, len(open_))))


def _send_longer(length: int, sample: int, buckets: int):
    """Level 3: the pieces of the windows that aren't settled, by keys of ``sample`` bytes; only their bytes are hashed."""

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in shard_rows(batches):
            gone, open_ = _open(row, length)
            data, place = _open_bytes(row, open_, length)
            hashes = Windows(_BYTE_IDS[data])
            none = np.zeros(0, np.uint64)

            def keys(width: int) -> np.ndarray:
                return slide(hashes.of(width), length - width + 1, np.minimum)[place] if len(place) else none

            yield from _pieces(row, hashes, length, gone, open_, place, mix(keys(sample)), keys(SAMPLE) if sample == length else None, buckets)

    return send


def _marked(n: int, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Mask over n bytes: those inside [start, start + size) of any run."""
    step = np.bincount(starts, minlength=n + 1)[: n + 1] - np.bincount(starts + sizes, minlength=n + 1)[: n + 1]
    return np.cumsum(step)[:n] > 0


def _pack(arrays: list[np.ndarray]) -> bytes:
    """Arrays of bytes or integers, each after its kind and length."""
    out = []
    for a in arrays:
        a = np.asarray(a)
        kind = a.dtype if a.dtype == np.uint8 else np.dtype("<i8") if a.size and abs(a).max() >= 1 << 31 else np.dtype("<i4")
        out += [struct.pack("<BQ", kind.itemsize, len(a)), a.astype(kind).tobytes()]
    return b"".join(out)


def _unpack(raw: bytes) -> list[np.ndarray]:
    at, out = 0, []
    while at < len(raw):
        size, n = struct.unpack_from("<BQ", raw, at)
        kind = {1: "u1", 4: "<i4", 8: "<i8"}[size]
        a = np.frombuffer(raw, kind, n, at + 9)
        out.append(a if size == 1 else a.astype(np.int64))
        at += 9 + n * size
    return out


def remove_repeated_strings(
    docs: DataFrame, length: int = LENGTH, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Per document: doc_id, n_bytes, n_removed, n_spans and kept (the bytes left, which may split a character).

    A byte is removed if it lies in a string of ``length`` bytes that also
    starts earlier: in a document with a smaller id, or in the same one.
    Strings are judged on the input and never cross documents.  Null texts
    are empty.  Null ids come before all others.  Rows that share an id are
    in the order of their shard and of their texts' hashes, so of repeated
    rows one keeps its text.  Columns beyond the two are left out.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in shard_rows(batches):
            gone, _ = _open(row, length)
            others, offsets = row.others(), row.offsets
            edge = np.zeros(len(gone) + 1, bool)
            edge[offsets] = True
            start = gone & ~np.concatenate([[False], gone[:-1]]) | gone & edge[:-1]
            kept, whole = ~gone, np.concatenate([[0], np.cumsum(~gone)])[offsets]
            removed = np.diff(offsets) - np.diff(whole)
            spans = np.diff(np.concatenate([[0], np.cumsum(start)])[offsets])
            raw = row.data[kept].tobytes()
            yield pa.RecordBatch.from_arrays(
                [
                    others.column(others.schema.get_field_index("doc_id")),
                    pa.array(np.diff(offsets), pa.int64()),
                    pa.array(removed, pa.int64()),
                    pa.array(spans, pa.int64()),
                    pa.array([raw[a:b] for a, b in zip(whole.tolist(), whole[1:].tolist())], pa.binary()),
                ],
                ["doc_id", "n_bytes", "n_removed", "n_spans", "kept"],
            )

    return _dedup(rows, length, cut, RESULT_SCHEMA)


def rewrite_without_repeats(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """``docs`` (doc_id, text and any columns) with the repeated strings cut from their texts.

    As ``remove_repeated_strings``, but a character goes only if all its bytes
    do, so texts stay valid.  A null text stays null; ``n_chars``, if there, is
    counted again.  All rows stay, emptied ones too.
    """
    schema = docs.schema

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in shard_rows(batches):
            gone, _ = _open(row, length)
            lead = np.flatnonzero((row.data & 0xC0) != 0x80)
            if len(lead):
                gone = np.repeat(np.minimum.reduceat(gone.astype(np.uint8), lead) > 0, np.diff(np.append(lead, len(gone))))
            whole = np.concatenate([[0], np.cumsum(~gone)])[row.offsets]
            raw = row.data[~gone].tobytes()
            others = row.others()
            nulls = others.column(others.num_columns - 1).to_pylist()
            texts = [None if null else raw[a:b].decode() for null, a, b in zip(nulls, whole.tolist(), whole[1:].tolist())]
            arrays = []
            for field in schema:
                if field.name == "text":
                    arrays.append(pa.array(texts, pa.string()))
                    continue
                col = others.column(others.schema.get_field_index(field.name))
                if field.name == "n_chars":
                    col = pa.array([None if t is None else len(t) for t in texts], pa.int64()).cast(col.type)
                arrays.append(col)
            yield pa.RecordBatch.from_arrays(arrays, schema.names)

    return _dedup(docs, length, cut, schema)
