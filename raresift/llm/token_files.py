"""Token-id files: bit planes of fixed-size blocks, compressed plane by plane.

A file holds the ids of a run of documents in ascending id order.  Blocks of
``block_ids`` ids are transposed into planes (one per bit, or one per byte),
planes above the block's largest id are left out, and each plane is one
zstandard frame, so that a reader can fetch and decode any block by itself.

Layout (all integers little-endian):

    magic  RSPLANE1                         8 bytes
    blocks planes, one frame after another
    footer one zstandard frame of int64 arrays, each after its length:
           unit (1 bit, 8 byte) and block size;
           of each block: place, ids, planes;
           size of every plane; document ids; 1 for each id that isn't null;
           ids of each document
    length of the footer                    8 bytes
    magic  RSPLANE1                         8 bytes
"""

from __future__ import annotations

import posixpath
import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from raresift.llm._ship import ship
from raresift.llm._text import column, text_bytes, text_slices
from raresift.llm._tokens import encoder
from raresift.operators.persist import materialize
from raresift.session import scratch_path

MAGIC = b"RSPLANE1"
END_ID = 0
BLOCK_IDS = 1 << 16
FILE_BYTES = 16 << 20
LEVEL = 3

MANIFEST_SCHEMA = "file_no long, name string, n_docs long, n_ids long"
DOC_SCHEMA = "file_no long, doc_id long, before long, n_tokens long, ids_crc32 long"


def to_planes(ids: np.ndarray, unit: int) -> list[bytes]:
    """Planes of a block of ids, lowest first; unit 1 (bits) or 8 (bytes)."""
    most = int(ids.max()) if len(ids) else 0
    width = 1 if most < 1 << 8 else 2 if most < 1 << 16 else 4
    rows = ids.astype(f"<u{width}").view(np.uint8).reshape(len(ids), width)
    if unit == 8:
        return [np.ascontiguousarray(rows[:, i]).tobytes() for i in range(width)]
    bits = np.unpackbits(rows, axis=1, bitorder="little")[:, : max(1, most.bit_length())]
    return [p.tobytes() for p in np.packbits(np.ascontiguousarray(bits.T), axis=1, bitorder="little")]


def from_planes(planes: list[bytes], n: int, unit: int) -> np.ndarray:
    """The ids (uint32) that ``to_planes`` was given."""
    if unit == 8:
        rows = np.zeros((n, 4), np.uint8)
        for i, plane in enumerate(planes):
            rows[:, i] = np.frombuffer(plane, np.uint8)
    else:
        packed = np.frombuffer(b"".join(planes), np.uint8).reshape(len(planes), -1)
        bits = np.unpackbits(packed, axis=1, count=n, bitorder="little")
        few = np.packbits(np.ascontiguousarray(bits.T), axis=1, bitorder="little")
        rows = np.zeros((n, 4), np.uint8)
        rows[:, : few.shape[1]] = few
    return rows.reshape(-1).view("<u4")


class Writer:
    """Writes one file to an open binary stream, block by block."""

    def __init__(self, out, unit: int, block_ids: int):
        self.out, self.unit, self.block_ids = out, unit, block_ids
        self.press = zstandard.ZstdCompressor(level=LEVEL)
        self.blocks: list[tuple[int, int, int]] = []
        self.planes: list[int] = []
        self.docs: list[int | None] = []
        self.sizes: list[int] = []
        self.rest: list[np.ndarray] = []
        self.waiting = 0
        self.place = len(MAGIC)
        out.write(MAGIC)

    def add(self, doc_ids: list[int | None], sizes: list[int], ids: np.ndarray) -> None:
        """Documents in order: their ids end to end, and how many each has."""
        self.docs += doc_ids
        self.sizes += sizes
        self.rest.append(ids)
        self.waiting += len(ids)
        if self.waiting >= self.block_ids:
            full = np.concatenate(self.rest)
            done = len(full) - len(full) % self.block_ids
            for at in range(0, done, self.block_ids):
                self._block(full[at : at + self.block_ids])
            self.rest, self.waiting = [full[done:]], len(full) - done

    def _block(self, ids: np.ndarray) -> None:
        frames = [self.press.compress(p) for p in to_planes(ids, self.unit)]
        self.blocks.append((self.place, len(ids), len(frames)))
        for frame in frames:
            self.out.write(frame)
            self.planes.append(len(frame))
            self.place += len(frame)

    def close(self) -> None:
        if self.waiting:
            self._block(np.concatenate(self.rest))
        blocks = np.array(self.blocks, np.int64).reshape(-1, 3)
        arrays = [
            [self.unit, self.block_ids], *blocks.T, self.planes,
            [d or 0 for d in self.docs], [int(d is not None) for d in self.docs], self.sizes,
        ]
        parts = [np.asarray(a, "<i8") for a in arrays]
        footer = self.press.compress(b"".join(struct.pack("<q", len(p)) + p.tobytes() for p in parts))
        self.out.write(footer + struct.pack("<q", len(footer)) + MAGIC)


class Reader:
    """Reads a file's bytes: ``docs``, ``sizes``, and the ids of any block."""

    def __init__(self, raw: bytes):
        if raw[: len(MAGIC)] != MAGIC or raw[-len(MAGIC) :] != MAGIC:
            raise ValueError("not a token file, or cut off")
        (size,) = struct.unpack("<q", raw[-16:-8])
        self.raw, self.press = raw, zstandard.ZstdDecompressor()
        footer, at, arrays = self.press.decompress(raw[-16 - size : -16]), 0, []
        while at < len(footer):
            (n,) = struct.unpack_from("<q", footer, at)
            arrays.append(np.frombuffer(footer, "<i8", n, at + 8))
            at += 8 + 8 * n
        (self.unit, self.block_ids), self.place, self.n_ids, self.n_planes, self.plane_sizes, docs, valid, self.sizes = arrays
        self.docs = [int(d) if ok else None for d, ok in zip(docs, valid, strict=True)]
        self.first_plane = np.cumsum(self.n_planes) - self.n_planes

    def block(self, i: int) -> np.ndarray:
        at, planes = int(self.place[i]), []
        for size in self.plane_sizes[self.first_plane[i] : self.first_plane[i] + self.n_planes[i]].tolist():
            planes.append(self.press.decompress(self.raw[at : at + size]))
            at += size
        return from_planes(planes, int(self.n_ids[i]), int(self.unit))

    def ids(self) -> np.ndarray:
        return np.concatenate([self.block(i) for i in range(len(self.place))] or [np.zeros(0, np.uint32)])


def _open_folder(uri: str):
    """(file system, path) of a folder that all executors share."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri)


def write_token_files(
    docs: DataFrame,
    folder: str,
    tokenizer: str,
    unit: int = 1,
    block_ids: int = BLOCK_IDS,
    file_bytes: int = FILE_BYTES,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Write all documents' ids in ascending id order; return the manifest (one row per file).

    ``folder`` must be shared (the checkpoint folder, or any URI that
    pyarrow opens).  A task writes under a name of its own and renames the
    complete file, so a task that is lost and run again leaves no half file
    that the manifest names.  Null ids come first, equal ids in the order of
    their texts' hashes, null texts count as empty.
    """
    ship(docs.sparkSession)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    files = max(1, -(-total // file_bytes))
    order = ["doc_id", F.xxhash64("text")]
    ordered = rows.repartitionByRange(files, *order).sortWithinPartitions(*order)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId()
        name = f"ids-{number:07d}-{uuid.uuid4().hex[:12]}.planes"
        writer, out, n_ids = None, None, 0
        for batch in text_slices(batches, "text", 4 << 20):
            if writer is None:
                system, path = _open_folder(folder)
                system.create_dir(path, recursive=True)
                out = system.open_output_stream(posixpath.join(path, "." + name))
                writer = Writer(out, unit, block_ids)
            ids, offsets = encoder(tokenizer).encode(*text_bytes(column(batch, "text")))
            ended = np.insert(ids, offsets[1:], END_ID)
            writer.add(column(batch, "doc_id").to_pylist(), (np.diff(offsets) + 1).tolist(), ended)
            n_ids += len(ended)
        if writer is not None:
            writer.close()
            out.close()
            system.move(posixpath.join(path, "." + name), posixpath.join(path, name))
            yield pa.RecordBatch.from_pydict(
                {"file_no": [number], "name": [name], "n_docs": [len(writer.docs)], "n_ids": [n_ids]}
            )

    return materialize(ordered.mapInArrow(write, MANIFEST_SCHEMA), "token-manifest")


def read_token_files(manifest: DataFrame, folder: str) -> DataFrame:
    """Per document, from the files: doc_id, start, n_tokens, ids_crc32.

    ``start`` counts the ids of all documents before it.  Only files that the
    manifest names are read.
    """
    spark = ship(manifest.sparkSession)
    if manifest.isEmpty():
        return spark.createDataFrame([], "doc_id long, start long, n_tokens long, ids_crc32 long")
    ahead = Window.orderBy("file_no").rowsBetween(Window.unboundedPreceding, -1)
    starts = manifest.select("file_no", "name", F.coalesce(F.sum("n_ids").over(ahead), F.lit(0)).alias("ahead"))
    files = spark.read.format("binaryFile").option("pathGlobFilter", "ids-*.planes").load(folder)
    named = files.select(F.element_at(F.split("path", "/"), -1).alias("name"), "content")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, raw in zip(column(batch, "name").to_pylist(), column(batch, "content"), strict=True):
                reader = Reader(raw.as_buffer().to_pybytes())
                ids, ends = reader.ids(), np.cumsum(reader.sizes)
                before = ends - reader.sizes
                crc = [zlib.crc32(ids[a:b].tobytes()) for a, b in zip(before.tolist(), ends.tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([name] * len(ends), pa.string()),
                        pa.array(reader.docs, pa.int64()),
                        pa.array(before, pa.int64()),
                        pa.array(reader.sizes, pa.int64()),
                        pa.array(crc, pa.int64()),
                    ],
                    ["name", "doc_id", "before", "n_tokens", "ids_crc32"],
                )

    found = named.mapInArrow(read, "name string, doc_id long, before long, n_tokens long, ids_crc32 long")
    return found.join(starts, "name").select(
        "doc_id", (F.col("ahead") + F.col("before")).alias("start"), "n_tokens", "ids_crc32"
    )


def token_files_round_trip(docs: DataFrame, tokenizer: str, unit: int = 1) -> DataFrame:
    """Write ``docs`` to token files in the shared checkpoint folder and describe them from the files."""
    folder = scratch_path(docs.sparkSession, "token-files")
    if "://" not in folder and folder.startswith("file:"):
        folder = "file://" + folder.removeprefix("file:")
    return read_token_files(write_token_files(docs, folder, tokenizer, unit), folder)
