"""Near-duplicate embeddings: spherical k-means cells and blocked cosine products.

Equal vectors of a label are one class from the start, known by a 128-bit
digest of their numbers.  Every vector has a home cell, its nearest centroid,
and may be a guest in each other cell whose vectors may lie within the link
angle: for a link of distance r, a vector of cell c is at most
r * |mu_c - mu_h| on the far side of the plane between c and the home h.  Of
two cells one sends its guests to the other, so a link is found once and
counted for both.  Centroids come from a bounded sample of the classes; how
many deal the vectors to tasks, and how many order them inside a task, is what
costs least for others of the sample.  Cells go to their tasks in rounds of
bounded size, as packs of vectors; large ones are cut into blocks.  A task
compares one block of home vectors with itself or another block, first by
their leading directions, and returns counts and a spanning forest, never the
pairs.
"""

from __future__ import annotations

import gc
import hashlib
import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, FloatType, MapType, StructType

from raresift.llm._components import components
from raresift.llm._ship import ship
from raresift.llm._text import column
from raresift.operators.persist import discard, materialize, scratch_scope

THRESHOLD = 0.98
#: Vectors that the centroids of a length are fitted on, about, and numbers in them; others that they are judged by.
SAMPLE, SAMPLE_VALUES, PROBE = 20_000, 4_000_000, 1000
#: Numbers of cells to deal by and to order by inside a task; each has so many sampled vectors at least.
CELLS, NEAR_CELLS, CELL_SAMPLE = (64, 256, 1024, 4096), (64, 256, 1024), 4
#: Directions to compare by first, the share of a sample's pairs that may pass without a link, and the longest vectors to find them for.
LEADING, LEADING_SHARE, LEADING_DIM = (16, 32, 64, 128), 1e-5, 2048
#: Cost in ns of comparing two vectors by all of 64 numbers or a quarter, of a vector with a centroid, of placing a row in a cell, of dealing one.
PAIR_NS, LEADING_NS, DOT_NS, GATHER_NS, COPY_NS = 2.6, 1.3, 4.5, 50, 1500
#: Rows of a label, of 64 numbers each, that are worth a sample.
PLAN_ROWS = 8192
ROUNDS = 8
#: Numbers in the vectors of a block, and in a slice that a task works on.
BLOCK_VALUES, SLICE_VALUES = 1 << 22, 1 << 20
#: Vectors that get their cells at a time; vectors and guests that are dealt or placed at a time.
PLACE_ROWS, PART_GUESTS = 4096, 1 << 18
#: Vectors that travel in one row, and bytes of such rows in a batch.
PACK_ROWS, BATCH_BYTES = 1024, 4 << 20
#: Bytes that a round deals, or as many as the classes have; rounds whose links are read together.
ROUND_BYTES, MOST_FOUND = 256 << 20, 32
#: Numbers of a product that are held at a time; rows that are ordered by cells at a time, and their homes and guests.
TILE, NEAR_ROWS, NEAR_VISITS = 1 << 22, 1 << 14, 1 << 21
#: The band in which a cosine is computed again, with more digits.
SLACK = 1e-9


@dataclass
class Plan:
    """How vectors of one length are compared: centroids to deal by, to order by inside a task, and their leading directions."""

    cells: np.ndarray | None = None
    near: np.ndarray | None = None
    leading: np.ndarray | None = None


def unit(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(axis=1, keepdims=True)  # squares neither overflow nor vanish
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def unit32(x: np.ndarray) -> np.ndarray:
    """``unit`` in single precision, slice by slice."""
    out = np.empty(x.shape, np.float32)
    step = max(1, SLICE_VALUES // max(1, x.shape[1]) // 4)
    for at in range(0, len(x), step):
        out[at : at + step] = unit(x[at : at + step].astype(np.float64))
    return out


def _slack32(dim: int) -> float:
    """More than products of unit vectors in single precision are off."""
    return (dim + 16) * 2.0**-22


def _homes(x: np.ndarray, centers: np.ndarray) -> np.ndarray:
    step = max(1, TILE // 2 // len(centers))
    return np.concatenate([np.zeros(0, np.int64), *(np.argmax(x[at : at + step] @ centers.T, axis=1) for at in range(0, len(x), step))])


def spherical_kmeans(x: np.ndarray, cells: int, rounds: int = ROUNDS) -> np.ndarray:
    """Unit centroids of the rows of x (unit vectors, in a fixed order)."""
    centers = x[np.linspace(0, len(x) - 1, min(cells, len(x))).astype(int)].copy()
    for _ in range(rounds):
        home = _homes(x, centers)
        sums = np.zeros(centers.shape)
        np.add.at(sums, home, x)
        size = np.sqrt((sums * sums).sum(axis=1))
        moved = size > 1e-12
        centers[moved] = sums[moved] / size[moved, None]
    return np.unique(centers, axis=0)


def shortfall(centers: np.ndarray, threshold: float) -> np.ndarray:
    """How far a guest's product with the second centroid may fall short of that with its home, the first."""
    apart = centers @ centers.T
    apart *= -2
    apart += 2 + 2 * _slack32(centers.shape[1])  # a distance rounded down would lose links
    np.sqrt(np.maximum(apart, 0, out=apart), out=apart)
    apart *= math.sqrt(max(0.0, 2 - 2 * threshold))
    return apart


def cells_of(
    x: np.ndarray, centers: np.ndarray, threshold: float, short: np.ndarray | None = None
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(home of every row; row and cell of every guest), by rows few enough for a bounded product; short: what ``shortfall`` gives."""
    x, centers = x.astype(np.float32, copy=False), centers.astype(np.float32, copy=False)
    short, slack = shortfall(centers, threshold) if short is None else short, _slack32(x.shape[1])
    step = max(1, TILE // 2 // len(centers))
    homes, rows, cells = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for at in range(0, len(x), step):
        dots = x[at : at + step] @ centers.T
        every = np.arange(len(dots))
        home = np.argmax(dots, axis=1)
        least = dots[every, home] - slack
        dots += short[home]
        near = dots >= least[:, None]
        near[every, home] = False
        row, cell = np.nonzero(near)
        homes.append(home)
        rows.append(row + at)
        cells.append(cell)
    return np.concatenate(homes), np.concatenate(rows), np.concatenate(cells)


def _sent(home: np.ndarray, cell: np.ndarray) -> np.ndarray:
    """Mask of the guests that go to the other cell; for two cells, those of one of them."""
    return ((home + cell) % 2 == 0) == (home < cell)


def linked(x: np.ndarray, y: np.ndarray, threshold: float) -> np.ndarray:
    """Mask of the rows k for which x[k] and y[k] have a cosine of at least the threshold."""
    out = np.zeros(len(x), bool)
    step = max(1, SLICE_VALUES // max(1, x.shape[1]) // 4)
    for at in range(0, len(x), step):
        a, b = unit(x[at : at + step].astype(np.float64)), unit(y[at : at + step].astype(np.float64))
        cos = np.einsum("ij,ij->i", a, b)
        out[at : at + step] = cos >= threshold
        for k in np.flatnonzero(np.abs(cos - threshold) < SLACK).tolist():
            p, q = a[k].astype(np.longdouble), b[k].astype(np.longdouble)
            out[at + k] = (p * q).sum() / np.sqrt((p * p).sum() * (q * q).sum()) >= threshold
    return out


def near_duplicate_vectors(
    vectors: DataFrame,
    threshold: float = THRESHOLD,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
) -> DataFrame:
    """Per vector: vec_id, n_links, component_id (smallest id reachable by links), kept.

    Vectors are linked if their labels and lengths are equal and their cosine,
    in double precision, is ``threshold`` or more.  Vectors that are null,
    empty or zero, or hold null or non-finite components, and those without a
    label, have no links.  Equal vectors are linked; every row counts, so
    repeated rows are links of each other; rows that share an id share a
    component.  A null id is in no component and kept.  Columns beyond the
    three are left out.
    """
    spark = ship(vectors.sparkSession)
    kind, label = vectors.schema[vector_col].dataType, F.col(label_col)
    single = isinstance(kind, ArrayType) and isinstance(kind.elementType, FloatType)
    if isinstance(vectors.schema[label_col].dataType, ArrayType | MapType | StructType):  # Arrow doesn't compare these
        label = F.when(label.isNotNull(), F.to_json(F.struct(label)))
    rows = vectors.select(
        F.col(id_col).cast("long").alias("vec_id"),
        label.alias("label"),
        F.col(vector_col).cast("array<float>" if single else "array<double>").alias("vector"),
    )
    label_type = rows.schema["label"].dataType.simpleString()
    with scratch_scope(spark) as scratch:
        known = _packed(rows, label_type, whole=True).filter("vector IS NOT NULL")
        classes = materialize(
            known.groupBy("label", "dim", "key", "vector").agg(F.min("vec_id").alias("rep"), F.count("*").alias("copies")), "vector-classes"
        )
        _freed(spark)
        plans = _plans(classes, threshold)
        placed = classes.withColumns({"home": F.lit(0), "guests": F.lit(b"")})
        if any(plan.cells is not None for plan in plans.values()):
            placed = materialize(_placed(classes, label_type, plans, threshold), "vector-cells")
            discard(classes)
            _freed(spark)
        found = _found(placed, label_type, plans, threshold, 4 if single else 8)
        # a class's own copies are links of each other
        counted = found.filter("key IS NOT NULL").groupBy("label", "key").agg(F.sum("links").alias("links"))
        labels = components(found.filter("a IS NOT NULL").select("a", "b"))
        own = placed.select("label", "key", "rep", "copies")
        named = own.join(counted, ["label", "key"], "left").join(labels, F.col("rep") == F.col("node"), "left")
        named = scratch.result(
            named.select(
                "label",
                "key",
                (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("links"),
                F.coalesce("component", "rep").alias("component"),
            ),
            "vector-names",
        )
    _freed(spark)
    out = _packed(rows, label_type, whole=False).join(named, ["label", "key"], "left")
    return out.select(
        "vec_id",
        F.coalesce("links", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("component", "vec_id").alias("component_id"),
        F.coalesce(F.col("vec_id") == F.coalesce("component", "vec_id"), F.lit(True)).alias("kept"),
    )


def _freed(spark: SparkSession) -> None:
    """Has Spark delete the shuffle files of what was written; else they stay until the driver collects its garbage."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def _packed(rows: DataFrame, label_type: str, whole: bool) -> DataFrame:
    """The rows with ``key``, 128 bits that equal vectors share; ``whole``: with ``dim`` and the numbers, single ones if exact.

    Vectors without links have no dim and vector, and a key of 8 bytes, which no other has.
    """

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = 0
        for batch in batches:
            lengths = pc.fill_null(pc.list_value_length(column(batch, "vector")), 0).to_numpy().astype(np.int64)
            ends = np.cumsum(lengths)
            at = 0
            while at < batch.num_rows:
                done = ends[at - 1] if at else 0
                to = max(at + 1, int(np.searchsorted(ends, done + SLICE_VALUES, side="right")))
                yield packed(batch.slice(at, to - at), lengths[at:to], seen + at)
                at = to
            seen += batch.num_rows

    def packed(part: pa.RecordBatch, lengths: np.ndarray, seen: int) -> pa.RecordBatch:
        values = column(part, "vector").flatten()
        x = pc.fill_null(values, float("nan")).to_numpy(zero_copy_only=False).astype(np.float64) + 0.0  # no negative zeros
        ends = np.cumsum(lengths)
        starts = ends - lengths

        def of(mask: np.ndarray) -> np.ndarray:
            sums = np.concatenate([[0], np.cumsum(mask)])
            return sums[ends] - sums[starts]

        with np.errstate(over="ignore", invalid="ignore"):
            wide = of(x.astype(np.float32) != x) > 0
        good = (of(~np.isfinite(x)) == 0) & (of(x != 0) > 0)
        for name in ("vec_id", "label"):
            good &= column(part, name).is_valid().to_numpy(zero_copy_only=False)
        n = part.num_rows
        keys, raw = [(seen + k).to_bytes(8, "little") for k in range(n)], [None] * n
        for dim, twice in np.unique(np.stack([lengths[good], wide[good]]), axis=1).T.tolist():
            mine = np.flatnonzero(good & (lengths == dim) & (wide == twice))
            body = x[starts[mine][:, None] + np.arange(dim)].astype("<f8" if twice else "<f4").tobytes()
            size, salt = dim * (8 if twice else 4), dim.to_bytes(8, "little")
            for k, row in enumerate(mine.tolist()):
                some = body[k * size : (k + 1) * size]
                keys[row] = hashlib.blake2b(some, digest_size=16, salt=salt).digest()
                if whole:
                    raw[row] = some
        arrays = {"vec_id": column(part, "vec_id"), "label": column(part, "label"), "key": pa.array(keys, pa.binary())}
        if whole:
            arrays |= {"dim": pa.array(lengths.astype(np.int32), mask=~good), "vector": pa.array(raw, pa.binary())}
        return pa.RecordBatch.from_arrays(list(arrays.values()), list(arrays))

    return rows.mapInArrow(pack, f"vec_id long, label {label_type}, key binary" + ", dim int, vector binary" * whole)


def _groups(batch: pa.RecordBatch, most: int = SLICE_VALUES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(dim, bytes of a number, rows, their numbers) of each slice of a batch with vectors of one kind."""
    dims, vectors = column(batch, "dim").to_numpy().astype(np.int64), column(batch, "vector")
    kinds = (dims << 32) + pc.binary_length(vectors).to_numpy()
    for kind in np.unique(kinds).tolist() if len(kinds) and kinds.min() < kinds.max() else kinds[:1].tolist():
        mine = np.flatnonzero(kinds == kind)
        dim, size = kind >> 32, kind & (1 << 32) - 1
        step = min(most, max(1, SLICE_VALUES // dim))
        for at in range(0, len(mine), step):
            some = mine[at : at + step]
            yield dim, size // dim, some, _flat(vectors.take(pa.array(some))).view(f"<f{size // dim}").reshape(-1, dim)


def _flat(col: pa.Array) -> np.ndarray:
    """The bytes of all values, none of them null, end to end."""
    if not len(col):
        return np.zeros(0, np.uint8)
    ends = np.frombuffer(col.buffers()[1], np.int32)[col.offset : col.offset + len(col) + 1]
    return np.frombuffer(col.buffers()[2] or b"", np.uint8)[ends[0] : ends[-1]]


def _placed(classes: DataFrame, label_type: str, plans: dict[int, Plan], threshold: float) -> DataFrame:
    """The classes with their home and the cells they are sent to as guests (packed), labels and homes together."""

    centers = {dim: plan.cells for dim, plan in plans.items() if plan.cells is not None}

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        short: dict[int, np.ndarray] = {}
        for batch in batches:
            for dim, _, some, x in _groups(batch, PLACE_ROWS):
                home, guests = np.zeros(len(some), np.int32), [b""] * len(some)
                if dim in centers:
                    if dim not in short:
                        short = {dim: shortfall(centers[dim], threshold)}  # one at a time, they are large
                    home, row, cell = cells_of(unit32(x), centers[dim], threshold, short[dim])
                    sent = _sent(home[row], cell)
                    row, cell = row[sent], cell[sent].astype("<u2")
                    ends = np.cumsum(np.bincount(row, minlength=len(some))).tolist()
                    guests = [cell[a:b].tobytes() for a, b in zip([0, *ends], ends, strict=False)]
                part = batch.take(pa.array(some))
                arrays = [column(part, c) for c in ("label", "dim", "key", "vector", "rep", "copies")]
                arrays += [pa.array(home.astype(np.int32)), pa.array(guests, pa.binary())]
                yield pa.RecordBatch.from_arrays(arrays, ["label", "dim", "key", "vector", "rep", "copies", "home", "guests"])

    schema = f"label {label_type}, dim int, key binary, vector binary, rep long, copies long, home int, guests binary"
    return classes.mapInArrow(place, schema).sortWithinPartitions("label", "dim", "home")


def _parts(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """The batch cut into parts of few rows and guests."""
    ends = np.cumsum(pc.binary_length(column(batch, "guests")).to_numpy().astype(np.int64) // 2 + 1)
    at = 0
    while at < batch.num_rows:
        to = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + PART_GUESTS, side="right")))
        yield batch.slice(at, to - at)
        at = to


def _guests(cells: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(row, cell) of the packed cells."""
    counts = pc.binary_length(cells).to_numpy() // 2
    return np.repeat(np.arange(len(cells)), counts), _flat(cells).view("<u2").astype(np.int64)


def _plan_key(mark: np.ndarray, dim: int, cell: np.ndarray) -> np.ndarray:
    """64 bits of a label's cell; where two share them, they are only cut alike."""
    mixed = mark.astype(np.int64).view(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + cell.astype(np.uint64) * np.uint64(0xBF58476D1CE4E5B9)
    return mixed + np.uint64(dim * 0x94D049BB133111EB & (1 << 64) - 1)


def _found(placed: DataFrame, label_type: str, plans: dict[int, Plan], threshold: float, width: int) -> DataFrame:
    """Rows of (label, key, links) and of (a, b): links of classes with others, and few (rep, rep) that connect whatever they connect."""
    placed = placed.withColumn("mark", F.xxhash64("label"))
    spark, block_values, pack_rows = placed.sparkSession, BLOCK_VALUES, PACK_ROWS
    inside = {dim: Plan(near=plan.near, leading=plan.leading) for dim, plan in plans.items()}

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part for whole in batches for part in _parts(whole)):
            row, cell = _guests(column(batch, "guests"))
            marks, dims, homes = (column(batch, c).to_numpy().astype(np.int64) for c in ("mark", "dim", "home"))
            keys = np.stack([np.concatenate([marks, marks[row]]), np.concatenate([dims, dims[row]]), np.concatenate([homes, cell])])
            guest = np.arange(keys.shape[1]) >= len(marks)
            order = np.lexsort(keys[::-1])
            keys, guest = keys[:, order], guest[order]
            starts = np.flatnonzero(np.concatenate([[True], (keys[:, 1:] != keys[:, :-1]).any(axis=0)]))
            guests = np.add.reduceat(guest.astype(np.int64), starts)
            both = np.diff(np.append(starts, len(guest)))
            arrays = [keys[0][starts], keys[1][starts].astype(np.int32), keys[2][starts].astype(np.int32), both - guests, guests]
            yield pa.RecordBatch.from_arrays([pa.array(a) for a in arrays], ["mark", "dim", "cell", "homes", "guests"])

    by_cells = any(plan.cells is not None for plan in plans.values())
    if by_cells:
        sizes = placed.select("mark", "dim", "home", "guests").mapInArrow(count, "mark long, dim int, cell int, homes long, guests long")
        sizes = sizes.groupBy("mark", "dim", "cell").agg(F.sum("homes").alias("homes"), F.sum("guests").alias("guests"))
    else:
        sizes = placed.groupBy("mark", "dim", F.col("home").alias("cell")).agg(F.count("*").alias("homes"))
        sizes = sizes.withColumn("guests", F.lit(0).cast("long"))
    block = F.greatest(F.lit(1), F.floor(F.lit(block_values) / F.col("dim")))
    sizes = materialize(
        sizes.withColumn("nb", F.greatest(F.lit(1), F.ceil(F.col("homes") / block)))
        .withColumn("gb", F.greatest(F.lit(int(by_cells)), F.ceil(F.col("guests") / block)))  # none without guests
        .withColumn("large", F.col("homes") + F.col("guests") > block),
        "vector-sizes",
    )
    dealt = F.when(F.col("large"), F.expr("homes * (nb + gb) + guests * nb")).otherwise(F.expr("homes + guests"))
    heavy = F.col("dim") * width + 32
    to_deal, at_rest = sizes.agg(F.sum(dealt.cast("double") * heavy), F.sum(F.col("homes") * heavy.cast("double"))).first()
    rounds = max(1, math.ceil((to_deal or 0) / max(ROUND_BYTES, at_rest or 0)))
    large = sizes.filter("large").select("mark", "dim", "cell", "nb", "gb").collect()
    plan = np.array(
        sorted((int(_plan_key(np.array([r.mark]), r.dim, np.array([r.cell]))[0]), r.nb, r.gb) for r in large), np.uint64
    ).reshape(-1, 3)
    plan_keys, plan_blocks = np.ascontiguousarray(plan[:, 0]), plan[:, 1:].astype(np.int64)

    def tasks_of(b: int, nb: int, gb: int, guest: bool) -> Iterator[tuple[int, int]]:
        if guest:
            yield from ((i, b) for i in range(nb))
        else:
            yield from ((b, j) for j in range(b, nb + gb))
            yield from ((i, b) for i in range(b))

    def turn(place: np.ndarray, i: int = 0, j: int = 0) -> np.ndarray:
        """The round of a task, drawn from its label, cell and blocks."""
        mixed = (place ^ place >> np.uint64(32)) + np.uint64((i * 0x85EBCA77 + j * 0xC2B2AE3D) * 0x9E3779B97F4A7C15 & (1 << 64) - 1)
        mixed = (mixed ^ mixed >> np.uint64(29)) * np.uint64(0xBF58476D1CE4E5B9)
        return (mixed >> np.uint64(32)) % np.uint64(rounds)

    def dealer(now: int):
        def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in (part for whole in batches for part in _parts(whole)):
                for dim, width, some, x in _groups(batch):
                    yield from packs(batch.take(pa.array(some)), dim, width, x)

        def packs(part: pa.RecordBatch, dim: int, width: int, x: np.ndarray) -> Iterator[pa.RecordBatch]:
            labels = column(part, "label")
            codes = labels.dictionary_encode().indices.to_numpy().astype(np.int64)
            marks, homes = column(part, "mark").to_numpy(), column(part, "home").to_numpy().astype(np.int64)
            guest_row, guest_cell = _guests(column(part, "guests"))
            row, cell = np.concatenate([np.arange(len(x)), guest_row]), np.concatenate([homes, guest_cell])
            guest = np.arange(len(row)) >= len(x)
            place = _plan_key(marks[row], dim, cell)
            at = np.searchsorted(plan_keys, place)
            cut = at < len(plan_keys)
            cut[cut] = plan_keys[at[cut]] == place[cut]
            mine = np.flatnonzero(cut | (turn(place) == now))
            mine = mine[np.lexsort((guest[mine], cell[mine], codes[row[mine]]))]
            row, cell, guest, cut, at, place = row[mine], cell[mine], guest[mine], cut[mine], at[mine], place[mine]
            if not len(row):
                return
            code = codes[row]
            starts = np.flatnonzero(np.concatenate([[True], (code[1:] != code[:-1]) | (cell[1:] != cell[:-1]) | (guest[1:] != guest[:-1])]))
            reps, copies = column(part, "rep").to_numpy(), column(part, "copies").to_numpy()
            keys = _flat(column(part, "key")).reshape(-1, 16)
            out, held = [], 0
            for start, end in zip(starts.tolist(), [*starts[1:].tolist(), len(row)], strict=True):
                for first in range(start, end, pack_rows):
                    some = row[first : min(end, first + pack_rows)]
                    c, g = int(cell[first]), bool(guest[first])
                    b, tasks = 0, [(0, 0)]
                    if cut[first]:
                        nb, gb = plan_blocks[at[first]].tolist()
                        drawn = int.from_bytes(keys[some[0], :8].tobytes(), "little")
                        b = nb + drawn % gb if g else drawn % nb
                        tasks = [t for t in tasks_of(b, nb, gb, g) if turn(place[first : first + 1], *t)[0] == now]
                        if not tasks:
                            continue
                    body = b"".join((reps[some].tobytes(), copies[some].tobytes(), keys[some].tobytes(), x[some].tobytes()))
                    for i, j in tasks:
                        out.append((int(some[0]), c, i, j, b, g, width, len(some), body))
                        held += len(body)
                        if held >= BATCH_BYTES:
                            yield rows_of(out, labels, dim)
                            out, held = [], 0
            if out:
                yield rows_of(out, labels, dim)

        def rows_of(out: list[tuple], labels: pa.Array, dim: int) -> pa.RecordBatch:
            first, *ints, guest, widths, n, body = zip(*out, strict=True)
            numbers = [pa.array(c, pa.int32()) for c in (*ints, widths, n)]
            dims = pa.array(np.full(len(out), dim, np.int32))
            arrays = [labels.take(pa.array(first)), dims, *numbers, pa.array(guest), pa.array(body, pa.binary())]
            return pa.RecordBatch.from_arrays(arrays, ["label", "dim", "cell", "i", "j", "block", "width", "n", "guest", "body"])

        return deal

    def multiply(table: pa.Table) -> pa.Table:
        label, dim, i, j = (table.column(c)[0] for c in ("label", "dim", "i", "j"))
        dim, i, j = dim.as_py(), i.as_py(), j.as_py()
        home = ~column(table, "guest").to_numpy(zero_copy_only=False) & (column(table, "block").to_numpy() == i)
        left, right = (Block(table, np.flatnonzero(part), dim) for part in (home, ~home))
        links, ends = _links(left, right, threshold, i == j, inside.get(dim, Plan()))
        rep, key = np.concatenate([left.reps, right.reps]), np.concatenate([left.keys, right.keys])
        some = np.flatnonzero(links)
        ends = ends[rep[ends[:, 0]] != rep[ends[:, 1]]]
        none, empty = len(some), pa.nulls(len(ends), pa.int64())
        return pa.table(
            {
                "label": pa.concat_arrays([pa.array([label.as_py()] * none, label.type), pa.nulls(len(ends), label.type)]),
                "key": pa.concat_arrays([pa.array([k.tobytes() for k in key[some]], pa.binary()), pa.nulls(len(ends), pa.binary())]),
                "links": pa.concat_arrays([pa.array(links[some], pa.int64()), empty]),
                "a": pa.concat_arrays([pa.nulls(none, pa.int64()), pa.array(rep[ends[:, 0]], pa.int64())]),
                "b": pa.concat_arrays([pa.nulls(none, pa.int64()), pa.array(rep[ends[:, 1]], pa.int64())]),
            }
        )

    dealt_schema = f"label {label_type}, dim int, cell int, i int, j int, block int, width int, n int, guest boolean, body binary"
    found = []
    for now in range(rounds):
        tasks = placed.mapInArrow(dealer(now), dealt_schema).groupBy("label", "dim", "cell", "i", "j")
        found.append(materialize(tasks.applyInArrow(multiply, f"label {label_type}, key binary, links long, a long, b long"), "vector-links"))
        del tasks
        if len(found) == MOST_FOUND:
            found = [materialize(reduce(DataFrame.unionByName, found), "vector-links")]
        _freed(spark)
    return reduce(DataFrame.unionByName, found)


class Block:
    """The vectors of some packs: reps, copies and keys, and unit vectors in single precision."""

    def __init__(self, table: pa.Table, rows: np.ndarray, dim: int):
        bodies, widths, sizes = (table.column(c) for c in ("body", "width", "n"))
        self.sizes = np.array([sizes[k].as_py() for k in rows.tolist()], np.int64)
        self.starts = np.cumsum(self.sizes) - self.sizes
        n = int(self.sizes.sum())
        self.reps, self.copies, self.keys = np.empty(n, np.int64), np.empty(n, np.int64), np.empty((n, 16), np.uint8)
        self.x = np.empty((n, dim), np.float32)
        self.packs = []
        for k, at, size in zip(rows.tolist(), self.starts.tolist(), self.sizes.tolist(), strict=True):
            body, own = bodies[k].as_buffer(), slice(at, at + size)
            self.reps[own] = np.frombuffer(body, np.int64, size)
            self.copies[own] = np.frombuffer(body, np.int64, size, 8 * size)
            self.keys[own] = np.frombuffer(body, np.uint8, 16 * size, 16 * size).reshape(size, 16)
            self.packs.append(np.frombuffer(body, f"<f{widths[k].as_py()}", size * dim, 32 * size).reshape(size, dim))
            self.x[own] = unit32(self.packs[-1])

    def whole(self, rows: np.ndarray) -> np.ndarray:
        """Vectors as they came, in double precision."""
        packs = np.searchsorted(self.starts, rows, side="right") - 1
        some = zip(packs.tolist(), (rows - self.starts[packs]).tolist(), strict=True)
        return np.array([self.packs[p][k] for p, k in some], np.float64).reshape(len(rows), self.x.shape[1])

    def led(self, leading: np.ndarray | None) -> np.ndarray:
        """What is compared first: products are no less than those of the whole vectors, but for rounding."""
        return self.x if leading is None else led(self.x, leading)


def led(x: np.ndarray, leading: np.ndarray) -> np.ndarray:
    """Unit vectors in the leading directions, and the length of the rest of each."""
    out = np.empty((len(x), leading.shape[1] + 1), np.float32)
    y = np.matmul(x, leading, out=np.empty((len(x), leading.shape[1]), np.float32))
    out[:, :-1] = y
    out[:, -1] = np.sqrt(np.maximum(0, 1 - np.einsum("ij,ij->i", y, y)) + 2 * _slack32(x.shape[1]))
    return out


def _links(left: Block, right: Block, threshold: float, within: bool, plan: Plan) -> tuple[np.ndarray, np.ndarray]:
    """(links of the rows of left, then of right, with others; few (row, row) that connect what is linked).

    Rows of left are compared with those of right, and with each other if ``within``.
    Products are in single precision and tile by tile; those near the threshold are computed again.
    """
    copies = np.concatenate([left.copies, right.copies]).astype(np.float64)
    links = np.zeros(len(copies))
    part = np.arange(len(copies))  # rows of one number are connected
    forest = [np.zeros((0, 2), np.int64)]
    slack = _slack32(left.x.shape[1])
    first = 4 * slack if plan.leading is not None else slack
    mine = left.led(plan.leading)

    def compare(rows: np.ndarray, columns: np.ndarray, theirs: np.ndarray, other: Block, shift: int, later: bool) -> None:
        """theirs: what is compared first of the columns; later: only columns behind their row."""
        nonlocal part
        step = max(1, TILE // max(1, len(columns)))
        for at in range(0, len(rows), step):
            some = rows[at : at + step]
            tall = mine[some[0] : some[-1] + 1] if some[-1] - some[0] == len(some) - 1 else mine[some]
            cos = tall @ theirs.T
            if not cos.size or cos.max() < threshold - first:
                continue
            hits = cos >= threshold - first
            if later:
                hits &= columns > some[:, None]
            high, wide = np.flatnonzero(hits.any(axis=1)), np.flatnonzero(hits.any(axis=0))
            if not len(high):
                continue
            hits, a, b = hits[np.ix_(high, wide)], some[high], columns[wide]
            if plan.leading is None:
                cos = cos[np.ix_(high, wide)]
            else:
                cos = left.x[a] @ other.x[b].T
                hits &= cos >= threshold - slack
            near = np.argwhere(hits & (cos < threshold + slack))
            for k in range(0, len(near), 1024):
                i, j = near[k : k + 1024].T
                hits[i, j] = linked(left.whole(a[i]), other.whole(b[j]), threshold)
            weights = hits.astype(np.float64)
            links[a] += weights @ copies[b + shift]
            links[b + shift] += copies[a] @ weights
            apart = hits & (part[a][:, None] != part[b + shift])
            if apart.any():
                forest.append(_forest(apart, part[a], part[b + shift]))
                part = _joined(part, forest[-1])

    for other, shift, same in [(left, 0, True)] * within + [(right, len(left.x), False)]:
        n, m = len(left.x), len(other.x)
        if not n or not m:
            continue
        theirs = mine if same else other.led(plan.leading)
        if plan.near is None or min(n, m) < PLACE_ROWS:
            step = 1 << 12
            for to in range(0, m, step):
                columns = np.arange(to, min(m, to + step))
                compare(np.arange(min(n, to + step) if same else n), columns, theirs[to : to + step], other, shift, same)
            continue
        short = shortfall(plan.near, threshold)
        homes = _homes(other.x, plan.near)
        order = np.argsort(homes, kind="stable")
        bounds = np.searchsorted(homes[order], np.arange(len(plan.near) + 1)).tolist()
        theirs = theirs[order]
        for rows, cells, guest in _visits(left.x, plan.near, threshold, short):
            if same:
                sent = ~guest | _sent(homes[rows], cells)
                rows, cells, guest = rows[sent], cells[sent], guest[sent]
            places = (cells * 2 + guest if same else cells * 2).astype(np.uint16)
            sorting = np.argsort(places, kind="stable")  # of 16 bits, in linear time
            rows, places = rows[sorting], places[sorting]
            starts = [0, *(np.flatnonzero(places[1:] != places[:-1]) + 1).tolist(), len(rows)]
            for a, b in zip(starts, starts[1:], strict=False):
                cell, as_guest = divmod(int(places[a]), 2)
                to, end = bounds[cell], bounds[cell + 1]
                compare(rows[a:b], order[to:end], theirs[to:end], other, shift, same and not as_guest)
    return links.astype(np.int64), np.concatenate(forest)


def _visits(x: np.ndarray, centers: np.ndarray, threshold: float, short: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(row, cell, whether as a guest) of all homes and guests, so many rows or guests at a time as are held."""
    held, count, since = [], 0, 0
    step = 1024
    for at in range(0, len(x), step):
        home, row, cell = cells_of(x[at : at + step], centers, threshold, short)
        rows = np.concatenate([np.arange(len(home)), row]).astype(np.int32) + np.int32(at)
        held.append((rows, np.concatenate([home, cell]).astype(np.int32), np.arange(len(rows)) >= len(home)))
        count, since = count + len(rows), since + len(home)
        if count >= NEAR_VISITS or since >= NEAR_ROWS or at + step >= len(x):
            yield tuple(np.concatenate(c) for c in zip(*held, strict=True))
            held, count, since = [], 0, 0


def _joined(part: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """``part`` after the parts at the ``ends`` are joined; a part's number is one of its rows."""
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        while (up := parent.get(x, x)) != x:
            parent[x] = x = parent.get(up, up)
        return x

    for a, b in ends.tolist():
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    names = np.arange(len(part))
    for a in list(parent):
        names[a] = root(a)
    return names[part]


def _forest(hits: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Few (a, b) that connect whatever the hits connect: breadth first over the rows of ``hits``."""
    out: list[tuple[int, int]] = []
    rows_left, columns_left = np.ones(len(a), bool), np.ones(len(b), bool)
    for start in range(len(a)):
        if not rows_left[start]:
            continue
        rows_left[start] = False
        queue = [start]
        while queue:
            row = queue.pop()
            fresh = np.flatnonzero(hits[row] & columns_left)
            columns_left[fresh] = False
            out += [(int(a[row]), int(b[k])) for k in fresh if a[row] != b[k]]
            for k in fresh:
                more = np.flatnonzero(hits[:, k] & rows_left)
                rows_left[more] = False
                out += [(int(a[m]), int(b[k])) for m in more if a[m] != b[k]]
                queue += more.tolist()
    return np.array(out, np.int64).reshape(-1, 2)


def _plans(classes: DataFrame, threshold: float) -> dict[int, Plan]:
    """For each length of vector that has a large label, what a bounded sample of the classes shows to be cheap."""
    drawn = F.xxhash64("label", "key")
    sizes = classes.groupBy("label", "dim").count().groupBy("dim").agg(F.sum("count").alias("rows"), F.max("count").alias("most"))
    out = {}
    for r in sizes.filter(F.col("most") * F.col("dim") > F.lit(PLAN_ROWS * 64)).collect():
        limit = max(2, min(SAMPLE + PROBE, SAMPLE_VALUES // r.dim))
        share = min(1.0, 1.1 * limit / r.rows)
        # the least hashes, without sorting all classes
        least = F.lit(-(1 << 63) + min((1 << 64) - 1, int(share * 2**64)))
        rows = classes.filter((F.col("dim") == r.dim) & (drawn <= least)).select(drawn.alias("drawn"), "vector").collect()
        rows = sorted((row.drawn, bytes(row.vector)) for row in rows)[:limit]
        if not rows:
            continue
        x = unit32(np.stack([np.frombuffer(v, f"<f{len(v) // r.dim}").astype(np.float64) for _, v in rows]))
        probe = min(PROBE, len(x) // 2)
        out[int(r.dim)] = _plan(x[probe:], x[:probe], r.most, threshold)
    return out


def _plan(x: np.ndarray, probe: np.ndarray, n: int, threshold: float) -> Plan:
    """The cheapest plan for labels of up to ``n`` vectors like these; probe: none of x, which are near their own centroids."""
    dim = x.shape[1]
    if not len(probe):
        return Plan()
    size, block = dim / 64, max(1, BLOCK_VALUES // dim)
    plan, pair = Plan(leading=_leading(x, probe, threshold)), PAIR_NS * size
    if plan.leading is not None:
        pair = LEADING_NS * plan.leading.shape[1] / 16
    fits = {}

    def of(cells: int) -> tuple[np.ndarray, float, float, float, float]:
        """(centroids; guests of a vector, and those sent; share of all vectors that it meets in all cells, and in those it is sent to)."""
        if cells not in fits:
            centers = spherical_kmeans(x, cells)
            share = np.bincount(_homes(x, centers), minlength=len(centers)) / len(x)
            home, row, cell = cells_of(probe, centers, threshold)
            sent = _sent(home[row], cell)
            met, own = share[cell].sum() / len(probe), share[home].sum() / len(probe)
            fits[cells] = (centers, len(row) / len(probe), sent.sum() / len(probe), own + met, own / 2 + share[cell[sent]].sum() / len(probe))
        return fits[cells]

    rows = min(n, block)
    inside = pair * rows
    for cells in NEAR_CELLS:
        if cells * CELL_SAMPLE > len(x) or cells * DOT_NS * size >= inside:
            break
        centers, guests, _, met, _ = of(cells)
        cost = cells * DOT_NS * size + (1 + guests) * GATHER_NS * size + met * rows * pair
        if cost < inside:
            inside, plan.near = cost, centers
    copies = math.ceil(n / block)
    best = copies * COPY_NS * size + n / 2 * inside / rows
    for cells in CELLS:
        if cells * CELL_SAMPLE > len(x) or cells * DOT_NS * size >= best:
            break
        centers, _, sent, _, met = of(cells)
        homes = n / cells
        blocks = math.ceil(homes / block), math.ceil(homes * sent / block)
        copies = 1 + sent if homes * (1 + sent) <= block else sum(blocks) + sent * blocks[0]
        cost = copies * COPY_NS * size + cells * DOT_NS * size + n * met * pair
        if cost < best:
            best, plan.cells = cost, centers
        elif cost > 3 * best:  # and more with more cells
            break
    return plan


def _leading(x: np.ndarray, probe: np.ndarray, threshold: float) -> np.ndarray | None:
    """Directions in which x varies most, as few as tell most of its pairs apart; None: all numbers."""
    if x.shape[1] > LEADING_DIM:
        return None
    some = x[: 4 * PROBE]
    cos = probe @ some.T
    directions = np.linalg.eigh(x.astype(np.float64).T @ x)[1][:, ::-1].astype(np.float32)
    for many in LEADING:
        if many * 2 > x.shape[1]:
            break
        basis = np.ascontiguousarray(directions[:, :many])
        passed = (led(probe, basis) @ led(some, basis).T >= threshold) & (cos < threshold)
        if passed.mean() <= LEADING_SHARE:
            return basis
    return None
