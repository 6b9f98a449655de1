"""Exact deduplication by two passes with a Bloom filter, in DataFrame operations only.

The first pass inserts the hash of every normalised text in a blocked Bloom
filter: the hash picks a block of 64 bits and a few bits in it.  Insertions
are counted per block and bits, so copies shrink to one record a task before
they are shuffled, and only the bits that came twice or more are set.  The
second pass tests every row: a row that misses a bit has no equal and passes
straight through; the others, possible repeats, are grouped by the SHA-256 of
their text, which decides.  So a false positive costs a record and changes
nothing.

The filter is broadcast if it has no more blocks than a bound; with more
repeats than that every row counts as a possible repeat.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from raresift.operators.persist import discard, materialize

#: White space that becomes one space: two or more, or one that isn't a space.
WHITE = r"[ \t-\r]{2,}|[\t-\r]"
#: 64 bits for so many keys.
KEYS_A_BLOCK = 4
#: Bits of a key.
BITS = 4
#: The largest broadcast filter: two numbers a block.
BROADCAST_BLOCKS = 2_000_000
#: Groups that hold more than one row in so many are joined by broadcast; there are no more of them than this.
MOST_HOT = 4096


def normalised_digest(text: Column) -> Column:
    """SHA-256 (binary) of a text with runs of white space as one space; null counts as empty."""
    return F.unhex(F.sha2(F.regexp_replace(F.coalesce(text.cast("string"), F.lit("")), WHITE, " "), 256))


def _cells(digest: Column, blocks: int) -> tuple[Column, Column]:
    """(block, bits) of a text in the filter."""
    hashed = F.xxhash64(digest)
    spread = F.xxhash64(hashed)
    one = F.lit(1).cast("long")
    bits = F.lit(0).cast("long")
    for k in range(BITS):
        place = F.shiftrightunsigned(spread, 6 * k).bitwiseAND(F.lit(63)).cast("int")
        bits = bits.bitwiseOR(F.call_function("shiftleft", one, place))
    return F.pmod(hashed, F.lit(blocks)), bits


def _tested(rows: DataFrame, n: int) -> tuple[DataFrame, DataFrame]:
    """(``rows`` with the mark ``possible``, the written filter); ``rows`` have a ``digest``."""
    block, bits = _cells(F.col("digest"), n // KEYS_A_BLOCK + 1)
    inserted = rows.select(block.alias("block"), bits.alias("bits")).groupBy("block", "bits").agg(F.count("*").alias("n"))
    repeated = inserted.filter("n > 1").groupBy("block").agg(F.bit_or("bits").alias("set_bits"))
    written = materialize(repeated, "repeat-filter")
    if written.count() > BROADCAST_BLOCKS:
        return rows.withColumn("possible", F.lit(True)), written
    tested = rows.withColumn("block", block).join(F.broadcast(written), "block", "left")
    hit = F.coalesce(F.col("set_bits"), F.lit(0).cast("long")).bitwiseAND(bits) == bits
    return tested.withColumn("possible", hit).drop("block", "set_bits"), written


def _grouped(possible: DataFrame, groups: DataFrame) -> DataFrame:
    """Possible repeats with their group's ``keep_id`` and ``group_size``; null where a text has no equal.

    A group with many rows would meet in one task of a shuffled join, so such
    groups are broadcast: of groups with more than 1 / MOST_HOT of all grouped
    rows there are less than MOST_HOT.
    """
    total = groups.agg(F.sum("group_size")).first()[0] or 0
    large = F.col("group_size") * MOST_HOT > total
    hot = F.broadcast(groups.filter(large))
    cold = groups.filter(~large)
    return possible.join(hot, "digest").unionByName(
        possible.join(hot, "digest", "left_anti").join(cold, "digest", "left").select(*possible.columns, "keep_id", "group_size")
    )


def _marked(rows: DataFrame, n: int) -> tuple[DataFrame, DataFrame, list[DataFrame]]:
    """(rows without an equal, possible repeats with their groups, written tables); ``rows`` have ``id`` and ``digest``."""
    tested, written = _tested(rows, n)
    possible = tested.filter("possible").drop("possible")
    groups = possible.groupBy("digest").agg(F.min("id").alias("keep_id"), F.count("*").alias("group_size"))
    groups = materialize(groups.filter("group_size > 1"), "repeat-groups")
    return tested.filter("NOT possible").drop("possible"), _grouped(possible, groups), [written, groups]


def exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: doc_id, keep_id, group_size, kept and text_sha256 (of the normalised text, lowercase hex).

    Texts are equal when they are identical after each run of ASCII white
    space became one space; null counts as empty.  ``keep_id`` is the smallest
    id of the group.  Null ids lose to all others, and are kept where a group
    has no other.  Rows that repeat an id and a text are one document: each of
    them carries its document's marks, and ``group_size`` counts rows.
    Columns beyond the two are left out.  An empty table gives no rows.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("id"), normalised_digest(F.col(text_col)).alias("digest"))
    rows = materialize(rows, "text-digests")
    alone, repeats, tables = _marked(rows, rows.count())
    own = alone.select("id", "digest", F.col("id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"))
    keep_id = F.when(F.col("group_size").isNull(), F.col("id")).otherwise(F.col("keep_id"))
    shared = repeats.select("id", "digest", keep_id.alias("keep_id"), F.coalesce("group_size", F.lit(1).cast("long")).alias("group_size"))
    marked = own.unionByName(shared).select(
        F.col("id").alias("doc_id"),
        "keep_id",
        "group_size",
        F.col("id").eqNullSafe(F.col("keep_id")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )
    result = materialize(marked, "exact-duplicates")
    for table in (rows, *tables):
        discard(table)
    return result


def drop_exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` (all columns, whatever their names) with one row of each distinct normalised text.

    The row with the smallest id stays, one of them if it is there twice.
    Rows without an equal are not shuffled.
    """
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    rows = docs.select(whole, F.col(id_col).cast("long").alias("id"), normalised_digest(F.col(text_col)).alias("digest"))
    alone, repeats, _ = _marked(rows, docs.count())
    first = repeats.filter(F.col("group_size").isNull() | F.col("id").eqNullSafe(F.col("keep_id"))).select("row", "digest")
    return alone.select("row.*").unionByName(first.dropDuplicates(["digest"]).select("row.*"))
