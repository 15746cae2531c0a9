"""Sketches of fixed size, built per partition in numpy and merged in Spark by a tree of bounded groups."""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType

from tidewright.llm.kernels import mix
from tidewright.runtime import discard, materialize

#: Cells of a sketch that travel in one row, and partials merged in one group.
SEGMENT, FAN_IN = 1 << 20, 16
SCHEMA = "part int, segment int, payload binary"


def partition_id() -> int:
    context = TaskContext.get()
    return context.partitionId() if context else 0


def pack(piece: np.ndarray) -> bytes:
    """A segment as bytes: gaps and values of its filled cells while few are filled, else all cells."""
    at = np.flatnonzero(piece)
    if len(at) * 8 > len(piece):
        return b"D" + zlib.compress(piece.tobytes(), 1)
    gap = np.diff(at, prepend=-1) - 1
    wide = gap // 255  # a gap is as many 255s as go into it, then the rest
    coded = np.full(len(at) + int(wide.sum()), 255, np.uint8)
    coded[np.cumsum(wide + 1) - 1] = gap % 255
    return b"S" + len(piece).to_bytes(4, "big") + len(coded).to_bytes(4, "big") + zlib.compress(coded.tobytes() + piece[at].tobytes(), 6)


def unpack(packed: bytes) -> np.ndarray:
    if packed[:1] == b"D":
        return np.frombuffer(zlib.decompress(packed[1:]), np.uint8)
    piece = np.zeros(int.from_bytes(packed[1:5], "big"), np.uint8)
    size = int.from_bytes(packed[5:9], "big")
    both = np.frombuffer(zlib.decompress(packed[9:]), np.uint8)
    ends = np.flatnonzero(both[:size] != 255)
    piece[np.cumsum(both[:size].astype(np.int64))[ends] + np.arange(len(ends))] = both[size:]
    return piece


def emit(cells: np.ndarray, part: int) -> Iterator[pa.RecordBatch]:
    """The non-empty segments of a one-byte sketch, compressed."""
    for segment in range(0, len(cells), SEGMENT):
        piece = cells[segment : segment + SEGMENT]
        if piece.any():
            packed = pack(piece)
            yield pa.RecordBatch.from_arrays(
                [pa.array([part], pa.int32()), pa.array([segment // SEGMENT], pa.int32()), pa.array([packed], pa.binary())], ["part", "segment", "payload"]
            )


def merge(partials: DataFrame, combine: Callable[[np.ndarray, np.ndarray], np.ndarray], parts: int) -> DataFrame:
    """One row per segment: partials combined ``FAN_IN`` at a time, so no task holds more than that many."""

    def fold(pdf: pd.DataFrame) -> pd.DataFrame:
        total = None
        for payload in pdf["payload"]:
            piece = unpack(payload)
            total = piece if total is None else combine(total, piece)
        return pd.DataFrame({"part": [int(pdf["part"].iloc[0]) // FAN_IN], "segment": [int(pdf["segment"].iloc[0])], "payload": [pack(total)]})

    while True:
        partials = partials.groupBy("segment", F.floor(F.col("part") / FAN_IN).alias("_group")).applyInPandas(fold, SCHEMA)
        parts = -(-parts // FAN_IN)
        if parts <= 1:
            return partials


def gather(merged: DataFrame, size: int) -> np.ndarray:
    """The merged sketch on the driver: ``size`` one-byte cells, however many rows it was built from."""
    cells = np.zeros(size, np.uint8)
    for row in merged.select("segment", "payload").toLocalIterator():
        piece = unpack(row["payload"])
        cells[row["segment"] * SEGMENT : row["segment"] * SEGMENT + len(piece)] = piece
    return cells


# --- counts coded in one byte: exact below 16, geometric steps above -------------------------------------------------

_EXACT, _BASE = 16, 1.06
_CODED = np.arange(256, dtype=np.float64)
_CODED[_EXACT:] = _EXACT * _BASE ** np.arange(256 - _EXACT)


def decode(cells: np.ndarray) -> np.ndarray:
    return _CODED[cells]


def encode(counts: np.ndarray) -> np.ndarray:
    steps = _EXACT + np.floor(np.log(np.maximum(counts, _EXACT) / _EXACT) / np.log(_BASE) + 1e-9)
    return np.where(counts < _EXACT, counts, np.minimum(steps, 255)).astype(np.uint8)


_SHORT = encode(np.arange(65536, dtype=np.float64))


def encode_counts(counts: np.ndarray) -> np.ndarray:
    """:func:`encode` of 16-bit counts, without wide temporaries."""
    return _SHORT[counts]


def merge_counts(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return encode(decode(a) + decode(b))


def add_to(counts: np.ndarray, at: np.ndarray, times: np.ndarray) -> None:
    """Add to 16-bit counts at distinct places, without overflow."""
    counts[at] = np.minimum(counts[at].astype(np.int64) + times, 65535)


# --- filter of repeated hashes ---------------------------------------------------------------------------------------

#: Hash functions of the filter, least cells per hash (with 8 of them 0.03 of the unrepeated hashes pass), and bounds of the
#: size of one filter (one byte a cell while it is built, one bit once it is merged). More hashes than that get several
#: filters, by ranges of the hash.
HASHES, CELLS_PER_HASH, LEAST_CELLS, RANGE_CELLS = 3, 8, 1 << 16, 1 << 27


def filter_cells(count: int, most: int = RANGE_CELLS) -> int:
    """Cells for ``count`` hashes in one filter: a power of two between the bounds. Beyond the upper bound more unrepeated hashes pass."""
    return int(min(most, max(LEAST_CELLS, 1 << (max(1, count * CELLS_PER_HASH) - 1).bit_length())))


def filter_ranges(count: int, most: int = RANGE_CELLS) -> int:
    """Ranges of the hash, a power of two, that keep the cells per hash above CELLS_PER_HASH in filters of ``most`` cells."""
    return 1 << max(0, -(-count * CELLS_PER_HASH // most) - 1).bit_length()


def places(hashes: np.ndarray, size: int) -> np.ndarray:
    """Cells of each hash, one row per hash function."""
    seeds = np.arange(1, HASHES + 1, dtype=np.uint64)[:, None] * np.uint64(0xD6E8FEB86659FD93)
    return (mix(hashes[None, :].astype(np.uint64) ^ seeds) >> np.uint64(20)).astype(np.int64) & (size - 1)


def merge_seen(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Bit 0: seen, bit 1: seen more than once. What two partitions have seen once each is repeated."""
    return a | b | ((a & b & 1) << 1)


class Seen:
    """Two Bloom filters in one array: of hashes seen (bit 0) and of hashes seen repeatedly (bit 1)."""

    def __init__(self, size: int):
        self.cells = np.zeros(size, np.uint8)

    def add(self, hashes: np.ndarray) -> None:
        values, count = np.unique(hashes, return_counts=True)
        if len(values):
            at = places(values, len(self.cells))
            again = (count > 1) | ((self.cells[at] & 1).min(axis=0) > 0)
            self.cells[at] |= 1
            self.cells[at[:, again]] |= 3


def repeat_filter(df: DataFrame, columns: list[str], size: int) -> np.ndarray:
    """Packed bits of a Bloom filter that holds every value seen more than once in any of the hash ``columns``.

    Every partition keeps two Bloom filters, of hashes seen once and of hashes seen repeatedly; merging ORs both and
    adds the AND of the once-filters to the repeated one, so no repeated hash is ever missed.
    """

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = Seen(size)
        for batch in batches:
            for i in range(batch.num_columns):
                seen.add(batch.column(i).drop_null().to_numpy(zero_copy_only=False).view(np.uint64))
        yield from emit(seen.cells, partition_id())

    narrow = df.select(*columns)
    partials = narrow.mapInArrow(build, SCHEMA)
    return np.packbits(gather(merge(partials, merge_seen, narrow.rdd.getNumPartitions()), size) > 1)


def holds(hashes: np.ndarray, bits: np.ndarray, size: int) -> np.ndarray:
    """True for hashes that a packed filter may hold."""
    if not len(hashes):
        return np.zeros(0, bool)
    at = places(hashes, size)
    return ((bits[at >> 3] >> (7 - (at & 7)).astype(np.uint8)) & 1).min(axis=0) > 0


def may_repeat(df: DataFrame, bits: np.ndarray, size: int) -> Callable:
    """A column function: true for hashes that the filter may hold; null is false."""
    shared = df.sparkSession.sparkContext.broadcast(bits.tobytes())

    def probe(hashes: pa.Array) -> pa.Array:
        table = np.frombuffer(shared.value, np.uint8)
        values = hashes.fill_null(0).to_numpy(zero_copy_only=False).view(np.uint64)
        return pa.array(holds(values, table, size) & ~hashes.is_null().to_numpy(zero_copy_only=False))

    return F.arrow_udf(probe, BooleanType())


def mark_repeats(df: DataFrame, column: str, count: int, most: int = RANGE_CELLS) -> DataFrame:
    """``df`` with ``_maybe``: true for every row whose hash in ``column`` stands in several rows, and for few others.

    ``df`` must be written already; ``count`` is its number of rows. One filter serves as long as its cells suffice; beyond,
    the table is written again by ranges of the hash (no shuffle), and each range is marked with a filter of its own, so
    the share of unrepeated hashes that pass does not grow with the table. Null hashes are not repeated.
    """
    ranges = filter_ranges(count, most)
    if ranges == 1:
        size = filter_cells(count, most)
        return df.withColumn("_maybe", may_repeat(df, repeat_filter(df, [column], size), size)(column))
    place = F.coalesce(F.shiftrightunsigned(column, 65 - ranges.bit_length()), F.lit(0)).cast("int")
    dealt = materialize(df.withColumn("_range", place), "ranges", "_range")
    marked = []
    for k in range(ranges):
        part = dealt.where(F.col("_range") == k).drop("_range")
        probe = may_repeat(part, repeat_filter(part, [column], most), most)
        marked.append(materialize(part.withColumn("_maybe", probe(column)), "marked"))
    discard(dealt)
    return reduce(DataFrame.unionByName, marked)
