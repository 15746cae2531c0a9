"""Decontamination: share of a text's word n-grams that occur in reference texts."""

from __future__ import annotations

from dataclasses import dataclass, field
from typing import Any

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType

from tidewright.functions.text import ngram_hashes, words
from tidewright.runtime import materialize
from tidewright.schema import with_signals

#: Reference n-grams that are sent along with the tasks as a sorted array: 8 bytes each, so 1 million take 8 MB.
BROADCAST_NGRAMS = 1_000_000
#: Bits of the filter of a larger index at most (32 MB); beyond 33 million n-grams more unknown ones pass. Bytes of one bitmap
#: of the built-in aggregate.
MOST_BITS, BUCKET_BYTES = 1 << 28, 4096


@dataclass
class Rules:
    """Length of the n-grams, and what makes a text contaminated."""

    enabled: bool = False
    reference_sources: list[Any] = field(default_factory=list)
    ngram_size: int = 13
    max_contamination_ratio: float = 0.2
    min_matched_ngrams: int = 1
    normalize_case: bool = True
    strip_punctuation: bool = True


def grams(text: Column, rules: Rules) -> Column:
    return ngram_hashes(words(text, rules.normalize_case, rules.strip_punctuation), rules.ngram_size)


def reference_index(references: DataFrame, rules: Rules, text: str = "text") -> DataFrame:
    """(gram): all distinct n-grams of the reference texts. May be written and read again as an index."""
    return references.select(F.explode(grams(F.col(text), rules)).alias("gram")).distinct()


def _filter_bits(index: DataFrame, count: int) -> tuple[bytes, int]:
    """A Bloom filter of the index with two places per n-gram, and its bits: eight per n-gram, MOST_BITS at most.

    Partial bitmaps are made and merged by built-in aggregates; what comes to the driver is the filter, not the index.
    """
    size = min(MOST_BITS, 1 << max(15, (8 * count - 1).bit_length()))
    spots = index.select(F.explode(F.array(*[p.bitwiseAND(size - 1) + 1 for p in _places(F.col("gram"))])).alias("_at"))
    buckets = spots.groupBy(F.bitmap_bucket_number("_at").alias("bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("_at")).alias("bits"))
    bits = bytearray(size // 8)
    for row in buckets.toLocalIterator():
        start = (row["bucket"] - 1) * BUCKET_BYTES
        bits[start : start + BUCKET_BYTES] = row["bits"][: len(bits) - start]
    return bytes(bits), size


def _places(gram: Column) -> tuple[Column, Column]:
    return gram, F.shiftrightunsigned(gram, 32)


def _maybe_known(df: DataFrame, index: DataFrame, count: int) -> Column:
    """``_grams`` without those that the filter of the index rules out, in Arrow batches."""
    bits, size = _filter_bits(index, count)
    shared = df.sparkSession.sparkContext.broadcast(bits)

    def probe(lists: pa.Array) -> pa.Array:
        table = np.frombuffer(shared.value, np.uint8)
        values = lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
        held = np.ones(len(values), bool)
        for place in (values, values.view(np.uint64) >> np.uint64(32)):
            at = place.astype(np.int64) & (size - 1)
            held &= (table[at >> 3] >> (at & 7).astype(np.uint8)) & 1 > 0
        owner = np.repeat(np.arange(len(lists)), np.diff(lists.offsets.to_numpy()))
        ends = np.concatenate([[0], np.cumsum(np.bincount(owner[held], minlength=len(lists)))]).astype(np.int32)
        return pa.ListArray.from_arrays(pa.array(ends), pa.array(values[held]))

    return F.arrow_udf(probe, ArrayType(LongType()))(F.col("_grams"))


def _known(df: DataFrame, index: DataFrame) -> Column | None:
    """How many of ``_grams`` stand in the index, in Arrow batches; None if the index is too large to be sent along."""
    rows = index.limit(BROADCAST_NGRAMS + 1).toPandas()
    if len(rows) > BROADCAST_NGRAMS:
        return None
    shared = df.sparkSession.sparkContext.broadcast(np.sort(rows["gram"].to_numpy(np.int64)))

    def count(lists: pa.Array) -> pa.Array:
        table = shared.value
        values = lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
        owner = np.repeat(np.arange(len(lists)), np.diff(lists.offsets.to_numpy()))
        hit = table[np.minimum(np.searchsorted(table, values), len(table) - 1)] == values if len(table) else np.zeros(len(values), bool)
        return pa.array(np.bincount(owner[hit], minlength=len(lists)).astype(np.int32))

    # not to be moved into a filter above, which would look up the same n-grams once more
    return F.arrow_udf(count, IntegerType()).asNondeterministic()(F.col("_grams"))


def _with_matches(df: DataFrame, index: DataFrame, rules: Rules, text: str) -> DataFrame | None:
    """``df`` with ``matched`` and ``total``, without a shuffle; None if the index is too large for that."""
    matched = _known(df, index)
    if matched is None:
        return None
    split = df.withColumn("_grams", grams(F.col(text), rules))
    return split.withColumn("matched", matched).withColumn("total", F.size("_grams")).drop("_grams")


def _matches(df: DataFrame, index: DataFrame, rules: Rules, key: str, text: str) -> DataFrame:
    """(key, matched, total) of every key for an index of any size, in one pass over the texts.

    N-grams that the index' Bloom filter does not rule out are exploded and joined with the index by shuffle; a partial
    aggregate folds each text back to one row before anything is shuffled by key.
    """
    split = df.select(key, grams(F.col(text), rules).alias("_grams"))
    split = split.select(key, F.size("_grams").alias("_total"), _maybe_known(df, index, index.count()).alias("_grams"))
    looked_up = split.select(key, "_total", F.explode_outer("_grams").alias("gram")).join(index.withColumn("_hit", F.lit(1)), "gram", "left")
    return looked_up.groupBy(key).agg(F.count("_hit").cast("int").alias("matched"), F.max("_total").alias("total"))


_RATIO = "case when total > 0 then matched / total else 0.0D end"


def scores(df: DataFrame, index: DataFrame, rules: Rules, key: str, text: str = "text") -> DataFrame:
    """(key, matched, total, ratio) of every row; a text without n-grams has (0, 0, 0.0). Keys must be unique, null is a key."""
    found = _with_matches(df.select(key, text), index, rules, text)
    found = _matches(df, index, rules, key, text) if found is None else found
    return found.select(key, "matched", "total", F.expr(_RATIO).alias("ratio"))


def keeps(rules: Rules, matched: Column, ratio: Column) -> Column:
    """True for texts with too few matches to matter or a ratio within the limit."""
    return (matched < rules.min_matched_ngrams) | (ratio <= rules.max_contamination_ratio)


def annotate(df: DataFrame, references: DataFrame, rules: Rules) -> DataFrame:
    """Set the contamination signals of standard records. An empty reference leaves them as they are.

    With an index that can be sent along, records stay where they are. With a larger one, rows are told apart by a generated
    number, so repeated and null sample ids do no harm; the numbers are written once, since a second evaluation could number
    the rows differently.
    """
    index = materialize(reference_index(references, rules), "grams")
    if index.isEmpty():
        return df
    joined = _with_matches(df, index, rules, "text")
    if joined is None:
        numbered = materialize(df.withColumn("_row", F.monotonically_increasing_id()), "numbered")
        joined = numbered.join(_matches(numbered, index, rules, "_row", "text"), "_row").drop("_row")
    changes = {"contamination_ratio": F.expr(_RATIO), "contamination_matched_ngrams": F.col("matched"), "contamination_total_ngrams": F.col("total")}
    return joined.withColumn("quality_signals", with_signals(F.col("quality_signals"), changes)).drop("matched", "total")


def split_contaminated(df: DataFrame, rules: Rules) -> tuple[DataFrame, DataFrame]:
    """(kept, excluded) of annotated records; records without signals count as clean."""
    clean = keeps(rules, F.coalesce("quality_signals.contamination_matched_ngrams", F.lit(0)), F.coalesce("quality_signals.contamination_ratio", F.lit(0.0)))
    return df.where(clean), df.where(~clean)
