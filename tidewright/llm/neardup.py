"""Near-duplicate records with small edits (problem 6): a size-aware heavy-light similarity join, exact.

Every text is the set of its distinct runs of words (shingles). Two sets with Jaccard similarity of at least t overlap
in at least t/(1+t) * (a + b) shingles. Under one global order of shingles, rare ones first, two such sets share at
least c shingles within their prefixes (index prefix for the smaller set, probe prefix for the larger one). That
overlap join is solved size-aware: a set whose prefix is small enumerates all its subsets of c shingles, and two small
sets meet under a common subset; a large set scans inverted lists of single shingles and counts. The boundary between
small and large is the prefix length at which both ways together cost least, from sums over all sets. Subsets that
occur once are never shuffled: a partition-merged Bloom filter of the repeated ones is asked first. Candidates are
verified on the full sets.

Shingles that occur in one set only cannot be shared; they are known from a count sketch of fixed size, which counts a
shingle of several sets as two or more (larger counts are rounded, they only order the shingles). They take part in the
sizes, not in the join.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache, reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewright.llm import kernels as K
from tidewright.llm import sketches
from tidewright.operators.components import connected_components
from tidewright.runtime import broadcast_if_small, discard, latest_by, materialize

#: Fixed size c of the enumerated subsets, and of the overlap that inverted lists must reach.
SUBSET = 4
#: Sum of the weights of matched tokens at which a pair is a candidate: a multiple of all numbers up to SUBSET.
WHOLE = 12
#: Cells of the count sketch (one byte each once merged); fewer cells make the join slower, never wrong.
SKETCH_CELLS = 1 << 25
#: Largest prefix that may be enumerated at all; C(24, 4) = 10626.
MOST_ENUMERATED = 24
#: Cost of an enumerated subset in entries of inverted lists that a set scans. Measured: 0.14 microseconds to enumerate a
#: subset, add it to the filter and ask the filter; 28 task seconds for 319 million list entries of 136,000 sets.
SUBSET_COST = 1.6
#: Subsets enumerated at once, which bounds a worker's memory.
SUBSETS_AT_ONCE = 1 << 18
#: An inverted list of about this many sets is split over several keys, at most MOST_SPLITS.
HOT_LIST, MOST_SPLITS = 4096, 64

def _cell(tokens: np.ndarray, size: int) -> np.ndarray:
    return (K.mix(tokens ^ np.uint64(0xA0761D6478BD642F)) >> np.uint64(24)).astype(np.int64) & (size - 1)


class Sets:
    """Shingle sets of a block of texts: tokens by document, sizes and a 128-bit hash of each set."""

    def __init__(self, text: K.Chars, size: int):
        w = K.words(text)
        token, first = K.runs(w.hash, w.doc, size)
        doc = w.doc[first]
        count = K.per_doc(w.doc, text.docs)
        short = np.flatnonzero((count > 0) & (count < size))  # too short for one run: the whole text is one
        if len(short):
            at = np.flatnonzero(np.isin(w.doc, short))
            start = np.flatnonzero(np.r_[True, w.doc[at][1:] != w.doc[at][:-1]])
            place = np.arange(len(at)) - np.repeat(start, np.diff(np.append(start, len(at))))
            token = np.append(token, K.mix(np.add.reduceat(K.mix(w.hash[at] + place.astype(np.uint64)), start) + np.uint64(7)))
            doc = np.append(doc, w.doc[at][start])
        self.token, self.doc = K.distinct(token, doc)
        self.docs = text.docs
        self.size = K.per_doc(self.doc, text.docs)
        self.hash = self._sum(K.mix(self.token))
        self.check = self._sum(K.mix(self.token ^ np.uint64(0xE7037ED1A0B428DB)))

    def _sum(self, values: np.ndarray) -> np.ndarray:
        total = np.zeros(self.docs, np.uint64)
        if len(values):
            start = np.flatnonzero(np.r_[True, self.doc[1:] != self.doc[:-1]])
            total[self.doc[start]] = np.add.reduceat(values, start)
        return total

    def first_copies(self) -> np.ndarray:
        """True for the first document of each distinct non-empty set of the block."""
        chosen = np.zeros(self.docs, bool)
        chosen[np.unique(self.hash, return_index=True)[1]] = True
        return chosen & (self.size > 0)


def _signed(values: np.ndarray) -> pa.Array:
    return pa.array(values.view(np.int64), pa.int64())


_DOCS = "sample_id string, ingested_at timestamp, n int, hash bigint, check bigint, part int, segment int, payload binary"


def _scan(df: DataFrame, size: int, cells: int) -> DataFrame:
    """One pass over the texts: a row per document with its set's size and hash, and the partition's count sketch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(cells, np.uint16)
        names = None
        for batch in batches:
            for start, end, text in K.blocks(batch.column(2)):
                s = Sets(text, size)
                mine = s.token[s.first_copies()[s.doc]]
                at, times = np.unique(_cell(mine, cells), return_counts=True)
                sketches.add_to(counts, at, times)
                rows = end - start
                names = [f.split()[0] for f in _DOCS.split(", ")]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(start, rows), batch.column(1).slice(start, rows), pa.array(s.size.astype(np.int32)), _signed(s.hash), _signed(s.check),
                     pa.nulls(rows, pa.int32()), pa.nulls(rows, pa.int32()), pa.nulls(rows, pa.binary())], names)
        if names:
            for piece in sketches.emit(sketches.encode_counts(counts), sketches.partition_id()):
                rows = piece.num_rows
                yield pa.RecordBatch.from_arrays(
                    [pa.nulls(rows, pa.string()), pa.nulls(rows, pa.timestamp("us", "UTC")), *[pa.nulls(rows, pa.int32())], *[pa.nulls(rows, pa.int64())] * 2, *piece.columns], names)

    return df.mapInArrow(run, _DOCS)


@lru_cache(maxsize=64)
def _subsets(count: int) -> np.ndarray:
    return np.array(list(itertools.combinations(range(count), SUBSET)), np.int64).reshape(-1, SUBSET)


#: One row per distinct set that can have a partner: its size, its shareable shingles, the end of its index prefix, whether
#: all its partners share c shingles with it, the lengths of the lists it would scan, and its probe prefix with the coded
#: counts of the shingles, rare ones first.
_PREFIXES = "hash bigint, n int, shared int, ends int, fits boolean, again boolean, scan double, tokens array<bigint>, codes binary"
#: spot holds the set's size and its shareable shingles (21 bits each), the place in the prefix (17 bits), what the entry
#: may be in a pair (1: the smaller set, in the index, 2: the larger one) and its kind (0: shingle of a large set,
#: 1: shingle of a small set, 2: subset of a small set), two bits each.
_POSTINGS = "key bigint, hash bigint, spot bigint"
#: Entries beyond these sizes are held to weaker bounds: the index prefix of such a set is its probe prefix, and what
#: depends on exact sizes and places is not asked of it.
MOST_SIZE, MOST_PLACE = (1 << 21) - 1, (1 << 17) - 1


def _prefixes(df: DataFrame, size: int, threshold: float, cells: np.ndarray, repeats: np.ndarray, repeat_cells: int) -> tuple[DataFrame, DataFrame]:
    """(prefixes, written): the prefix of every distinct set that can have a partner, and the table that is read for it.

    ``again`` marks sets that may stand in several blocks; only their rows have to be made distinct.
    """
    context = df.sparkSession.sparkContext
    shared_cells, shared_repeats = context.broadcast(cells.tobytes()), context.broadcast(repeats.tobytes())
    count = len(cells)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, bits = np.frombuffer(shared_cells.value, np.uint8), np.frombuffer(shared_repeats.value, np.uint8)
        for batch in batches:
            for _, _, text in K.blocks(batch.column(0)):
                s = Sets(text, size)
                yield _prefixes_of(s, threshold, table, count, sketches.holds(s.hash, bits, repeat_cells))

    found = materialize(df.mapInArrow(run, _PREFIXES), "prefixes")
    once = found.where("again").groupBy("hash").agg(*[F.first(c).alias(c) for c in found.columns[1:]])
    return found.where("not again").unionByName(once), found


def _prefixes_of(s: Sets, threshold: float, table: np.ndarray, cells: int, again: np.ndarray) -> pa.RecordBatch:
    code = table[_cell(s.token, cells)]
    keep = (code >= 2) & s.first_copies()[s.doc]
    token, doc, code = s.token[keep], s.doc[keep], code[keep]
    shared = K.per_doc(doc, s.docs)
    probe_need = np.ceil(threshold * s.size - 1e-9).astype(np.int64)
    index_need = np.ceil(2 * threshold / (1 + threshold) * s.size - 1e-9).astype(np.int64)
    index_need = np.where(s.size < MOST_SIZE, index_need, probe_need)
    able = shared >= np.maximum(probe_need, 1)
    probe = np.where(able, np.minimum(shared, shared - probe_need + SUBSET), 0)
    index = np.where(able & (shared >= index_need), np.minimum(shared, shared - index_need + SUBSET), 0)
    order = np.lexsort((token, code, doc))
    token, doc, code = token[order], doc[order], code[order]
    begin = np.concatenate([[0], np.cumsum(shared)])[:-1]
    inside = np.arange(len(token)) - begin[doc] < probe[doc]
    token, doc, code = token[inside], doc[inside], code[inside]
    scan = K.per_doc(doc, s.docs, sketches.decode(code))
    chosen = np.flatnonzero(probe > 0)
    ends = np.concatenate([[0], np.cumsum(probe[chosen])]).astype(np.int32)
    lists = pa.ListArray.from_arrays(pa.array(ends), _signed(token))
    codes = pa.Array.from_buffers(pa.binary(), len(chosen), [None, pa.py_buffer(ends.tobytes()), pa.py_buffer(np.ascontiguousarray(code).tobytes())])
    whole = [np.minimum(s.size, MOST_SIZE), np.minimum(shared, MOST_SIZE), index]
    return pa.RecordBatch.from_arrays(
        [_signed(s.hash[chosen]), *[pa.array(v[chosen].astype(np.int32)) for v in whole], pa.array(probe_need[chosen] >= SUBSET), pa.array(again[chosen]), pa.array(scan[chosen]), lists, codes], [f.split()[0] for f in _PREFIXES.split(", ")]
    )


@dataclass
class Block:
    """The prefixes of an Arrow batch as flat arrays."""

    hash: np.ndarray
    n: np.ndarray
    shared: np.ndarray
    index: np.ndarray
    token: np.ndarray
    code: np.ndarray
    probe: np.ndarray
    begin: np.ndarray
    small: np.ndarray

    @classmethod
    def of(cls, batch: pa.RecordBatch, boundary: int) -> Block:
        column = lambda name: batch.column(batch.schema.names.index(name))
        numbers = [column(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("hash", "n", "shared", "ends")]
        lists = column("tokens")
        begin = lists.offsets.to_numpy().astype(np.int64)
        token = lists.flatten().to_numpy(zero_copy_only=False).view(np.uint64)
        code = np.frombuffer(b"".join(column("codes").to_pylist()), np.uint8)
        probe = np.diff(begin)
        small = column("fits").to_numpy(zero_copy_only=False).astype(bool) & (probe >= SUBSET) & (probe <= boundary)
        return cls(*numbers, token, code, probe, (begin - begin[0])[:-1], small)

    def subsets(self) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
        """(key, row, first place, in the index) of all subsets of the small sets, some at a time."""
        for width in np.unique(self.probe[self.small]).tolist():
            combos = _subsets(width)
            rows = np.flatnonzero(self.small & (self.probe == width))
            step = max(1, SUBSETS_AT_ONCE // len(combos))
            for at in range(0, len(rows), step):
                chosen = rows[at : at + step]
                picked = self.token[self.begin[chosen][:, None] + np.arange(width)]
                key = picked[:, combos[:, 0]]
                for k in range(1, SUBSET):
                    key = K.mix(key) + picked[:, combos[:, k]]
                indexed = combos[:, -1][None] < self.index[chosen][:, None]
                yield K.mix(key).ravel(), np.repeat(chosen, len(combos)), np.tile(combos[:, 0], len(chosen)), indexed.ravel()

    def spot(self, row: np.ndarray, place: np.ndarray, role: np.ndarray, kind: np.ndarray) -> np.ndarray:
        packed = (self.n[row] << 38) | (self.shared[row] << 17) | np.minimum(place, MOST_PLACE)
        return (packed * 4 | role) * 4 | kind


def choose_boundary(prefixes: DataFrame) -> tuple[int, dict[str, int]]:
    """(boundary, figures): the longest prefix that is enumerated, and what either side holds.

    The costs of both sides are summed over all sets by prefix length, and the boundary with the least sum is taken:
    subsets of the sets up to it, lists scanned by the others. Below SUBSET nothing is enumerated.
    """
    length = F.size("tokens")
    group = F.when(F.col("fits"), F.least(length, F.lit(MOST_ENUMERATED + 1))).otherwise(F.lit(0)).alias("length")
    choose = lambda n: F.lit(1.0) * reduce(lambda a, k: a * F.greatest(n - k, F.lit(0)) / (k + 1), range(SUBSET), F.lit(1.0))
    rows = prefixes.groupBy(group).agg(F.count(F.lit(1)).alias("sets"), F.sum(choose(length)).alias("subsets"), F.sum("scan").alias("scan"), F.sum(length).alias("entries")).orderBy("length").collect()
    best, boundary, saved = 0.0, SUBSET - 1, 0.0
    for r in rows:
        if SUBSET <= r["length"] <= MOST_ENUMERATED:
            saved += r["scan"] - SUBSET_COST * r["subsets"]
            if saved > best:
                best, boundary = saved, r["length"]
    small = [r for r in rows if SUBSET <= r["length"] <= boundary]
    large = [r for r in rows if not SUBSET <= r["length"] <= boundary]
    return boundary, {
        "small_sets": sum(r["sets"] for r in small), "subsets": int(sum(r["subsets"] for r in small)), "large_sets": sum(r["sets"] for r in large), "list_entries": sum(r["entries"] for r in large),
    }


def _repeated_subsets(prefixes: DataFrame, boundary: int, subsets: int) -> tuple[np.ndarray, int]:
    """Packed filter of the subsets that may stand in several small sets, and its cells."""
    cells = sketches.filter_cells(subsets)

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = sketches.Seen(cells)
        for batch in batches:
            for key, *_ in Block.of(batch, boundary).subsets():
                seen.add(key)
        yield from sketches.emit(seen.cells, sketches.partition_id())

    small = prefixes.where(F.col("fits") & F.size("tokens").between(SUBSET, boundary))
    merged = sketches.merge(small.mapInArrow(build, sketches.SCHEMA), sketches.merge_seen, small.rdd.getNumPartitions())
    return np.packbits(sketches.gather(merged, cells) > 1), cells


def _postings(prefixes: DataFrame, boundary: int, subsets: int) -> DataFrame:
    """Entries of the inverted lists: prefix shingles of all sets, and those subsets of small sets that may repeat."""
    bits, cells = _repeated_subsets(prefixes, boundary, subsets) if subsets else (np.zeros(1, np.uint8), 8)
    shared_bits = prefixes.sparkSession.sparkContext.broadcast(bits.tobytes())
    names = [f.split()[0] for f in _POSTINGS.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.frombuffer(shared_bits.value, np.uint8)
        for batch in batches:
            if not batch.num_rows:
                continue
            b = Block.of(batch, boundary)
            entry = lambda key, row, spot: pa.RecordBatch.from_arrays([_signed(key), pa.array(b.hash[row]), pa.array(spot)], names)  # noqa: E731, B023
            yield from (entry(*made) for made in _list_entries(b))
            for key, row, place, indexed in b.subsets():
                held = sketches.holds(key, table, cells)
                key, row, place, indexed = key[held], row[held], place[held], indexed[held]
                yield entry(key, row, b.spot(row, place, 2 + indexed, np.full(len(row), 2)))

    return prefixes.mapInArrow(run, _POSTINGS)


def _list_entries(b: Block) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(key, row, spot) of all prefix shingles. A long list is split: larger sets are dealt out, smaller ones stand in every part."""
    row = np.repeat(np.arange(len(b.probe)), b.probe)
    place = np.arange(len(row)) - b.begin[row]
    kind = b.small[row].astype(np.int64)
    indexed = (place < b.index[row]).astype(np.int64)
    parts = np.clip(np.ceil(sketches.decode(b.code) / HOT_LIST), 1, MOST_SPLITS).astype(np.int64)
    whole = parts == 1
    yield b.token[whole], row[whole], b.spot(row, place, 2 + indexed, kind)[whole]
    hot = np.flatnonzero(~whole)
    if len(hot):
        part = lambda at, k: K.mix(b.token[at] + (k.astype(np.uint64) + np.uint64(1)) * np.uint64(0xC2B2AE3D27D4EB4F))
        mine = (K.mix(b.hash[row[hot]].view(np.uint64)) % parts[hot].astype(np.uint64)).astype(np.int64)
        yield part(hot, mine), row[hot], b.spot(row[hot], place[hot], np.full(len(hot), 2), kind[hot])
        again = np.repeat(hot[indexed[hot] > 0], parts[hot[indexed[hot] > 0]])
        size = parts[again]
        first = np.flatnonzero(np.r_[True, again[1:] != again[:-1]]) if len(again) else np.zeros(0, np.int64)
        k = np.arange(len(again)) - np.repeat(first, size[first])
        yield part(again, k), row[again], b.spot(row[again], place[again], np.full(len(again), 1), kind[again])


def _needed(threshold: float, a: Column, b: Column) -> Column:
    return F.ceil(F.lit(threshold / (1 + threshold)) * (a + b) - F.lit(1e-9))


def _candidates(postings: DataFrame, threshold: float) -> DataFrame:
    """(a, b): pairs of set hashes that share at least c prefix shingles and may reach the needed overlap.

    The lists are shuffled once: both sides of the join read the same exchange, so no condition may concern one side only.
    """
    lists = postings.repartition("key")
    a = lists.select("key", F.col("hash").alias("a_hash"), F.col("spot").alias("a_spot"))
    b = lists.select("key", F.col("hash").alias("b_hash"), F.col("spot").alias("b_spot"))
    part = lambda x, shift, bits: F.shiftrightunsigned(F.col(f"{x}_spot"), shift).bitwiseAND((1 << bits) - 1)
    n, shared, place, kind = (lambda x: part(x, 42, 21)), (lambda x: part(x, 21, 21)), (lambda x: part(x, 4, 17)), (lambda x: part(x, 0, 2))
    need = _needed(threshold, n("a"), n("b"))
    # c matches must lie within both prefixes, around this one
    ends = lambda x, share: F.least(shared(x), shared(x) - F.ceil(F.lit(share) * n(x) - F.lit(1e-9)) + SUBSET)
    index_end = F.when(n("a") < MOST_SIZE, ends("a", 2 * threshold / (1 + threshold))).otherwise(ends("a", threshold))
    around = F.least(index_end - place("a"), ends("b", threshold) - place("b")) + F.least(place("a"), place("b"))
    whole = (n("a") < MOST_SIZE) & (n("b") < MOST_SIZE) & (place("a") < MOST_PLACE) & (place("b") < MOST_PLACE)
    reach = F.least(shared("a") - place("a"), shared("b") - place("b")) + F.least(place("a"), place("b"))
    met = a.join(b, "key").where(
        (F.col("a_spot").bitwiseAND(4) + F.col("b_spot").bitwiseAND(8) == 12)
        & ((n("a") < n("b")) | ((n("a") == n("b")) & (F.col("a_hash") < F.col("b_hash"))))
        & (((kind("a") == 2) & (kind("b") == 2)) | ((kind("a") < 2) & (kind("b") < 2) & (kind("a") + kind("b") < 2)))
        & (F.least(shared("a"), shared("b")) >= need)
        & (~whole | ((reach >= need) & ((kind("a") == 2) | (around >= F.least(F.lit(SUBSET), need)))))
    )
    # tiny sets need fewer than c shingles; weights that add up to WHOLE for whatever is needed save a column
    weight = F.when(kind("a") == 2, F.lit(WHOLE)).when(need >= SUBSET, F.lit(WHOLE // SUBSET)).otherwise(F.ceil(F.lit(WHOLE) / need))
    counted = met.groupBy(F.col("a_hash").alias("a"), F.col("b_hash").alias("b")).agg(F.sum(weight.cast("int")).alias("_met"))
    return counted.where(F.col("_met") >= WHOLE).select("a", "b")


def _sets_of(df: DataFrame, size: int, wanted: DataFrame, repeats: np.ndarray, repeat_cells: int) -> DataFrame:
    """(hash, check, tokens) of the sets whose hashes stand in ``wanted`` (a few others may come along)."""
    cells = sketches.filter_cells(max(1, wanted.count()))
    shared_repeats = df.sparkSession.sparkContext.broadcast(repeats.tobytes())

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        flags = np.zeros(cells, np.uint8)
        for batch in batches:
            flags[sketches.places(batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64), cells)] = 1
        yield from sketches.emit(flags, sketches.partition_id())

    merged = sketches.merge(wanted.mapInArrow(build, sketches.SCHEMA), np.bitwise_or, wanted.rdd.getNumPartitions())
    bits = df.sparkSession.sparkContext.broadcast(np.packbits(sketches.gather(merged, cells)).tobytes())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, several = np.frombuffer(bits.value, np.uint8), np.frombuffer(shared_repeats.value, np.uint8)
        for batch in batches:
            for _, _, text in K.blocks(batch.column(0)):
                s = Sets(text, size)
                chosen = sketches.holds(s.hash, table, cells) & s.first_copies()
                mine = chosen[s.doc]
                lengths = s.size[chosen]
                tokens = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32)), _signed(s.token[mine]))
                again = pa.array(sketches.holds(s.hash[chosen], several, repeat_cells))
                yield pa.RecordBatch.from_arrays([_signed(s.hash[chosen]), _signed(s.check[chosen]), tokens, again], ["hash", "check", "tokens", "again"])

    found = materialize(df.mapInArrow(run, "hash bigint, check bigint, tokens array<bigint>, again boolean"), "tokens")
    once = found.where("again").groupBy("hash", "check").agg(F.first("tokens").alias("tokens"))
    return found.where("not again").drop("again").unionByName(once)


def near_duplicates(
    samples: DataFrame, text: str = "text", size: int = 5, threshold: float = 0.8, sketch_cells: int = SKETCH_CELLS
) -> tuple[DataFrame, DataFrame]:
    """(classes, links) of records whose shingle sets have a Jaccard similarity of at least ``threshold``.

    ``classes``: (sample_id, class_id, links), one row per sample with words: the smallest sample_id of its connected
    component, and the number of different texts linked to its own. ``links``: (a, b, similarity), one row per linked
    pair of different sets, each named by the smallest sample_id that has it. Exact copies share one set and are never
    paired with each other.

    Words are compared in lower case without punctuation, each Han character is a word. A text with fewer than ``size``
    words counts as a single run; null, empty and wordless texts are in no class. Of each sample_id the latest delivery
    counts; null ids are dropped.
    """
    texts = samples.where("sample_id is not null").select("sample_id", "ingested_at", F.col(text).alias("_text"))
    scanned = materialize(_scan(texts, size, sketch_cells), "sets")
    partials = scanned.where("payload is not null").select("part", "segment", "payload")
    cells = sketches.gather(sketches.merge(partials, sketches.merge_counts, texts.rdd.getNumPartitions()), sketch_cells)
    docs = scanned.where("sample_id is not null")
    latest = latest_by(docs, "sample_id", "ingested_at", {"n": F.col("n"), "hash": F.col("hash"), "check": F.col("check")}).where("n > 0")
    latest = materialize(latest, "latest")
    only = texts.select("_text")
    repeat_cells = sketches.filter_cells(docs.count())
    repeats = sketches.repeat_filter(docs.where("n > 0"), ["hash"], repeat_cells)
    prefixes, written = _prefixes(only, size, threshold, cells, repeats, repeat_cells)
    boundary, sides = choose_boundary(prefixes)
    pairs = materialize(_candidates(_postings(prefixes, boundary, sides["subsets"]), threshold), "pairs")
    discard(written, scanned)  # the sketches are merged, documents and pairs are written
    wanted = pairs.select(F.col("a").alias("hash")).unionByName(pairs.select(F.col("b").alias("hash"))).distinct()
    sets = _sets_of(only, size, wanted, repeats, repeat_cells)
    left = sets.select(F.col("hash").alias("a"), F.col("check").alias("a_check"), F.col("tokens").alias("a_tokens"))
    right = sets.select(F.col("hash").alias("b"), F.col("check").alias("b_check"), F.col("tokens").alias("b_tokens"))
    # few pairs go to the sets, many are shuffled to them
    sent = broadcast_if_small(pairs)
    both = left.join(sent, "a").join(right.join(sent, "b"), ["a", "b"]).withColumn("_common", F.size(F.array_intersect("a_tokens", "b_tokens")))
    similarity = F.col("_common") / (F.size("a_tokens") + F.size("b_tokens") - F.col("_common"))
    verified = both.select("a", "a_check", "b", "b_check", similarity.alias("similarity")).where(F.col("similarity") >= F.lit(threshold - 1e-12))
    verified = materialize(verified, "verified")
    # each set by the smallest sample that has it; sets of superseded deliveries have no name
    names = materialize(latest.groupBy("hash", "check").agg(F.min("sample_id").alias("id")), "names")
    named = verified
    for side in ("a", "b"):
        known = names.select(F.col("hash").alias(side), F.col("check").alias(f"{side}_check"), F.col("id").alias(f"{side}_id"))
        named = known.join(broadcast_if_small(named), [side, f"{side}_check"])
    links = named.select(F.least("a_id", "b_id").alias("a"), F.greatest("a_id", "b_id").alias("b"), "similarity")
    links = materialize(links.distinct(), "links")
    roots = connected_components(links.select(F.col("a").alias("src"), F.col("b").alias("dst")))
    degree = links.select(F.explode(F.array("a", "b")).alias("id")).groupBy("id").agg(F.count(F.lit(1)).alias("links"))
    classes = (
        latest.join(names, ["hash", "check"])
        .join(broadcast_if_small(roots.withColumnRenamed("node", "id")), "id", "left")
        .join(broadcast_if_small(degree), "id", "left")
        .select("sample_id", F.coalesce("root", "id").alias("class_id"), F.coalesce("links", F.lit(0)).alias("links"))
    )
    return classes, links


#: Members that one task pairs with the others of their class; a larger class is split, into MOST_SPLITS parts at most.
MEMBERS = 1000


def class_pairs(classes: DataFrame) -> DataFrame:
    """(sample_id_a, sample_id_b): all pairs, smaller id first, of samples in the same class.

    For reports that ask for pairs; the classes themselves hold the same in one row per sample. Members of a large class
    are dealt out over several keys, and each of them meets the whole class under every key.
    """
    several = classes.groupBy("class_id").agg(F.count(F.lit(1)).alias("_n")).where("_n > 1")
    parts = F.least(F.lit(MOST_SPLITS), F.ceil(F.col("_n") / MEMBERS)).cast("int")
    members = classes.select("class_id", "sample_id").join(broadcast_if_small(several.select("class_id", parts.alias("_parts"))), "class_id")
    a = members.select("class_id", F.explode(F.sequence(F.lit(0), F.col("_parts") - 1)).alias("_part"), F.col("sample_id").alias("sample_id_a"))
    b = members.select("class_id", F.pmod(F.xxhash64("sample_id"), F.col("_parts")).cast("int").alias("_part"), F.col("sample_id").alias("sample_id_b"))
    return a.join(b, ["class_id", "_part"]).where("sample_id_a < sample_id_b").select("sample_id_a", "sample_id_b")
