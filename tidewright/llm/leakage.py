"""Evaluation texts leaking into training text (problem 7): q-gram lemma filtering and banded alignment."""

from __future__ import annotations

import io
import re
from collections import Counter
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewright.llm import kernels as K
from tidewright.runtime import materialize, scratch
from tidewright.sources.arrow import located

#: Length of a q-gram; a region of WINDOW characters may hold EDITS separate edits (of letters or whole words), so by
#: the q-gram lemma it shares at least WINDOW + 1 - Q - Q * EDITS grams with the item, near one diagonal.
Q, WINDOW, EDITS = 8, 64, 4
LEAST_GRAMS = WINDOW + 1 - Q - Q * EDITS
#: Diagonals of a band; bands overlap by half, so hits that lie within half of it share a band. DRIFT is the way one
#: edit, a short word inserted or left out, may move the diagonal.
BAND, DRIFT = 24, 12
#: A segment for alignment covers at most this much of the item, and gaps between its hits are at most GAP long.
SEGMENT, GAP = 128, 64
#: An aligned segment counts, less its edits, if they stay below this share of its length.
EDIT_SHARE = 0.35
#: An opening sentence that this many items share is an instruction.
SHARED_OPENINGS = 3
#: Characters of items searched at once (their gram table is held by each worker), and least own wording of an item.
BLOCK_ITEM_CHARS, LEAST_WORDING = 4_000_000, Q
#: Bytes of documents that are held while the blocks of a large benchmark pass by.
GROUP_CHARS = 1 << 22

_TABLE_BITS = 22
_MARKUP = r"<[^<>]{1,80}>|&#?[A-Za-z0-9]{1,8};|\\[nrt]"


def _sentences(text: str) -> list[str]:
    return [s for s in re.split(r"(?<=[.?!。？！:])\s+|\n+", re.sub(_MARKUP, " ", text)) if s.strip()]


def _openings(sentences: list[str]) -> list[str]:
    """All sentences but the last, as they are compared."""
    return [re.sub(r"[\W_]+", " ", s.lower()).strip() for s in sentences[:-1]]


def own_wording(texts: list[str], leads: list[int] | None = None) -> list[str]:
    """Texts without the opening sentences that at least :data:`SHARED_OPENINGS` of all texts share.

    ``leads``: how many these are of each text, where not all texts are at hand.
    """
    parts = [_sentences(t) for t in texts]
    if leads is None:
        openings = [_openings(p) for p in parts]
        known = Counter(key for o in openings for key in enumerate(o))
        leads = [next((k for k, s in enumerate(o) if known[(k, s)] < SHARED_OPENINGS), len(o)) for o in openings]
    return [" ".join(p[k:]) for p, k in zip(parts, leads)]


@dataclass
class Flat:
    """Letters and digits in lower case with one blank for every other run, by text."""

    code: np.ndarray
    doc: np.ndarray


def flatten(text: K.Chars) -> Flat:
    keep = (text.kind & (K.LETTER | K.NUMBER | K.MARK)) > 0
    chosen = keep.copy()
    chosen[1:] |= keep[:-1]
    at = np.flatnonzero(chosen)
    doc = np.repeat(np.arange(text.docs, dtype=np.int32), np.diff(text.offset))[at]
    return Flat(np.where(keep[at], text.low[at], np.uint32(32)), doc)


def grams(flat: Flat) -> tuple[np.ndarray, np.ndarray]:
    """Hash of the q-gram that starts at each position, and True where it lies within one text."""
    count = max(0, len(flat.code) - Q + 1)
    wide = flat.code.astype(np.uint64)
    total = np.zeros(count, np.uint64)
    for k in range(Q):
        total *= np.uint64(0x9E3779B97F4A7C15)
        total += wide[k : k + count]
    return K.mix(total), flat.doc[:count] == flat.doc[Q - 1 :][:count]


class Items:
    """The items of one block: codes, and their grams sorted by hash with item and position."""

    STORED = ("ids", "code", "length", "begin", "hash", "first", "count", "item", "place")

    def __init__(self, ids: list[int], texts: list[str]):
        self.ids = np.array(ids, np.int64)
        flat = flatten(K.chars(pa.array(texts, pa.string())))
        self.code = flat.code
        self.length = np.bincount(flat.doc, minlength=len(texts)).astype(np.int64)
        self.begin = np.concatenate([[0], np.cumsum(self.length)])[:-1]
        found, inside = grams(flat)
        at = np.flatnonzero(inside)
        order = np.argsort(found[at], kind="stable")
        at = at[order]
        self.hash, self.first = np.unique(found[at], return_index=True)
        self.count = np.diff(np.append(self.first, len(at)))
        self.item = flat.doc[at].astype(np.int64)
        self.place = at - self.begin[self.item]
        self._mark()

    def _mark(self) -> None:
        self.table = np.zeros(1 << _TABLE_BITS, bool)
        self.table[(self.hash >> np.uint64(64 - _TABLE_BITS)).astype(np.int64)] = True

    @classmethod
    def searched(cls, ids: list[int], texts: list[str]) -> Items:
        """The items that have a gram at all."""
        block = cls(ids, texts)
        long = block.length >= LEAST_WORDING
        return block if long.all() else cls([i for i, k in zip(ids, long) if k], [t for t, k in zip(texts, long) if k])

    def store(self, path: str) -> None:
        system, inside = located(path)
        with system.open_output_stream(inside) as out:
            packed = io.BytesIO()
            np.savez(packed, **{n: getattr(self, n) for n in self.STORED})
            out.write(packed.getvalue())

    @classmethod
    def stored(cls, path: str) -> Items:
        system, inside = located(path)
        with system.open_input_file(inside) as file:
            packed = np.load(io.BytesIO(file.read()))
        found = cls.__new__(cls)
        for n in cls.STORED:
            setattr(found, n, packed[n])
        found._mark()
        return found

    def hits(self, flat: Flat) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(doc, doc position, item, item position) of all shared grams."""
        found, inside = grams(flat)
        at = np.flatnonzero(self.table[(found >> np.uint64(64 - _TABLE_BITS)).astype(np.int64)] & inside)
        where = np.minimum(np.searchsorted(self.hash, found[at]), max(0, len(self.hash) - 1))
        real = self.hash[where] == found[at] if len(self.hash) else np.zeros(0, bool)
        at, where = at[real], where[real]
        times = self.count[where]
        place = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times) + np.repeat(self.first[where], times)
        at = np.repeat(at, times)
        return flat.doc[at].astype(np.int64), at.astype(np.int64), self.item[place], self.place[place]


def _unique_counts(*parts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(group of each row, size of each group) of rows that agree in all parts; numbers of groups may have gaps.

    The parts are packed into one number, which is the group where its range is small, else it is sorted; parts too wide
    for that are sorted one after the other.
    """
    count = len(parts[0])
    if not count:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    key, span = np.zeros(count, np.int64), 1
    for part in parts:
        low = int(part.min())
        width = int(part.max()) - low + 1
        span *= width
        if span >= 1 << 62:
            break
        key = key * width + (part - low)
    if span <= max(1 << 20, 4 * count):
        return key, np.bincount(key)
    order = np.argsort(key) if span < 1 << 62 else np.lexsort(parts)
    new = np.ones(count, bool)
    if span < 1 << 62:
        ordered = key[order]
        new[1:] = ordered[1:] != ordered[:-1]
    else:
        new[1:] = np.any([p[order][1:] != p[order][:-1] for p in parts], axis=0)
    group = np.empty(count, np.int64)
    group[order] = np.cumsum(new) - 1
    return group, np.bincount(group)


def least_grams(length: np.ndarray, least_share: float) -> tuple[np.ndarray, np.ndarray]:
    """(grams, short): grams that the least part of an item that counts shares by the q-gram lemma, and whether it is shorter than a window.

    Edits are in proportion to the part; where the bound leaves nothing, one gram is enough.
    """
    part = np.ceil(least_share * length).astype(np.int64)
    bound = part + 1 - Q - Q * (EDITS * part // WINDOW)
    return np.clip(bound, 1, LEAST_GRAMS), part < WINDOW


def search(flat: Flat, items: Items, least_share: float) -> list[tuple[int, int, float]]:
    """(doc, item, share) of the items of which a text holds at least ``least_share`` of the wording, in order."""
    doc, at, item, place = items.hits(flat)
    if not len(doc):
        return []
    # a text shares too few grams with most items for anything to follow; drop those first
    pair, size = _unique_counts(doc, item)
    grams_of, short = least_grams(items.length, least_share)
    # every region of WINDOW characters that may count holds LEAST_GRAMS of them, so fewer cannot add up to the share
    fewest = np.where(short, grams_of, np.maximum(LEAST_GRAMS, least_share * items.length * (LEAST_GRAMS / WINDOW)))
    enough = size[pair] >= fewest[item]
    doc, at, item, place = doc[enough], at[enough], item[enough], place[enough]
    if not len(doc):
        return []
    # overlapping windows of the item times overlapping diagonal bands: the q-gram lemma's regions. Diagonals count from the
    # text's own beginning, so nothing depends on which texts share a block
    diagonal = at - np.searchsorted(flat.doc, doc) - place
    kept = np.zeros(len(doc), bool)
    for shift in (0, 1):
        for band_shift in (0, 1):
            window = np.where(short[item], 0, (place + shift * (WINDOW // 2)) // WINDOW)
            band = (diagonal + band_shift * (BAND // 2)) // BAND
            region, count = _unique_counts(doc, item, window, band)
            kept |= count[region] >= grams_of[item]
    doc, at, item, place, diagonal = doc[kept], at[kept], item[kept], place[kept], diagonal[kept]
    pair, _ = _unique_counts(doc, item)
    spot, _ = _unique_counts(pair, place)
    distinct = np.zeros(len(doc), bool)
    distinct[np.unique(spot, return_index=True)[1]] = True
    covered = np.bincount(pair[distinct], minlength=pair.max() + 1 if len(pair) else 0)
    enough = covered[pair] >= np.where(short, grams_of, least_share * items.length * (LEAST_GRAMS / WINDOW))[item]
    doc, at, item, place, diagonal = doc[enough], at[enough], item[enough], place[enough], diagonal[enough]
    if not len(doc):
        return []
    segments = _segments(doc, at, item, place, diagonal, np.where(short, 1, Q))
    credit = _aligned(flat, items, segments)
    return _chain(segments, credit, items, least_share)


def _segments(doc, at, item, place, diagonal, fewest) -> np.ndarray:
    """Rows (doc, item, doc start, doc end, item start, item end) of hits that follow each other on near diagonals, ``fewest`` of the item at least."""
    # diagonals that lie within DRIFT of a neighbour form one cluster within a pair
    order = np.lexsort((diagonal, item, doc))
    new = np.ones(len(order), bool)
    d, i, g = doc[order], item[order], diagonal[order]
    new[1:] = (d[1:] != d[:-1]) | (i[1:] != i[:-1]) | (g[1:] - g[:-1] > DRIFT)
    cluster = np.empty(len(order), np.int64)
    cluster[order] = np.cumsum(new) - 1
    order = np.lexsort((at, place // SEGMENT, cluster))
    doc, at, item, place, cluster = doc[order], at[order], item[order], place[order], cluster[order]
    piece = place // SEGMENT
    new = np.ones(len(order), bool)
    new[1:] = (cluster[1:] != cluster[:-1]) | (piece[1:] != piece[:-1]) | (at[1:] - at[:-1] > GAP)
    start = np.flatnonzero(new)
    count = np.diff(np.append(start, len(at)))
    rows = [doc[start], item[start], at[start], np.maximum.reduceat(at, start) + Q, np.minimum.reduceat(place, start), np.maximum.reduceat(place, start) + Q]
    return np.stack(rows, axis=1)[count >= fewest[item[start]]]


def _aligned(flat: Flat, items: Items, segments: np.ndarray) -> np.ndarray:
    """Item characters less edits of each segment if banded alignment finds few enough edits, else 0.

    The band holds the diagonals between both ends of the segment and DRIFT more on either side.
    """
    credit = np.zeros(len(segments))
    length, taken = segments[:, 5] - segments[:, 4], segments[:, 3] - segments[:, 2]
    skew = np.abs(taken - length)
    credit_from = np.flatnonzero(skew <= EDIT_SHARE * length)  # more insertions or deletions than edits are allowed
    order = credit_from[np.lexsort((length[credit_from], skew[credit_from]))]
    for chosen in np.array_split(order, max(1, -(-len(order) // 256))):
        if not len(chosen):
            continue
        s, n, m = segments[chosen], length[chosen], taken[chosen]
        low = int(np.minimum(0, m - n).min()) - DRIFT
        offset = np.arange(low, int(np.maximum(0, m - n).max()) + DRIFT + 1)
        ramp, far = np.arange(len(offset)), 10**6
        cost = np.broadcast_to(np.where(offset >= 0, offset, far), (len(chosen), len(offset))).copy()
        for step in range(1, int(n.max()) + 1):
            symbol = items.code[items.begin[s[:, 1]] + np.minimum(s[:, 4] + step - 1, s[:, 5] - 1)]
            column = offset + step  # characters of the document consumed on each diagonal
            inside = (column >= 0) & (column <= m[:, None])
            other = flat.code[np.clip(s[:, 2][:, None] + column - 1, 0, len(flat.code) - 1)]
            fresh = np.where(inside & (column >= 1), cost + (other != symbol[:, None]), far)
            fresh[:, :-1] = np.minimum(fresh[:, :-1], cost[:, 1:] + 1)
            fresh = np.where(inside, fresh, far)
            fresh = np.minimum.accumulate(fresh - ramp, axis=1) + ramp
            cost = np.where((step <= n)[:, None], np.where(inside, fresh, far), cost)
        edits = cost[np.arange(len(chosen)), m - n - low]
        credit[chosen] = np.where(edits <= EDIT_SHARE * n, n - edits, 0)
    return credit


def _chain(segments: np.ndarray, credit: np.ndarray, items: Items, least_share: float) -> list[tuple[int, int, float]]:
    """Best sum of credits of segments that follow each other in text and item, for each pair."""
    out = []
    order = np.lexsort((segments[:, 3], segments[:, 1], segments[:, 0]))
    segments, credit = segments[order], credit[order]
    new = np.flatnonzero(np.r_[True, np.any(segments[1:, :2] != segments[:-1, :2], axis=1)]) if len(segments) else []
    for a, b in zip(new, [*new[1:], len(segments)]):
        rows, gain = segments[a:b], credit[a:b]
        if gain.sum() < least_share * items.length[rows[0, 1]]:
            continue
        best = gain.copy()
        for k in range(1, len(rows)):
            before = np.flatnonzero((rows[:k, 4] <= rows[k, 4]) & (rows[:k, 2] <= rows[k, 2]))  # ends are in order already
            if len(before):
                overlap = np.maximum(0, rows[before, 5] - rows[k, 4])
                best[k] = max(gain[k], float((best[before] + np.maximum(0.0, gain[k] - overlap)).max()))
        share = best.max() / items.length[rows[0, 1]]
        if share >= least_share:
            out.append((int(rows[0, 0]), int(rows[0, 1]), min(1.0, float(share))))
    return out


def leaked_items(documents: DataFrame, benchmark: DataFrame, least_share: float = 0.5) -> DataFrame:
    """(doc_id, item_id, share): documents that hold at least ``least_share`` of an item's own wording, in its order.

    Texts are compared as lower-case letters and digits, whatever else stands between them; markup and escapes are
    taken out. Opening sentences that several items share are instructions and do not count; an item with fewer letters,
    digits and blanks of its own than a q-gram has (:data:`LEAST_WORDING`) cannot be told from chance and is in no document.
    A part counts from a window's grams on (32 characters verbatim), of items under two windows at the default share from
    the grams of that share. Every document is read once, whole and without a shuffle. Up to four million characters of
    items are sent along with the tasks; more are stored in blocks of that size, and a group of documents is compared with
    one block after the other. Null ids and empty texts yield nothing.
    """
    items = benchmark.where("item_id is not null and text is not null").select("item_id", "text")
    size = items.agg(F.coalesce(F.sum(F.length("text")), F.lit(0))).first()[0]
    pieces = max(1, -(-size // BLOCK_ITEM_CHARS))
    cleaned = F.when(F.col("text").rlike(r"[<&\\]"), F.regexp_replace("text", _MARKUP, " ")).otherwise(F.col("text"))
    chosen = documents.where("doc_id is not null and text is not null").select(F.col("doc_id").cast("bigint").alias("doc_id"), cleaned.alias("text"))
    if pieces == 1:
        rows = items.collect()  # BLOCK_ITEM_CHARS characters at most
        shared = documents.sparkSession.sparkContext.broadcast(Items.searched([r["item_id"] for r in rows], own_wording([r["text"] for r in rows])))
        blocks: Callable[[], Iterable[Items]] = lambda: (shared.value,)
        limit = K.BLOCK_CHARS
    else:
        paths = _store_blocks(_with_leads(items), pieces, scratch(documents.sparkSession, "items"))
        blocks = lambda: map(Items.stored, paths)
        limit = GROUP_CHARS

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, texts in _grouped(batches, limit):
            flat = flatten(K.chars(texts))
            for known in blocks():
                got = search(flat, known, least_share)
                if got:
                    doc, item, share = zip(*got)
                    yield pa.RecordBatch.from_arrays([ids.take(pa.array(doc)), pa.array(known.ids[np.array(item)]), pa.array(np.array(share, np.float64))], ["doc_id", "item_id", "share"])

    return chosen.mapInArrow(run, "doc_id bigint, item_id bigint, share double")


def _grouped(batches: Iterator[pa.RecordBatch], limit: int) -> Iterator[tuple[pa.Array, pa.Array]]:
    """(ids, texts) of about ``limit`` bytes each, across batches; a longer text is a group of its own and never cut."""
    held: list[pa.RecordBatch] = []
    size = 0

    def flush() -> tuple[pa.Array, pa.Array]:
        return tuple(pa.concat_arrays([b.column(i) for b in held]) for i in (0, 1))

    for batch in batches:
        if not batch.num_rows:
            continue
        length = pc.binary_length(batch.column(1)).to_numpy(zero_copy_only=False).astype(np.int64)
        start = 0
        while start < batch.num_rows:
            reached = np.cumsum(length[start:]) + size
            end = start + max(int(np.searchsorted(reached, limit, side="right")), 0 if held else 1)
            if end > start:
                held.append(batch.slice(start, end - start))
                size += int(length[start:end].sum())
                start = end
            if start < batch.num_rows or size >= limit:
                yield flush()
                held, size = [], 0
    if held:
        yield flush()


def _store_blocks(items: DataFrame, pieces: int, folder: str) -> list[str]:
    """Files of the blocks of items in the shared folder, built by tasks."""

    def build(pdf: pd.DataFrame) -> pd.DataFrame:
        path = f"{folder}/block-{int(pdf['_block'].iloc[0]):06d}.npz"
        system, inside = located(path)
        system.create_dir(inside.rpartition("/")[0], recursive=True)
        Items.searched(pdf["item_id"].tolist(), own_wording(pdf["text"].tolist(), pdf["lead"].tolist())).store(path)
        return pd.DataFrame({"path": [path]})

    blocks = items.withColumn("_block", F.pmod(F.xxhash64("item_id"), F.lit(pieces)))
    return sorted(r["path"] for r in blocks.groupBy("_block").applyInPandas(build, "path string").collect())  # one row per block


def _with_leads(items: DataFrame) -> DataFrame:
    """``items`` with ``lead``, the number of opening sentences that they share: :func:`own_wording` for any number of items."""
    named = items.select(F.col("item_id").cast("bigint").alias("item_id"), "text", F.md5("text").alias("digest"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [(i, d, k, s) for i, t, d in zip(*(c.to_pylist() for c in batch.columns)) for k, s in enumerate(_openings(_sentences(t)))]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*found) if found else [()] * 4, (pa.int64(), pa.string(), pa.int32(), pa.string()))], ["item_id", "digest", "k", "s"])

    openings = materialize(named.mapInArrow(run, "item_id bigint, digest string, k int, s string"), "openings")
    shared = openings.groupBy("k", "s").agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") >= SHARED_OPENINGS).select("k", "s", F.lit(True).alias("_shared"))
    leads = openings.join(shared, ["k", "s"], "left").groupBy("item_id", "digest").agg(F.coalesce(F.min(F.when(F.col("_shared").isNull(), F.col("k"))), F.max("k") + 1).alias("lead"))
    return materialize(named.join(leads, ["item_id", "digest"], "left").select("item_id", "text", F.coalesce("lead", F.lit(0)).alias("lead")), "items")
