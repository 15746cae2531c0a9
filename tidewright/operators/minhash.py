"""Near-duplicate removal by MinHash and banded locality-sensitive hashing."""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType

from tidewright.functions.text import BLANK, MARK, distinct_runs, ngram_hashes, squash, token_hashes
from tidewright.operators.components import connected_components
from tidewright.runtime import BROADCAST_ROWS, broadcast_if_small, materialize

#: Modulus of the permutations (a * h + c) mod PRIME; hashes and coefficients stay below it, products within 64 bits.
PRIME = (1 << 31) - 1
#: Probability with which a pair right at the threshold may share no band where candidates are verified.
MISS = 1e-8
#: Shingles whose permutations are computed at once (they stay in the cache).
AT_ONCE = 1 << 16


@dataclass
class Settings:
    enabled: bool = True
    tokenization: str = "space"
    window_size: int = 5
    lowercase: bool = True
    ignore_pattern: str | None = None
    tokenizer_model: str | None = None
    num_permutations: int = 256
    jaccard_threshold: float = 0.8
    #: Verify candidates on their shingle sets; without it all records that share a band are duplicates.
    verify: bool = True
    #: Hash function of the shingles (xxhash or sha1) and its bits (32 or 64).
    hash_fc: str = "xxhash"
    precision: int = 64
    #: Seed of the permutations, and bands and rows per band where they are not to be chosen by the threshold.
    seed: int = 1
    bands: int | None = None
    rows: int | None = None


def optimal_bands(threshold: float, permutations: int, steps: int = 200) -> tuple[int, int]:
    """(bands, rows) that minimise false positives plus false negatives, both weighing the same.

    A pair of similarity s meets in a band with probability 1 - (1 - s^rows)^bands; the areas under that curve below,
    and above it past, the threshold are summed by the midpoint rule.
    """
    best, chosen = math.inf, (1, 1)
    for bands in range(1, permutations + 1):
        for rows in range(1, permutations // bands + 1):
            meet = lambda s: 1 - (1 - s**rows) ** bands
            low = sum(meet(threshold * (i + 0.5) / steps) for i in range(steps)) * threshold / steps
            high = sum(1 - meet(threshold + (1 - threshold) * (i + 0.5) / steps) for i in range(steps)) * (1 - threshold) / steps
            if low + high < best - 1e-12:
                best, chosen = low + high, (bands, rows)
    return chosen


def recall_bands(threshold: float, permutations: int) -> tuple[int, int]:
    """(bands, rows) of the most rows with which a pair at the threshold is missed with probability MISS at most.

    51 x 5 at 0.8 and 256 permutations. Should the permutations be too few for MISS, rows are 1.
    """
    fits = (r for r in range(permutations, 0, -1) if (1 - threshold**r) ** (permutations // r) <= MISS)
    rows = next(fits, 1)
    return permutations // rows, rows


def tokens(text: Column, settings: Settings) -> Column:
    """Tokens by the chosen way: words between blanks, words and marks, characters, or sentencepiece pieces."""
    source = F.coalesce(text, F.lit(""))
    source = F.lower(source) if settings.lowercase else source
    source = F.regexp_replace(source, settings.ignore_pattern, "") if settings.ignore_pattern else source
    if settings.tokenization == "space":
        return F.filter(F.split(squash(source), " "), lambda t: t != "")
    if settings.tokenization == "punctuation":
        return F.regexp_extract_all(source, F.lit(rf"[^{BLANK}\p{{P}}\p{{S}}]+|{MARK}"), F.lit(0))
    if settings.tokenization == "character":
        return F.filter(F.split(source, ""), lambda t: t != "")
    if settings.tokenization == "sentencepiece":
        return _pieces(source, settings.tokenizer_model)
    raise ValueError(f"unknown tokenization: {settings.tokenization}")


def _pieces(text: Column, model: str | None) -> Column:
    if not model:
        raise ValueError("tokenization sentencepiece needs tokenizer_model")

    def run(values: pa.Array) -> pa.Array:
        import sentencepiece

        loaded = sentencepiece.SentencePieceProcessor(model_file=model)
        return pa.array(loaded.encode(values.fill_null("").to_pylist(), out_type=str, num_threads=1), pa.list_(pa.string()))

    return F.arrow_udf(run, ArrayType(StringType()))(text)


def shingles(text: Column, settings: Settings) -> Column:
    """Distinct runs of ``window_size`` tokens, joined by a blank; a shorter text is one run, an empty text has none."""
    size = settings.window_size

    def runs(t: Column) -> Column:
        joined = F.transform(F.sequence(F.lit(1), F.greatest(F.lit(1), F.size(t) - size + 1)), lambda i: F.array_join(F.slice(t, i, size), " "))
        return F.when(F.size(t) == 0, F.array().cast("array<string>")).otherwise(F.array_distinct(joined))

    # a lambda over an array of one element binds the tokens once
    return F.element_at(F.transform(F.array(tokens(text, settings)), runs), 1)


def base_hash(shingle: Column) -> Column:
    """The first 32 bits of the MD5 digest as an integer (a form that other SQL engines can compute as well)."""
    return F.conv(F.substring(F.md5(shingle), 1, 8), 16, 10).cast("bigint")


def coefficients(count: int, seed: int = 1) -> list[tuple[int, int]]:
    """Multipliers and offsets of the permutations, from a linear congruential generator."""
    state, out = (seed * 2 + 1) % PRIME, []
    for _ in range(count):
        state = state * 48271 % PRIME
        a = state
        state = state * 48271 % PRIME
        out.append((max(1, a), state))
    return out


def signature(hashes: Column, count: int, seed: int = 1) -> Column:
    """The smallest permuted hash for each of ``count`` permutations; null for an empty set."""
    pairs = F.array(*[F.struct(F.lit(a).cast("bigint").alias("a"), F.lit(c).cast("bigint").alias("c")) for a, c in coefficients(count, seed)])
    reduced = F.transform(hashes, lambda h: h % PRIME)
    least = F.transform(pairs, lambda p: F.array_min(F.transform(reduced, lambda h: (p["a"] * h + p["c"]) % PRIME)))
    return F.when(F.size(hashes) > 0, least)


def signatures(df: DataFrame, settings: Settings, text: str = "text") -> DataFrame:
    """``df`` with ``_signature``, in the JVM and without a shuffle."""
    hashed = df.withColumn("_hashes", F.transform(shingles(F.col(text), settings), base_hash))
    return hashed.withColumn("_signature", signature(F.col("_hashes"), settings.num_permutations, settings.seed)).drop("_hashes")


def signatures_in_batches(df: DataFrame, settings: Settings, keep: list[str], text: str = "text") -> DataFrame:
    """(keep, _signature) with the permutations done in numpy over Arrow batches; the values equal :func:`signatures`."""
    hashed = df.select(*keep, F.transform(shingles(F.col(text), settings), base_hash).alias("_hashes"))
    kept = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in hashed.schema.fields[:-1])
    pairs = np.array(coefficients(settings.num_permutations, settings.seed), np.int64)

    def run(batches):
        for batch in batches:
            column = batch.column(batch.num_columns - 1)
            values = column.flatten().to_numpy(zero_copy_only=False).astype(np.int64) % PRIME
            sizes = np.diff(column.offsets.to_numpy())
            filled = np.flatnonzero(sizes)
            starts = (np.cumsum(sizes) - sizes)[filled]
            least = np.empty((len(filled), len(pairs)), np.int64)
            if len(filled):
                for k, (a, c) in enumerate(pairs):
                    least[:, k] = np.minimum.reduceat((a * values + c) % PRIME, starts)
            offsets = np.concatenate([[0], np.cumsum(np.where(sizes > 0, len(pairs), 0))]).astype(np.int32)
            mask = pa.array(sizes == 0)
            lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(least.ravel()), mask=mask)
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in range(batch.num_columns - 1)), lists], [*keep, "_signature"])

    return hashed.mapInArrow(run, f"{kept}, _signature array<bigint>")


def bands(settings: Settings) -> tuple[int, int]:
    if settings.bands and settings.rows:
        return settings.bands, settings.rows
    if settings.verify:
        return recall_bands(settings.jaccard_threshold, settings.num_permutations)
    return optimal_bands(settings.jaccard_threshold, settings.num_permutations)


def band_keys(signed: DataFrame, settings: Settings, keep: list[str]) -> DataFrame:
    """(keep, band, key): one row per band of each signature; rows without shingles have none."""
    number, rows = bands(settings)
    keys = F.transform(F.sequence(F.lit(0), F.lit(number - 1)), lambda b: F.md5(F.array_join(F.slice("_signature", b * rows + 1, rows), ",")))
    return signed.where("_signature is not null").select(*keep, F.posexplode(keys).alias("band", "key"))


def candidate_links(keyed: DataFrame, identity: str) -> DataFrame:
    """(src, dst): every record linked to the smallest one of its bucket, for each band.

    Linking to the bucket's minimum keeps a bucket of any size linear; the minimum comes from a partial aggregate, and
    buckets of one record fall away before the join back.
    """
    least = keyed.groupBy("band", "key").agg(F.min(identity).alias("src"), F.count(F.lit(1)).alias("_n")).where("_n > 1").drop("_n")
    return keyed.join(least, ["band", "key"]).where(F.col(identity) != F.col("src")).select("src", F.col(identity).alias("dst")).distinct()


def _mix(x: np.ndarray) -> np.ndarray:
    """Finaliser of splitmix64."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingle_hashes(text: Column, settings: Settings) -> Column:
    """The shingle set as hashes of 64 bits; those of 32 bits fill the upper half, which the permutations read.

    With xxhash each token is hashed once and each run of token hashes again, so that no strings are joined.
    """
    if settings.hash_fc not in ("xxhash", "sha1") or settings.precision not in (32, 64):
        raise ValueError(f"unknown hash function or precision: {settings.hash_fc}, {settings.precision}")
    cut = (lambda h: F.shiftleft(F.shiftrightunsigned(h, 32), 32)) if settings.precision == 32 else (lambda h: h)
    if settings.hash_fc == "sha1":
        return F.transform(shingles(text, settings), lambda s: cut(F.conv(F.substring(F.sha1(s), 1, 16), 16, -10).cast("bigint")))
    hashed = ngram_hashes(tokens(text, settings), settings.window_size, short=True)
    return F.array_distinct(F.transform(hashed, cut)) if settings.precision == 32 else hashed


#: Languages that do not set words apart: their n-grams are of characters. Fixed values.
UNSPACED = ("chinese", "japanese", "thai", "lao", "khmer", "burmese", "tibetan", "zh", "ja", "th", "lo", "km", "my", "bo")


def minhash_block(df: DataFrame, identity: str, n_grams: int = 5, num_buckets: int | None = None, hashes_per_bucket: int | None = None, seed: int = 1, precision: int = 64, hash_fc: str = "xxhash", language: str = "english", threshold: float = 0.8) -> dict[str, DataFrame]:
    """Near-duplicate removal by the options of the manual's block: ``output`` (records that stay), ``buckets`` and ``remove_ids``.

    ``buckets`` has (identity, keys) of every record with tokens, ``remove_ids`` the records that are left out; the schema of
    the records is unchanged. Without ``num_buckets`` and ``hashes_per_bucket`` they follow from the threshold, so that no
    pair at it is missed; given ones may miss pairs (10 x 8 finds 0.84 of the pairs right at 0.8). Candidates are always
    verified on their whole sets.
    """
    settings = Settings(tokenization="character" if language.lower() in UNSPACED else "space", window_size=n_grams, jaccard_threshold=threshold, seed=seed, bands=num_buckets, rows=hashes_per_bucket, hash_fc=hash_fc, precision=precision)
    narrow = df.select(identity, "text")
    removed = near_duplicate_groups(narrow, settings, identity).where("node <> root").select(F.col("node").alias(identity))
    return {"output": df.join(removed, identity, "left_anti"), "buckets": set_keys(narrow, settings, identity).select(identity, "keys"), "remove_ids": removed}


def set_keys(df: DataFrame, settings: Settings, identity: str, text: str = "text") -> DataFrame:
    """(identity, n, d1, d2, keys) of every non-empty shingle set: its size, its digest of 128 bits and a key per band."""
    number, rows = bands(settings)
    # the runs of tokens are hashed in the same pass that permutes them, if that needs no strings
    direct = settings.hash_fc == "xxhash" and settings.precision == 64
    hashed = df.select(identity, (token_hashes(tokens(F.col(text), settings)) if direct else shingle_hashes(F.col(text), settings)).alias("_hashes"))
    kind = hashed.schema.fields[0].dataType.simpleString()
    pairs = coefficients(number * rows, settings.seed)

    def run(batches):
        for batch in batches:
            column = batch.column(1)
            values = column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)
            sizes = np.diff(column.offsets.to_numpy()).astype(np.int64)
            if direct:
                values, sizes = distinct_runs(values, sizes, settings.window_size, short=True)
            filled = np.flatnonzero(sizes)
            if not len(filled):
                continue
            ends = np.cumsum(sizes)[filled]
            starts = ends - sizes[filled]
            keys = np.empty((len(filled), number), np.uint64)
            for part in np.split(np.arange(len(filled)), np.flatnonzero(np.diff(starts // AT_ONCE)) + 1):
                base, at = (values[starts[part[0]] : ends[part[-1]]] >> np.uint64(33)).astype(np.int64), starts[part] - starts[part[0]]
                least = np.empty((number * rows, len(part)), np.int64)
                for k, (a, c) in enumerate(pairs):
                    x = a * base + c
                    x = (x & PRIME) + (x >> 31)  # congruent modulo PRIME
                    least[k] = np.minimum.reduceat((x & PRIME) + (x >> 31), at)
                by_band = least.astype(np.uint64).reshape(number, rows, len(part))
                key = np.repeat(np.arange(number, dtype=np.uint64)[:, None], len(part), axis=1)
                for r in range(rows):
                    key = _mix(key * np.uint64(0x9E3779B97F4A7C15) + by_band[:, r])
                keys[part] = key.T
            digests = [np.add.reduceat(_mix(values ^ np.uint64(salt)), starts).view(np.int64) for salt in (0, 0x5851F42D4C957F2D)]
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(filled) + 1, dtype=np.int32) * number), pa.array(keys.view(np.int64).ravel()))
            columns = [batch.column(0).take(pa.array(filled)), pa.array(sizes[filled].astype(np.int32)), *map(pa.array, digests), lists]
            yield pa.RecordBatch.from_arrays(columns, [identity, "n", "d1", "d2", "keys"])

    return hashed.mapInArrow(run, f"`{identity}` {kind}, n int, d1 bigint, d2 bigint, keys array<bigint>")


#: Records of a bucket from which it is spread over SALTS tasks when it is joined with its members.
HOT_BUCKET, SALTS = 10_000, 64


def _to_members(members: DataFrame, buckets: DataFrame, identity: str) -> DataFrame:
    """``members`` of the given buckets (key, _n, ...) with their columns but the count; a hot bucket is spread over several tasks."""
    if buckets.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS:
        return members.join(F.broadcast(buckets.drop("_n")), "key")
    hot = buckets.where(F.col("_n") > HOT_BUCKET).select("key", F.lit(True).alias("_hot"))
    salted = members.join(broadcast_if_small(hot), "key", "left").withColumn("_salt", F.when(F.col("_hot"), F.pmod(F.xxhash64(identity), F.lit(SALTS)).cast("int")).otherwise(F.lit(0))).drop("_hot")
    copies = F.when(F.col("_n") > HOT_BUCKET, F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(F.array(F.lit(0)))
    return salted.join(buckets.withColumn("_salt", F.explode(copies)).drop("_n"), ["key", "_salt"]).drop("_salt")


def verified_links(df: DataFrame, settings: Settings, identity: str, text: str = "text") -> DataFrame:
    """(src, dst): links whose components are those of all pairs that share a band and reach the threshold.

    Records of equal sets collapse to one first. Of every bucket the members are compared with its smallest one; what
    that leaves in different components of a bucket is then compared pair by pair, so a smallest member that is no
    duplicate costs no link. Pairs are compared on whole shingle sets, never by an estimate. Buckets of many records
    that are alike but under the threshold cost the square of their components.
    """
    least_share = F.lit(settings.jaccard_threshold)
    base = materialize(set_keys(df, settings, identity, text), "set_keys")
    same = base.groupBy("n", "d1", "d2").agg(F.min(identity).alias("src"), F.count(F.lit(1)).alias("_n")).where("_n > 1").drop("_n")
    copies = materialize(base.select(identity, "n", "d1", "d2").join(same, ["n", "d1", "d2"]).where(F.col(identity) != F.col("src")).select("src", F.col(identity).alias("dst")), "copies")
    single = base.join(copies.select(F.col("dst").alias(identity)), identity, "left_anti")
    keyed = single.select(identity, "n", F.explode("keys").alias("key"))
    # buckets are folded by partial aggregates; only those of several records come back to their members
    least = keyed.groupBy("key").agg(F.min(F.struct(F.col(identity).alias("id"), "n")).alias("_least"), F.count(F.lit(1)).alias("_n")).where("_n > 1")
    members = materialize(_to_members(keyed, materialize(least, "buckets"), identity), "members")
    sets = materialize(df.join(members.select(identity).distinct(), identity, "left_semi").select(identity, shingle_hashes(F.col(text), settings).alias("_set")), "candidate_sets")

    def sized(a: str, b: str) -> Column:  # similarity is at most the ratio of the sizes
        return F.least(a, b) / F.greatest(a, b) >= least_share

    def holding(pairs: DataFrame) -> DataFrame:
        found = pairs.join(sets.select(F.col(identity).alias("src"), F.col("_set").alias("_a")), "src").join(sets.select(F.col(identity).alias("dst"), F.col("_set").alias("_b")), "dst")
        found = found.select("src", "dst", F.size(F.array_intersect("_a", "_b")).alias("_both"), (F.size("_a") + F.size("_b")).alias("_sum"))
        return found.where(F.col("_both") / (F.col("_sum") - F.col("_both")) >= least_share).select("src", "dst")

    stars = members.where((F.col(identity) != F.col("_least.id")) & sized("n", "_least.n")).select(F.col("_least.id").alias("src"), F.col(identity).alias("dst")).distinct()
    first = materialize(holding(stars), "links")
    parts = connected_components(first).select(F.col("node").alias(identity), F.col("root").alias("_part"))
    placed = members.join(parts, identity, "left").select("key", F.col(identity).alias("id"), "n", F.coalesce("_part", identity).alias("part"))
    mixed = placed.groupBy("key").agg(F.min("part").alias("_low"), F.max("part").alias("_high"), F.count(F.lit(1)).alias("_n")).where("_low <> _high").select("key", "_n")
    apart = materialize(_to_members(placed, materialize(mixed, "mixed"), "id"), "apart")
    a, b = (apart.select("key", *[F.col(c).alias(f"{c}_{side}") for c in ("id", "n", "part")]) for side in "ab")
    crossing = a.join(b, "key").where((F.col("id_a") < F.col("id_b")) & (F.col("part_a") != F.col("part_b")) & sized("n_a", "n_b"))
    second = holding(crossing.select(F.col("id_a").alias("src"), F.col("id_b").alias("dst")).distinct())
    return first.unionByName(second).unionByName(copies)


def near_duplicate_groups(df: DataFrame, settings: Settings, identity: str, text: str = "text") -> DataFrame:
    """(node, root) of all records that are linked to another one; ``identity`` must be unique and ordered."""
    if settings.verify:
        return connected_components(verified_links(df, settings, identity, text))
    signed = materialize(signatures_in_batches(df, settings, [identity], text), "signatures")
    return connected_components(candidate_links(band_keys(signed, settings, [identity]), identity))


def remove_near_duplicates(df: DataFrame, settings: Settings, order: list[str], text: str = "text") -> DataFrame:
    """``df`` without near-duplicates: of every group of linked records the first in ``order`` stays.

    ``order`` must name columns that together are unique (such as source order and row number). Records without tokens
    are never duplicates. The text itself is not shuffled before the last anti-join.
    """
    named = df.withColumn("__record", F.struct(*order))
    groups = near_duplicate_groups(named.select("__record", text), settings, "__record", text)
    return named.join(groups.where("node <> root").select(F.col("node").alias("__record")), "__record", "left_anti").drop("__record")
