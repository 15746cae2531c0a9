"""Duplicates hidden by formatting differences (problem 5)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewright.llm import sketches
from tidewright.runtime import broadcast_if_small, latest_by, materialize

#: Groups beyond this many copies are spread over SALTS tasks when copies are joined to their group.
HOT_COPIES, SALTS = 10_000, 64


def canonical_text(text: Column) -> Column:
    """Lower case; whatever is neither letter, mark nor digit separates; separators next to Han characters vanish."""
    plain = F.trim(F.regexp_replace(F.replace(F.lower(text), F.lit("ß"), F.lit("ss")), r"[^\p{L}\p{N}\p{M}]+", " "))
    return F.when(plain.rlike(r"\p{IsHan}"), F.regexp_replace(plain, r"(?<=\p{IsHan}) | (?=\p{IsHan})", "")).otherwise(plain)


def canonical_json(text: Column) -> Column:
    """The JSON value with the fields of all its objects in alphabetical order; other text as it is."""
    looks = text.rlike(r"^\s*[\[{]")
    return F.when(looks, F.coalesce(F.to_json(F.try_parse_json(text)), text)).otherwise(text)


def canonical_record(messages: Column, text: Column) -> Column:
    """Canonical form of a record's messages (roles, contents, tool calls in order), else of its text; null without both."""
    one = lambda m: F.concat_ws("\u0001", F.lower(F.trim(F.coalesce(m["role"], F.lit("")))), canonical_text(F.coalesce(m["content"], F.lit(""))), canonical_text(F.coalesce(canonical_json(m["tool_calls"]), F.lit(""))))
    return F.when(F.size(messages) > 0, F.concat(F.lit("\u0002"), F.array_join(F.transform(messages, one), "\u0002"))).otherwise(canonical_text(canonical_json(text)))


def duplicate_records(samples: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(records, copies) of records that are equal apart from formatting.

    ``records`` has one row per distinct record: (record_id, copies), the smallest sample_id and how many samples carry
    it. ``copies`` has (first_id, copy_id) for every further sample of a group.

    Partition-merged Bloom filters (hashes seen once, hashes seen repeatedly) mark the rows that may be repeats, first of
    the sample_id, then of the content; only they are shuffled and grouped by a 128-bit digest, all others are singletons.
    Of a sample_id the latest delivery counts. Null ids are dropped; a record without messages and text is a singleton,
    empty texts are copies of each other.
    """
    content = canonical_record(F.col("messages"), F.col("text"))
    rows = samples.where("sample_id is not null").select("sample_id", "ingested_at", content.alias("_content"))
    rows = rows.select("sample_id", "ingested_at", F.unhex(F.md5("_content")).alias("digest"), F.xxhash64("sample_id").alias("_s"))
    rows = materialize(rows, "digests")
    count = rows.count()
    delivered = sketches.mark_repeats(rows, "_s", count)
    once = delivered.where("not _maybe").select("sample_id", "digest")
    resolved = once.unionByName(latest_by(delivered.where("_maybe"), "sample_id", "ingested_at", {"digest": F.col("digest")}))
    resolved = materialize(resolved.withColumn("_h", F.when(F.col("digest").isNotNull(), F.xxhash64("digest"))), "resolved")
    marked = sketches.mark_repeats(resolved, "_h", count)
    latest = materialize(marked.where("_maybe").select("sample_id", "digest"), "repeats")
    groups = latest.groupBy("digest").agg(F.min("sample_id").alias("first_id"), F.count(F.lit(1)).alias("copies"))
    lone = marked.where(~F.col("_maybe")).select("sample_id")
    records = groups.select(F.col("first_id").alias("record_id"), "copies").unionByName(lone.select(F.col("sample_id").alias("record_id"), F.lit(1).cast("bigint").alias("copies")))
    salt = F.when(F.col("copies") > HOT_COPIES, F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(F.array(F.lit(0)))
    several = groups.where("copies > 1").select("digest", "first_id", F.explode(salt).alias("_salt"), (F.col("copies") > HOT_COPIES).alias("_hot"))
    hot = several.where("_hot").select("digest").distinct().withColumn("_is_hot", F.lit(True))
    salted = latest.join(broadcast_if_small(hot), "digest", "left").select(
        "digest", F.col("sample_id").alias("copy_id"), F.when(F.col("_is_hot"), F.pmod(F.xxhash64("sample_id"), F.lit(SALTS)).cast("int")).otherwise(F.lit(0)).alias("_salt")
    )
    copies = salted.join(several.drop("_hot"), ["digest", "_salt"]).where("copy_id <> first_id").select("first_id", "copy_id")
    return records, copies
