"""Mixing sources to target weights (problem 8) by a low-discrepancy schedule of equal-token blocks."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType

from tidewright.llm.tokens import document_tokens
from tidewright.runtime import broadcast_if_small, materialize, running_sum

#: Slots up to which a schedule is as fine as LEAST_BLOCK_DOCUMENTS allows; beyond, blocks grow, to MOST_BLOCK_TOKENS at most.
FINE_SLOTS, MOST_BLOCK_TOKENS = 1 << 16, 1 << 20
#: Slots of one bucket when the slots of a source are ranked.
BUCKET_SLOTS = 1 << 12
#: Least size of a block in mean documents (small mixtures keep exact shares with fine blocks); rows of one source per
#: bucket of the running sum.
LEAST_BLOCK_DOCUMENTS, BUCKET_ROWS = 0.25, 5_000
_GOLDEN = (math.sqrt(5) - 1) / 2


def _plan(pool: DataFrame, targets: DataFrame) -> DataFrame:
    """Targets with what is there: (source, target_share, max_repeats, documents, tokens), one row per source."""
    clean = targets.where(F.col("source").isNotNull()).groupBy("source").agg(
        F.sum(F.when(~F.isnan("target_share") & (F.col("target_share") > 0), F.col("target_share")).otherwise(0.0)).alias("target_share"),
        F.greatest(F.lit(0), F.coalesce(F.max("max_repeats"), F.lit(0))).alias("max_repeats"),
    )
    there = pool.groupBy("source").agg(F.count(F.lit(1)).alias("documents"), F.sum("tokens").alias("tokens"))
    return clean.join(there, "source", "left").na.fill(0, ["documents", "tokens"])


def mixture(documents: DataFrame, targets: DataFrame, total_tokens: int | None = None, seed: int = 20, tokenizers: str | None = None) -> tuple[DataFrame, DataFrame]:
    """(draws, report) of a mixture in which every source takes its share of the tokens.

    ``draws``: (slot, source, block, doc_id, use, tokens), in reading order by slot; ``use`` says the how-manieth use of
    the document it is. ``report``: one row per target source with its target and actual share.

    The mixture is as large as the scarcest source allows with at most ``max_repeats`` uses of a document (or
    ``total_tokens``, if less). Shares of sources without usable documents go to the others in proportion; the report
    shows them with an actual share of 0. Slot k belongs to the source in whose interval of cumulative weights the
    point frac((k + 1/2) / golden ratio) falls; the j-th slot of a source takes the j-th equal-token block of its
    documents, shuffled anew for each use. A document belongs to the block that holds its middle token, so a source's total
    is met within half a document and the discrepancy of the schedule (a few blocks).

    Null ids or sources, and documents without tokens, are not drawn; nor are sources that are no target. A target
    named twice has the sum of its shares and the largest ``max_repeats``; null, NaN and negative shares count as 0.
    """
    counted = document_tokens(documents.where("doc_id is not null and source is not null"), ["doc_id", "source"], tokenizers=tokenizers)
    pool = materialize(counted.where("tokens > 0"), "pool")
    plan = _plan(pool, targets)
    rows = plan.collect()  # one row per target source: the targets are a setting, not data
    usable = sorted((r for r in rows if r["target_share"] > 0 and r["max_repeats"] > 0 and r["tokens"] > 0), key=lambda r: r["source"])
    whole = sum(r["target_share"] for r in usable)
    weights = [r["target_share"] / whole for r in usable]
    size = min((r["max_repeats"] * r["tokens"] / w for r, w in zip(usable, weights)), default=0)
    size = min(size, total_tokens) if total_tokens is not None else size
    mean = sum(r["tokens"] for r in usable) / max(1, sum(r["documents"] for r in usable))
    finest = int(size / max(1.0, LEAST_BLOCK_DOCUMENTS * mean))
    slots = max(1, min(finest, max(FINE_SLOTS, math.ceil(size / MOST_BLOCK_TOKENS)))) if usable else 0
    block = size / max(1, slots)
    spark = documents.sparkSession
    details = spark.createDataFrame(
        [(r["source"], i, int(r["tokens"]), int(min(r["max_repeats"], math.ceil(w * size / r["tokens"]) + 1)), int(1 + r["documents"] // BUCKET_ROWS)) for i, (r, w) in enumerate(zip(usable, weights))],
        "source string, place int, source_tokens bigint, uses int, buckets bigint",
    )
    bounds, reached = [], 0.0
    for w in weights[:-1]:
        reached += w
        bounds.append(reached)
    draws = materialize(_draw(spark, pool, details, bounds, slots, block, seed), "draws")
    got = draws.groupBy("source").agg(
        F.sum("tokens").alias("drawn_tokens"), F.count(F.lit(1)).alias("draws"), F.countDistinct("doc_id").alias("documents_used"), F.max("use").alias("most_uses")
    )
    report = plan.join(broadcast_if_small(got), "source", "left").na.fill(0, ["drawn_tokens", "draws", "documents_used", "most_uses"])
    all_rows = Window.partitionBy()  # one row per target source
    report = report.select(
        "source", "target_share", "max_repeats", "documents", F.col("tokens").alias("available_tokens"), "drawn_tokens", "draws", "documents_used", "most_uses",
        (F.col("drawn_tokens") / F.nullif(F.sum("drawn_tokens").over(all_rows), F.lit(0))).alias("actual_share"),
    )
    return draws, report


def _draw(spark, pool: DataFrame, details: DataFrame, bounds: list[float], slots: int, block: float, seed: int) -> DataFrame:
    point = (F.col("id") + F.lit(0.5)) * F.lit(_GOLDEN)
    edges = np.array(bounds)
    find = F.arrow_udf(lambda points: pa.array(np.searchsorted(edges, points.to_numpy(zero_copy_only=False), side="right").astype(np.int32)), IntegerType())
    schedule = spark.range(slots).select(F.col("id").alias("slot"), find(point - F.floor(point)).alias("place"), F.floor(F.col("id") / BUCKET_SLOTS).alias("_slots"), F.lit(1).cast("bigint").alias("_one"))
    ranked = running_sum(schedule, ["place"], "_slots", ["slot"], "_one", "block")
    ranked = ranked.join(broadcast_if_small(details.select("place", "source")), "place").select("slot", "source", "block")
    used = pool.join(broadcast_if_small(details), "source").withColumn("use", F.explode(F.sequence(F.lit(1), F.col("uses"))))
    used = used.withColumn("_order", F.xxhash64(F.lit(seed), "use", "doc_id"))
    bucket = F.floor((F.col("_order") / F.lit(2.0**64) + 0.5) * F.col("buckets")).cast("bigint")
    summed = running_sum(used.withColumn("_bucket", bucket), ["source", "use"], "_bucket", ["_order", "doc_id"], "tokens", "_before_tokens")
    middle = (F.col("use") - 1) * F.col("source_tokens") + F.col("_before_tokens") + F.col("tokens") / 2
    placed = summed.withColumn("block", F.floor(middle / F.lit(block)).cast("bigint"))
    return placed.join(ranked, ["source", "block"]).select("slot", "source", "block", "doc_id", "use", "tokens")

