"""Score cutoffs that keep a target fraction of each source (problem 1)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewright.runtime import broadcast_if_small, latest_by, materialize, running_sum

#: KLL size parameter; the rank error of a query stays under RANK_MARGIN with very high probability.
KLL_K = 4096
RANK_MARGIN = 0.005
#: Ranks at which a sketch is asked for its quantiles; a cutoff's range lies between two of them.
GRID = 200
#: Buckets into which the range of a source's cutoff is cut when its scores are added up.
BUCKETS = 1000


def valid_score(score: Column, low: float, high: float) -> Column:
    """The score if it is a number within the scale, else null (null, NaN and off-scale values are not scores)."""
    return F.when(~F.isnan(score) & score.between(low, high), score)


def latest_scores(samples: DataFrame, low: float = 0.0, high: float = 10.0) -> DataFrame:
    """(sample_id, source, score): the latest delivery of each sample; rows with a null id are dropped."""
    narrow = samples.select("sample_id", "ingested_at", "source", F.col("judge.score").alias("score"))
    picked = latest_by(narrow, "sample_id", "ingested_at", {"source": F.col("source"), "score": valid_score(F.col("score"), low, high)})
    return picked


def cutoffs(scores: DataFrame, targets: DataFrame, k: int = KLL_K, margin: float = RANK_MARGIN) -> DataFrame:
    """Cutoff per source: (source, keep_fraction, scored, cutoff, kept, ties, actual_fraction).

    ``scores`` has (source, score) with null scores for unscored records, ``targets`` (source, keep_fraction).
    The cutoff is the highest score such that at least ``keep_fraction`` of the source's scored records have it or
    more; ``ties`` counts those that have exactly the cutoff.

    One mergeable KLL sketch per source gives the score range in which the cutoff's rank lies; a second pass counts
    the rows above the range and the rows by score within it, from which the exact cutoff follows. Should the
    sketch have missed (its bound is probabilistic), that source is counted again over its whole scale.

    Null, NaN, negative or zero fractions keep nothing and yield a null cutoff; fractions above one keep all scored
    records. A source listed twice takes its largest fraction. A source without scored records, or with none in
    ``scores``, has a null cutoff and zero kept. Null sources have no case.
    """
    wanted = (
        targets.where(F.col("source").isNotNull())
        .groupBy("source")
        .agg(F.max(F.when(~F.isnan("keep_fraction"), F.col("keep_fraction"))).alias("keep_fraction"))
    )
    scored = scores.where(F.col("source").isNotNull() & F.col("score").isNotNull()).select("source", "score")
    sketches = scored.groupBy("source").agg(F.kll_sketch_agg_double("score", F.lit(k)).alias("_sketch"))
    grid = F.kll_sketch_get_quantile_double("_sketch", F.array(*[F.lit(i / GRID) for i in range(GRID + 1)]))
    rank = (F.lit(1.0) - F.col("keep_fraction")) * GRID
    slack = margin * GRID
    at = lambda place: F.element_at("_grid", F.least(F.lit(GRID), F.greatest(F.lit(0), place.cast("int"))) + 1)
    ranges = (
        wanted.where("keep_fraction > 0")
        .join(sketches, "source")
        .select("source", "keep_fraction", grid.alias("_grid"))
        .select("source", "keep_fraction", at(F.floor(rank - slack)).alias("_low"), at(F.ceil(rank + slack)).alias("_high"))
    )
    ranges = materialize(ranges, "ranges")
    found = materialize(_exact(scored, ranges), "cutoffs")
    missed = found.where("cutoff is null")
    if missed.limit(1).count():
        whole = missed.select("source", "keep_fraction", F.lit(float("-inf")).alias("_low"), F.lit(float("inf")).alias("_high"))
        found = found.where("cutoff is not null").unionByName(_exact(scored, whole))
    return (
        wanted.join(broadcast_if_small(found.drop("keep_fraction")), "source", "left")
        .join(broadcast_if_small(scored.groupBy("source").agg(F.count(F.lit(1)).alias("scored"))), "source", "left")
        .select(
            "source",
            "keep_fraction",
            F.coalesce("scored", F.lit(0)).alias("scored"),
            "cutoff",
            F.coalesce("kept", F.lit(0)).alias("kept"),
            F.coalesce("ties", F.lit(0)).alias("ties"),
            (F.coalesce("kept", F.lit(0)) / F.nullif(F.col("scored"), F.lit(0))).alias("actual_fraction"),
        )
    )


def _exact(scored: DataFrame, ranges: DataFrame) -> DataFrame:
    """The counting pass: rows above each source's range as one bucket, rows within it by score."""
    bucket = F.when(F.col("score") > F.col("_high"), F.lit(float("inf"))).when(F.col("score") >= F.col("_low"), F.col("score")).otherwise(F.lit(float("-inf")))
    counts = (
        scored.join(broadcast_if_small(ranges), "source")
        .groupBy("source", "keep_fraction", "_low", "_high", bucket.alias("_score"))
        .agg(F.count(F.lit(1)).alias("_rows"))
    )
    # summed from the top by buckets of the range, so the scores of one source are not one task's
    width = F.col("_high") - F.col("_low")
    inner = F.when(width > 0, F.when(width < float("inf"), (F.col("_high") - F.col("_score")) / width * BUCKETS).otherwise(-F.col("_score") * BUCKETS)).otherwise(0.0)
    place = F.when(F.col("_score") == float("inf"), F.lit(float("-inf"))).when(F.col("_score") == float("-inf"), F.lit(float("inf"))).otherwise(F.floor(inner).cast("double"))
    counts = materialize(counts.withColumn("_place", place).withColumn("_down", -F.col("_score")), "score_counts")
    above = running_sum(counts, ["source"], "_place", ["_down"], "_rows", "_above_rows")
    whole = counts.groupBy("source").agg(F.sum("_rows").alias("_all"))
    summed = above.join(broadcast_if_small(whole), "source").select("source", "keep_fraction", "_score", "_rows", (F.col("_above_rows") + F.col("_rows")).alias("_at_least"), "_all")
    enough = (F.col("_at_least") / F.col("_all") >= F.least(F.col("keep_fraction"), F.lit(1.0))) & (F.abs("_score") != F.lit(float("inf")))
    above = F.max(F.when(F.col("_score") == F.lit(float("inf")), F.col("_rows") / F.col("_all")))
    best = F.max(F.when(enough, F.struct("_score", "_at_least", "_rows")))
    return (
        summed.groupBy("source", "keep_fraction")
        .agg(best.alias("_best"), above.alias("_above"))
        .select(
            "source",
            "keep_fraction",
            # enough rows above the range already: the sketch missed on the high side
            F.when(F.coalesce(F.col("_above"), F.lit(0.0)) < F.least(F.col("keep_fraction"), F.lit(1.0)), F.col("_best")).alias("_best"),
        )
        .select("source", "keep_fraction", F.col("_best._score").alias("cutoff"), F.col("_best._at_least").alias("kept"), F.col("_best._rows").alias("ties"))
    )


def keep_target_fraction(samples: DataFrame, targets: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(cutoffs, kept): the report of :func:`cutoffs` and the kept records (sample_id, source, score)."""
    scores = materialize(latest_scores(samples), "scores")
    report = materialize(cutoffs(scores, targets), "report")
    bar = report.where("cutoff is not null").select("source", "cutoff")
    kept = scores.join(broadcast_if_small(bar), "source").where("score >= cutoff").select("sample_id", "source", "score")
    return report, kept
