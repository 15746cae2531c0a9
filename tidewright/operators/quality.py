"""Token counts, turn metrics, the quality filter and its summary."""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass, field
from functools import lru_cache, reduce
from typing import Any

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType

from tidewright.functions.text import token_count
from tidewright.runtime import materialize
from tidewright.schema import MESSAGES, with_signals


@dataclass
class Limits:
    """Bounds of the quality filter, all inclusive; null is no bound. Turns are messages of any role."""

    enabled: bool = True
    hf_tokenizer: str | None = None
    min_tokens: int | None = 16
    max_tokens: int | None = 8192
    min_turns: int = 1
    max_turns: int | None = None
    min_assistant_turns: int = 1
    percentiles: list[float] = field(default_factory=lambda: [0.1, 0.25, 0.5, 0.75, 0.9])
    sample_for_report: int = 1000


@lru_cache(maxsize=4)
def _tokenizer(path: str):
    from tokenizers import Tokenizer

    loaded = Tokenizer.from_file(path)
    loaded.encode_special_tokens = True
    return loaded


def tokenizer_count(text: Column, path: str) -> Column:
    """Tokens under a tokenizer file in the ``tokenizers`` format, in Arrow batches; null counts as empty."""

    def run(values: pa.Array) -> pa.Array:
        found = _tokenizer(path).encode_batch([v or "" for v in values.to_pylist()], add_special_tokens=False)
        return pa.array([len(f.ids) for f in found], pa.int32())

    return F.arrow_udf(run, IntegerType())(text)


def enrich(df: DataFrame, tokenizer: str | None = None, stats: bool = True) -> DataFrame:
    """Set ``token_count`` and ``message_count`` of the signals, and the side column ``stats`` if asked for."""
    count = tokenizer_count(F.col("text"), tokenizer) if tokenizer else token_count(F.col("text"))
    counted = df.withColumn("_tokens", count)
    size = F.size(F.coalesce("messages", F.array().cast(MESSAGES)))
    counted = counted.withColumn("quality_signals", with_signals(F.col("quality_signals"), {"token_count": F.col("_tokens"), "message_count": size}))
    if stats:
        counted = counted.withColumn("stats", F.struct(F.col("_tokens").alias("num_token")))
    return counted.drop("_tokens")


def passes(limits: Limits, signals: Column | None = None) -> Column:
    """The filter's condition; a missing signal counts as 0."""
    signals = F.col("quality_signals") if signals is None else signals
    value = lambda name: F.coalesce(signals[name], F.lit(0))
    bounds = [
        (value("token_count") >= limits.min_tokens) if limits.min_tokens is not None else None,
        (value("token_count") <= limits.max_tokens) if limits.max_tokens is not None else None,
        value("message_count") >= limits.min_turns,
        (value("message_count") <= limits.max_turns) if limits.max_turns is not None else None,
        value("assistant_turn_count") >= limits.min_assistant_turns,
    ]
    condition = F.lit(True)
    for bound in bounds:
        if bound is not None:
            condition = condition & bound
    return condition


#: Size of the quantile sketches that narrow a percentile down, the share of the ranks that a range reaches beyond the wanted
#: one, and distinct values within the ranges that are counted one by one.
KLL_K, RANK_MARGIN, MOST_VALUES = 4096, 0.005, 100_000


def order_statistics(df: DataFrame, column: Column, ranks: Callable[[int], list[int]]) -> tuple[int, list[float]]:
    """(count, values at the ranks that ``ranks`` names for that count, from 0) of a column of doubles, exactly.

    Nulls and NaN do not count. A mergeable sketch gives a range for each rank; the values below and within the ranges are
    counted, and a range that still holds too many distinct values is narrowed by a sketch of its own. Only sketches and
    at most MOST_VALUES counts ever come to one place.
    """
    values = df.select(column.cast("double").alias("_v")).where(~F.isnan("_v"))
    grid = F.array(*[F.lit(i / 200) for i in range(201)])
    sketched = lambda d: d.agg(F.count("_v").alias("n"), F.min("_v").alias("low"), F.max("_v").alias("high"), F.when(F.count("_v") > 0, F.kll_sketch_get_quantile_double(F.kll_sketch_agg_double("_v", F.lit(KLL_K)), grid)).alias("grid")).first()
    whole = sketched(values)
    if not whole["n"]:
        return 0, []
    wanted = ranks(whole["n"])
    found: dict[int, float] = {}
    _narrow(values, whole, 0, sorted(set(wanted)), sketched, found)
    return whole["n"], [found[r] for r in wanted]


def _narrow(values: DataFrame, sketch: Any, below: int, wanted: list[int], sketched: Callable[[DataFrame], Any], found: dict[int, float]) -> None:
    """Values at the ``wanted`` ranks, all within ``values``, of which ``below`` others are smaller."""
    n, grid = sketch["n"], sketch["grid"]

    def bounds(rank: int) -> tuple[float, float]:
        place, slack = 200 * (rank - below) / n, 200 * RANK_MARGIN + 1
        low, high = math.floor(place - slack), math.ceil(place + slack)
        return (sketch["low"] if low <= 0 else grid[low]), (sketch["high"] if high >= 200 else grid[high])

    ranges: list[list[Any]] = []
    for low, high, rank in sorted((*bounds(r), r) for r in wanted):
        if ranges and low <= ranges[-1][1]:
            ranges[-1][1] = max(high, ranges[-1][1])
            ranges[-1][2].append(rank)
        else:
            ranges.append([low, high, [rank]])
    inside = lambda low, high: F.col("_v").between(low, high)
    near = values.where(reduce(lambda a, b: a | b, [inside(low, high) for low, high, _ in ranges]))
    counts = {r["_v"]: r["n"] for r in near.groupBy("_v").agg(F.count(F.lit(1)).alias("n")).limit(MOST_VALUES + 1).collect()}
    under = values.agg(*[F.count(F.when(F.col("_v") < low, 1)) for low, _, _ in ranges]).first()
    for k, (low, high, group) in enumerate(ranges):
        if len(counts) > MOST_VALUES and low < high and not (low == sketch["low"] and high == sketch["high"]):
            part = values.where(inside(low, high))
            _narrow(part, sketched(part), below + under[k], group, sketched, found)
            continue
        if len(counts) > MOST_VALUES and low < high:  # the sketch cannot narrow this range any more: halve it by value
            middle = low + (high - low) / 2
            for part in (values.where(F.col("_v") <= middle), values.where(F.col("_v") > middle)):
                own = sketched(part)
                mine = [r for r in group if below <= r < below + own["n"]]
                if mine:
                    _narrow(part, own, below, mine, sketched, found)
                below += own["n"]
            continue
        at = below + under[k]
        if low == high and low not in counts:
            counts[low] = values.where(F.col("_v") == low).count()
        for value in sorted(v for v in counts if low <= v <= high):
            for rank in group:
                if at <= rank < at + counts[value]:
                    found[rank] = value
            at += counts[value]
        missed = [r for r in group if r not in found]
        if missed:  # the sketch's bound is probabilistic: look on the side where the rank lies
            for side, start, take in ((values.where(F.col("_v") < low), below, lambda r: r < below + under[k]), (values.where(F.col("_v") > high), at, lambda r: r >= at)):
                mine = [r for r in missed if take(r)]
                if mine:
                    _narrow(side, sketched(side), start, mine, sketched, found)


def percentiles(df: DataFrame, column: Column, shares: list[float]) -> list[float | None]:
    """Exact percentiles with linear interpolation between neighbours; 0 and 1 are the minimum and the maximum, None of no values."""
    inside = [min(1.0, max(0.0, float(s))) for s in shares]
    ranks = lambda n: [r for s in inside for r in (math.floor(s * (n - 1)), math.ceil(s * (n - 1)))]
    count, values = order_statistics(df, column, ranks)
    if not count:
        return [None] * len(shares)
    made = []
    for k, s in enumerate(inside):
        low, high, place = values[2 * k], values[2 * k + 1], s * (count - 1)
        part = place - math.floor(place)
        made.append(low if part == 0 else (1 - part) * low + part * high)
    return made


def summary(df: DataFrame, shares: list[float], column: Column | None = None) -> DataFrame:
    """One row: sample_count, min, max, mean and the percentiles of the token counts; zeros for no rows."""
    value = F.coalesce(F.col("quality_signals.token_count") if column is None else column, F.lit(0)).cast("double")
    counted = materialize(df.select(value.alias("_v")), "values")  # read several times; counting tokens is done once
    found = percentiles(counted, F.col("_v"), shares)
    shown = F.map_from_arrays(F.array(*[F.lit(str(s)) for s in shares]).cast("array<string>"), F.array(*[F.lit(v or 0.0) for v in found]).cast("array<double>"))
    return counted.agg(
        F.count("_v").alias("sample_count"), F.coalesce(F.min("_v"), F.lit(0.0)).alias("min"), F.coalesce(F.max("_v"), F.lit(0.0)).alias("max"), F.coalesce(F.avg("_v"), F.lit(0.0)).alias("mean"),
    ).withColumn("percentiles", shown)


def metric_sample(df: DataFrame, column: Column, order: list[str], limit: int) -> list[float]:
    """The first ``limit`` values in the given order, as floats; for reports."""
    rows = df.select(column.cast("double").alias("_v"), *order).where("_v is not null").orderBy(*order).limit(limit).collect()
    return [r["_v"] for r in rows]
