"""Token budget per source and language (problem 2), and token counts of documents."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewright.llm import bpe
from tidewright.llm.common import arrow_map, label, language_code, latest_deliveries
from tidewright.llm.language import language_of
from tidewright.runtime import materialize


def piece_tokens(pieces: DataFrame, path: str) -> DataFrame:
    """(piece, tokens) of distinct pre-split pieces, by merges over their symbol arrays."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = [p.encode("utf-8", "replace") for p in batch.column(0).to_pylist()]
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(bpe.ranks(path).count(found))], ["piece", "tokens"])

    return arrow_map(pieces.select("piece"), run, "piece string, tokens bigint")


def token_budget(samples: DataFrame, tokenizers: str | None = None, vocabulary: str = bpe.RANKS) -> DataFrame:
    """Tokens by (source, lang, domain): documents, tokens, declared_tokens, undeclared.

    ``tokens`` is counted from ``text`` with an existing vocabulary; ``declared_tokens`` adds up the positive
    ``quality_signals.token_count`` and ``undeclared`` counts documents without one. Text is split into pieces in the
    JVM; pieces are counted by slice before they are shuffled, every distinct piece is tokenised once, and the counts
    are joined back.

    ``lang`` is what the text itself shows, else the declared language in any spelling, else ``unknown``; source and
    domain are lower-cased labels with ``unknown`` for null and blank. Of each sample_id the latest delivery counts;
    null ids are dropped. Null and empty texts have no tokens but count as documents.
    """
    path = bpe.vocabulary_path(tokenizers, vocabulary)
    columns = {
        "source": label(F.col("source")),
        "declared_lang": language_code(F.col("metadata.lang")),
        "domain": label(F.col("metadata.domain")),
        "declared": F.col("quality_signals.token_count"),
        "text": F.col("text"),
    }
    latest = latest_deliveries(samples.select("sample_id", "ingested_at", "source", "metadata", "quality_signals", "text"), columns)
    latest = latest.withColumn("lang", F.coalesce(language_of(F.col("text")), "declared_lang", F.lit("unknown")))
    keys = ["source", "lang", "domain"]
    # one pass: a null piece stands for the document itself
    split = F.array_append(F.regexp_extract_all(F.coalesce("text", F.lit("")), F.lit(bpe.JVM_PATTERN), F.lit(0)), F.lit(None).cast("string"))
    counted = materialize(
        latest.select(*keys, "declared", F.explode(split).alias("piece"))
        .groupBy(*keys, "piece")
        .agg(
            F.count(F.lit(1)).alias("times"),
            F.sum(F.when(F.col("piece").isNull() & (F.col("declared") > 0), F.col("declared").cast("bigint"))).alias("declared"),
            F.sum(F.when(F.col("piece").isNull() & ~F.coalesce(F.col("declared") > 0, F.lit(False)), 1).otherwise(0)).alias("undeclared"),
        ),
        "pieces",
    )
    pieces = piece_tokens(counted.where("piece is not null").select("piece").distinct(), path)
    return (
        counted.join(pieces, "piece", "left")
        .groupBy(*keys)
        .agg(
            F.sum(F.when(F.col("piece").isNull(), F.col("times")).otherwise(0)).alias("documents"),
            F.coalesce(F.sum(F.col("times") * F.col("tokens")), F.lit(0)).alias("tokens"),
            F.coalesce(F.sum("declared"), F.lit(0)).alias("declared_tokens"),
            F.sum("undeclared").alias("undeclared"),
        )
    )


def document_tokens(df: DataFrame, keep: list[str], text: str = "text", tokenizers: str | None = None, vocabulary: str = bpe.RANKS) -> DataFrame:
    """``keep`` plus ``tokens`` of each whole text; null and empty texts have 0.

    Texts are split in the JVM. Of a batch's pieces the distinct ones are counted, and the counts are added up by document
    with array operations; nothing is shuffled.
    """
    path = bpe.vocabulary_path(tokenizers, vocabulary)
    split = F.regexp_extract_all(F.coalesce(F.col(text), F.lit("")), F.lit(bpe.JVM_PATTERN), F.lit(0))
    fields = df.select(*keep, split.alias("_pieces"))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields.schema.fields[:-1])

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        last = batch.num_columns - 1
        lists = batch.column(last)
        pieces = lists.flatten().dictionary_encode()
        each = bpe.counter(path)(pieces.dictionary.to_pylist())
        owner = np.repeat(np.arange(len(lists)), np.diff(lists.offsets.to_numpy()))
        tokens = np.bincount(owner, weights=each[pieces.indices.to_numpy()], minlength=len(lists)).astype(np.int64) if len(owner) else np.zeros(len(lists), np.int64)
        return pa.RecordBatch.from_arrays([*(batch.column(i) for i in range(last)), pa.array(tokens)], [*keep, "tokens"])

    return arrow_map(fields, run, f"{schema}, tokens bigint")
