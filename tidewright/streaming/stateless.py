"""Stateless stages over a stream of records: the batch functions, applied to each micro-batch or continuously."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import DataStreamWriter

from tidewright.operators import quality
from tidewright.operators.adapt import Mapping, adapt


def read_json_stream(spark: SparkSession, path: str, schema: str, files_per_batch: int = 100) -> DataFrame:
    """New JSON files of a folder as a stream; a stream needs its schema."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).json(path)


def clean_stream(stream: DataFrame, mapping: Mapping, limits: quality.Limits, source_path: str = "") -> DataFrame:
    """Normalised, counted and filtered records. The mapping must name an id column, since a stream has no positions."""
    if not mapping.id_key:
        raise ValueError("a stream needs an id column")
    return quality.enrich(adapt(stream, mapping, source_path), limits.hf_tokenizer, stats=False).where(quality.passes(limits))


def for_each_batch(stream: DataFrame, step: Callable[[DataFrame, int], None], checkpoint: str) -> DataStreamWriter:
    """A writer that hands every micro-batch to ``step``, for stages that need whole tables (such as deduplication)."""
    return stream.writeStream.foreachBatch(step).option("checkpointLocation", checkpoint)
