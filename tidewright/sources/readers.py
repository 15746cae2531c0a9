"""Reading sources of any supported format, with the position of each record, and their union as standard records."""

from __future__ import annotations

import os
from dataclasses import dataclass, field
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidewright.operators.adapt import Mapping, adapt
from tidewright.runtime import broadcast_if_small
from tidewright.sources.arrow import register
from tidewright.sources.files import files_under, first_mark, is_file, is_folder, session

#: Formats by suffix, after a compression suffix is taken off.
SUFFIXES = {".json": "json", ".jsonl": "json", ".ndjson": "json", ".csv": "csv", ".tsv": "tsv", ".parquet": "parquet", ".arrow": "arrow", ".feather": "arrow", ".txt": "text", ".md": "text"}
NAMES = {"json": "json", "jsonl": "json", "csv": "csv", "tsv": "tsv", "parquet": "parquet", "arrow": "arrow", "feather": "arrow", "text": "text", "txt": "text"}
_COMPRESSED = (".gz", ".zst", ".bz2", ".lz4", ".snappy")


@dataclass
class Source:
    """A path with its format, its mapping to the standard record and options of the reader."""

    path: str
    format: str | None = None
    adapter: Mapping = field(default_factory=Mapping)
    load_options: dict[str, Any] = field(default_factory=dict)


def _suffix(path: str) -> str | None:
    name = path.rstrip("/").rsplit("/", 1)[-1].lower()
    for packed in _COMPRESSED:
        name = name.removesuffix(packed)
    return SUFFIXES.get(os.path.splitext(name)[1])


def format_of(path: str, given: str | None = None) -> str:
    """The format of a path: an Arrow or Feather suffix always wins, then the given name, then the suffix.

    Unknown names fall back to the suffix; a folder without one is looked into.
    """
    found = _suffix(path)
    if found == "arrow":
        return found
    if given and given.lower() in NAMES:
        return NAMES[given.lower()]
    if found:
        return found
    spark = session()
    if is_folder(spark, path):
        inside: set[str] = set()
        for name in files_under(spark, path):
            inside |= {s for s in (_suffix(name),) if s}
            if len(inside) > 1:
                break
        if len(inside) == 1:
            return inside.pop()
    raise ValueError(f"cannot tell the format of {path}")


def _is_json_array(spark: SparkSession, path: str) -> bool:
    return path.endswith(".json") and not any(c in path for c in "*?[{") and is_file(spark, path) and first_mark(spark, path) == "["


def read(spark: SparkSession, path: str, kind: str | None = None, options: dict[str, Any] | None = None) -> DataFrame:
    """The records of a path. Options go to Spark's reader (``schema`` as a DDL string saves the inference).

    A CSV field may hold line breaks, so a file is one task unless the option ``multiLine`` is set to false.
    """
    options = dict(options or {})
    schema = options.pop("schema", None)
    fmt = format_of(path, kind)
    reader = spark.read.schema(schema) if schema and fmt != "arrow" else spark.read
    if fmt == "json":
        return reader.options(**({"multiLine": True} if _is_json_array(spark, path) else {}), **options).json(path)
    if fmt in ("csv", "tsv"):
        return reader.options(**{"header": True, "multiLine": True, "escape": '"', **({"sep": "\t"} if fmt == "tsv" else {}), **options}).csv(path)
    if fmt == "parquet":
        return reader.options(**options).parquet(path)
    if fmt == "text":
        return reader.options(**{"wholetext": True, **options}).text(path).withColumnRenamed("value", "text")
    register(spark)
    return spark.read.format("tidewright_arrow").options(**options).load(path)


def with_position(df: DataFrame, out: str = "_position") -> DataFrame:
    """``df`` with each record's place in its source, from 0, in the order of the files.

    Rows get their place within their partition first; the few partition sizes are then added up, so the order is kept
    and nothing is sorted or moved to one task.
    """
    marked = df.withColumn("_part", F.spark_partition_id()).withColumn("_mono", F.monotonically_increasing_id())
    inside = F.col("_mono") - F.shiftleft(F.col("_part").cast("bigint"), 33)
    sizes = marked.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)  # one row per partition
    starts = sizes.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    joined = marked.withColumn("_inside", inside).join(broadcast_if_small(starts), "_part")
    return joined.withColumn(out, F.col("_start") + F.col("_inside")).drop("_part", "_mono", "_inside", "_start")


def load(spark: SparkSession, source: Source, generation: str | None = None, judge: str | None = None) -> DataFrame:
    """Standard records of one source; positions are computed only where an id has to be made from them."""
    df = read(spark, source.path, source.format, source.load_options)
    needed = not source.adapter.id_key or source.adapter.id_key not in df.columns
    position: Column | None = None
    if needed:
        df = with_position(df)
        position = F.col("_position")
    return adapt(df, source.adapter, source.path, position, generation, judge)


def load_all(spark: SparkSession, sources: list[Source], generation: str | None = None, judge: str | None = None) -> DataFrame:
    """All sources one after the other, with ``source_ord``; metadata fields that one source lacks are null there."""
    if not sources:
        raise ValueError("at least one source is needed")
    tables = [load(spark, s, generation, judge).withColumn("source_ord", F.lit(i)) for i, s in enumerate(sources)]
    if len(tables) > 1:
        tables = _same_metadata(tables)
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tables)


def _same_metadata(tables: list[DataFrame]) -> list[DataFrame]:
    """Every metadata struct with the fields of all sources; a field with several types becomes text."""
    kinds: dict[str, set[str]] = {}
    for table in tables:
        for f in table.schema["metadata"].dataType.fields:
            kinds.setdefault(f.name, set()).add(f.dataType.simpleString())

    def align(table: DataFrame) -> DataFrame:
        there = {f.name for f in table.schema["metadata"].dataType.fields}
        parts = []
        for name, found in kinds.items():
            kind = next(iter(found)) if len(found) == 1 else "string"
            value = F.col("metadata")[name] if name in there else F.lit(None)
            nested = name in there and table.schema["metadata"].dataType[name].dataType.simpleString().startswith(("struct", "array", "map"))
            parts.append((F.to_json(value) if kind == "string" and nested else value.cast(kind)).alias(name))
        return table.withColumn("metadata", F.struct(*parts))

    return [align(t) for t in tables]


def read_chunks(spark: SparkSession, readers: list[dict[str, Any]]) -> DataFrame:
    """Documents (id, text, metadata) of several folders in mixed formats.

    Each reader has ``path``, and optionally ``format``, ``glob`` (of file names), ``recursive``, ``options`` and
    ``adapter``: a function from the table (with the file in ``_file``) to one with at least ``id`` and ``text``.
    """
    tables = []
    for r in readers:
        options = {**r.get("options", {}), **({"pathGlobFilter": r["glob"]} if "glob" in r else {}), **({"recursiveFileLookup": True} if r.get("recursive") else {})}
        raw = read(spark, r["path"], r.get("format"), options)
        if format_of(r["path"], r.get("format")) != "arrow":
            raw = raw.withColumn("_file", F.col("_metadata.file_path"))
        made = r["adapter"](raw) if r.get("adapter") else raw
        missing = {"id", "text"} - set(made.columns)
        if missing:
            raise ValueError(f"the adapter of {r['path']} yields no {', '.join(sorted(missing))}")
        made = made.withColumn("id", F.col("id").cast("string"))
        tables.append(made.select("id", "text", *(["metadata"] if "metadata" in made.columns else [])))
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tables)
