"""Named queries about sources, sinks, whole runs and streams: tables are written to the shared folder and read back."""

from __future__ import annotations

import json
import re
from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewright.operators.adapt import Mapping
from tidewright.operators.blocks import drop_metadata
from tidewright.operators.quality import Limits
from tidewright.plans.config import pipeline_config
from tidewright.plans.monitor import ALERTS, alert_rules, missing_artifacts
from tidewright.plans.pipeline import Run
from tidewright.runtime import scratch, spread
from tidewright.sources import readers, writers
from tidewright.sources.arrow import write_arrow
from tidewright.sources.files import is_file, read_text, write_text
from tidewright.streaming.stateless import clean_stream, read_json_stream

_FIELDS = {"doc_id": "bigint", "text": "string", "lang": "string", "source": "string", "n_chars": "bigint", "domain": "string"}


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spread(spark.read.parquet(f"{sf_dir}/documents.parquet").select(*_FIELDS))


def _typed(df: DataFrame) -> DataFrame:
    return df.select(*[F.col(n).cast(kind).alias(n) for n, kind in _FIELDS.items()])


# --- sources ---------------------------------------------------------------------------------------------------------


def source_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch(spark, "jsonl")
    _documents(spark, sf_dir).write.json(folder)
    return _typed(readers.read(spark, folder, "jsonl"))


def source_json_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A file that is one JSON array; the table has a fixed number of rows."""
    path = f"{scratch(spark, 'array')}/items.json"
    rows = spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("item_id", "text", "suite").collect()
    write_text(spark, path, json.dumps([r.asDict() for r in rows], ensure_ascii=False, indent=1))
    return readers.read(spark, path).select("item_id", "text", "suite")


def _separated(spark: SparkSession, sf_dir: str, kind: str, **options: str) -> DataFrame:
    folder = scratch(spark, kind)
    _documents(spark, sf_dir).write.options(header=True, escape='"', ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False, **options).csv(folder)
    return _typed(readers.read(spark, folder, kind))


def source_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fields with quotes and line breaks; an empty field is null."""
    return _separated(spark, sf_dir, "csv")


def source_tsv(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _separated(spark, sf_dir, "tsv", sep="\t")


def source_detected(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A folder whose format is told by the files in it."""
    folder = scratch(spark, "detected")
    _documents(spark, sf_dir).write.parquet(folder)
    return _typed(readers.read(spark, folder))


def source_arrow(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch(spark, "ipc")
    write_arrow(_documents(spark, sf_dir), folder)
    return _typed(readers.read(spark, folder, "arrow"))


def source_feather(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Feather files; their suffix wins over the format that is given."""
    folder = scratch(spark, "feather")
    write_arrow(_documents(spark, sf_dir), folder, "feather")
    return _typed(readers.read(spark, f"{folder}/*.feather", "json"))


def source_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole files as texts."""
    folder = scratch(spark, "texts")
    for row in spark.read.parquet(f"{sf_dir}/region.parquet").select("r_regionkey", "r_name").collect():  # five rows
        write_text(spark, f"{folder}/{row['r_regionkey']}.txt", row["r_name"])
    return readers.read(spark, folder).select("text")


def load_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two sources through the loader, one of them with ids made from place and text."""
    sources = [
        readers.Source(f"{sf_dir}/documents.parquet", "parquet", Mapping(source_name="documents", id_key="doc_id", text_key="text", keep_fields=["lang"])),
        readers.Source(f"{sf_dir}/benchmark.parquet", adapter=Mapping(source_name="benchmark", text_key="text", keep_fields=["suite"])),
    ]
    both = readers.load_all(spark, sources)
    return both.select("sample_id", "source", "source_ord", "metadata.lang", "metadata.suite", F.length("text").alias("chars"))


# --- sinks -----------------------------------------------------------------------------------------------------------


def written_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shards as the manifest lists them, with what their files hold."""
    manifest = writers.write_shards(_documents(spark, sf_dir).withColumn("_at", F.col("doc_id")), scratch(spark, "shards"), 128, "parquet", index="_at")
    listed = json.loads(read_text(spark, manifest))
    named = spark.createDataFrame([(m["shard_id"], m["rows"]) for m in listed], "shard_id int, rows bigint")
    files = spark.read.parquet(*[m["path"] for m in listed]).withColumn("shard_id", F.regexp_extract(F.input_file_name(), r"shard-(\d+)", 1).cast("int"))
    held = files.groupBy("shard_id").agg(F.count(F.lit(1)).alias("found"), F.min("doc_id").alias("first_id"), F.max("doc_id").alias("last_id"))
    return named.join(held, "shard_id")


def written_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{scratch(spark, 'export')}/cleaned.jsonl"
    writers.export(_documents(spark, sf_dir).withColumn("stats", F.lit(1)), writers.Export(path=path, export_shard_size=100_000, export_stats=False))
    return _typed(spark.read.json(path))


def written_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Compressed chunks of fixed size without one field of their metadata, read again through an adapter of the user's."""
    folder = scratch(spark, "chunks")
    docs = _documents(spark, sf_dir).select(F.col("doc_id").cast("string").alias("id"), "text", F.struct("lang", "source").alias("metadata"))
    writers.write_chunks(drop_metadata(docs, "source"), folder, 100, "gzip")
    adapter = lambda df: df.select("id", "text", F.struct("metadata.lang", F.regexp_extract("_file", r"(chunk)_\d+_\d+", 1).alias("kind")).alias("metadata"))
    back = readers.read_chunks(spark, [{"path": folder, "format": "jsonl", "glob": "chunk_*.json.gz", "recursive": True, "adapter": adapter}])
    return back.select("id", "text", "metadata.lang", "metadata.kind")


# --- a run -----------------------------------------------------------------------------------------------------------


@lru_cache(maxsize=8)
def _finished(application: str, sf_dir: str) -> str:
    """The folder of one whole run over the documents, made once in a session."""
    spark = SparkSession.getActiveSession()
    folder = scratch(spark, "run")
    call = {"enabled": True, "backend": "callable", "model": "stand-in"}
    source = lambda name, **keys: {"path": f"{sf_dir}/{name}.parquet", "format": "parquet", "adapter": {"source_name": name, "text_key": "text", **keys}}
    config = pipeline_config({
        "sources": [source("documents", id_key="doc_id")],
        "runtime": {"work_dir": folder},
        "sharding": {"rows_per_shard": 100_000},
        "contamination": {"enabled": True, "reference_sources": [source("benchmark")], "ngram_size": 8, "max_contamination_ratio": 0.05},
        "quality": {"min_tokens": 100, "max_tokens": 400, "min_assistant_turns": 0},
        "operators": [{"hook": "post_quality", "class_path": "tidewright.operators.hooks.AlphanumericFilter", "init_kwargs": {"min_ratio": 0.8}, "name": "alphanumeric"}],
        "augmentation": {**call, "callable_path": "tidewright.plans.catalog_records:digest_model"},
        "judge": {**call, "callable_path": "tidewright.plans.catalog_records:score_model", "prompt_template": "{text}", "min_score": 3.0},
        "export": {"path": f"{folder}/cleaned.parquet"},
    })
    Run(spark, config).run()
    return folder


def _run_folder(spark: SparkSession, sf_dir: str) -> str:
    folder = _finished(spark.sparkContext.applicationId, sf_dir)
    if not is_file(spark, f"{folder}/pipeline_summary.json"):  # deleted meanwhile
        _finished.cache_clear()
        folder = _finished(spark.sparkContext.applicationId, sf_dir)
    return folder


def pipeline_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows after each stage, from the summary that a run writes."""
    summary = json.loads(read_text(spark, f"{_run_folder(spark, sf_dir)}/pipeline_summary.json"))
    return spark.createDataFrame([(s["stage"], s["rows"]) for s in summary["stages"]], "stage string, rows bigint")


def pipeline_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The records that a run exports."""
    made = spark.read.parquet(f"{_run_folder(spark, sf_dir)}/cleaned.parquet")
    return made.select("sample_id", "augmentation.generated_answer", "judge.score", "judge.reason", "quality_signals.token_count", "quality_signals.contamination_matched_ngrams")


def pipeline_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Gauges of a run without its times, from the text that Prometheus reads."""
    text = read_text(spark, f"{_run_folder(spark, sf_dir)}/monitoring/pipeline_metrics.prom")
    found = re.findall(r'^(\w+)\{[^}]*?(?:stage="(\w+)")?\} (\S+)$', text, re.M)
    return spark.createDataFrame([(m, s or None, float(v)) for m, s, v in found if "seconds" not in m], "metric string, stage string, value double")


def pipeline_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The nodes of the chart in a run's report."""
    text = read_text(spark, f"{_run_folder(spark, sf_dir)}/report/pipeline.mmd")
    return spark.createDataFrame([(line.strip(),) for line in text.splitlines() if "[" in line], "node string")


def pipeline_artifacts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files of a run: how many metric files are missing, and the sizes of the judged sample in the summary."""
    folder = _run_folder(spark, sf_dir)
    summary = json.loads(read_text(spark, f"{folder}/pipeline_summary.json"))
    return spark.createDataFrame([(len(missing_artifacts(f"{folder}/monitoring")), summary["row_count"], summary["judge"]["sample_count"], summary["judge"]["max"])], "missing int, rows bigint, judged bigint, best double")


def alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Alert rules as they are written."""
    text = alert_rules()
    found = re.findall(r"- alert: (\w+)\n\s+expr: (.+)\n\s+for: (\w+)\n(?:.*\n)\s+severity: (\w+)", text)
    if len(found) != len(ALERTS):
        raise ValueError("not all alerts are written")
    return spark.createDataFrame(found, "alert string, expr string, wait string, severity string")


# --- streams ---------------------------------------------------------------------------------------------------------


def stream_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records cleaned by a stream over all files that are there."""
    folder = scratch(spark, "stream")
    _documents(spark, sf_dir).select("doc_id", "text").write.json(f"{folder}/in")
    stream = read_json_stream(spark, f"{folder}/in", "doc_id bigint, text string")
    clean = clean_stream(stream, Mapping(source_name="documents", id_key="doc_id", text_key="text"), Limits(min_tokens=100, max_tokens=400, min_assistant_turns=0))
    shown = clean.select("sample_id", "quality_signals.token_count", "quality_signals.char_count")
    shown.writeStream.format("parquet").option("path", f"{folder}/out").option("checkpointLocation", f"{folder}/state").trigger(availableNow=True).start().awaitTermination()
    return spark.read.schema(shown.schema).parquet(f"{folder}/out")


QUERIES = (
    source_json, source_json_array, source_csv, source_tsv, source_detected, source_arrow, source_feather, source_text, load_union, written_shards, written_export, written_chunks,
    pipeline_run, pipeline_export, pipeline_metrics, pipeline_report, pipeline_artifacts, alerts, stream_clean,
)
