"""The cleaning pipeline: load, normalise, deduplicate, decontaminate, filter, generate, judge, export."""

from __future__ import annotations

import json
import os
import time
from collections.abc import Callable
from dataclasses import replace
from datetime import datetime, timezone
from typing import Any

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tidewright.operators import decontam, generate, minhash, quality
from tidewright.operators.hooks import Injected, resolve
from tidewright.plans.config import Pipeline
from tidewright.plans.monitor import Monitor
from tidewright.plans.report import write_report
from tidewright.runtime import materialize
from tidewright.schema import generation_type, judge_type
from tidewright.sources.files import save_text
from tidewright.sources.readers import load_all, with_position
from tidewright.sources.writers import export, write_shards

#: Order of the records throughout: source, then place within the source.
ORDER = ["source_ord", "row_idx"]


class Run:
    """One run of a configuration. Building it resolves user operators, so a bad configuration fails before any work."""

    def __init__(self, spark: SparkSession, config: Pipeline, operators: list[Injected] | None = None, backends: Callable[[generate.Call], generate.Backend] = generate.make_backend):
        self.spark, self.config, self.backends = spark, config, backends
        self.operators = [*resolve(config.operators), *(operators or [])]
        for call in (config.augmentation, config.judge):
            if call.enabled:
                generate.check_call(call)
        if config.contamination.enabled and not config.contamination.reference_sources:
            raise ValueError("contamination is enabled but names no reference_sources")
        self.folder = config.runtime.work_dir
        m = config.monitoring
        self.monitor = Monitor(m.output_dir or os.path.join(self.folder, "monitoring"), m.job_name, dict(m.labels), m.emit_json, m.emit_prometheus_text)
        self.stages: list[dict[str, Any]] = []
        self.shards: dict[str, str] = {}

    def _stage(self, name: str, make: Callable[[], DataFrame], note: str = "", listed: bool = True) -> DataFrame:
        """Run a stage, count its rows while it is written, and record both."""
        began = time.perf_counter()
        table = make()
        if self.config.runtime.materialize_stages:
            seen = Observation()
            table = materialize(table.observe(seen, F.count(F.lit(1)).alias("rows")), name)
            rows = seen.get["rows"]
        else:
            rows = table.count()
        seconds = time.perf_counter() - began
        self.monitor.record(name, rows, seconds, note)
        if listed:
            self.stages.append({"stage": name, "rows": rows, "note": note, "duration_seconds": seconds})
        return table

    def _hooks(self, hook: str, table: DataFrame) -> DataFrame:
        for operator in self.operators:
            if operator.hook == hook:
                context = {"hook": hook, "work_dir": self.folder, "num_proc": self.config.runtime.num_proc, "spark": self.spark}
                table = self._stage(f"operator_{operator.name}", lambda o=operator, t=table, c=context: o.apply(t, context=c), operator.note)
        return table

    def _write_shards(self, phase: str, table: DataFrame) -> None:
        s = self.config.sharding
        if s.enabled:
            folder = os.path.join(s.output_dir or os.path.join(self.folder, "shards"), phase)
            self.shards[phase] = write_shards(table, folder, s.rows_per_shard, s.export_type, index="row_idx", group="source_ord")

    def _normalized(self) -> DataFrame:
        a, j = self.config.augmentation, self.config.judge
        table = load_all(self.spark, self.config.sources, generation_type(a.output_text_key), judge_type(j.score_key, j.reason_key, j.raw_response_key))
        for column, wanted in (("augmentation", a.output_field), ("judge", j.output_field)):
            if wanted != column:
                table = table.withColumnRenamed(column, wanted)
        return with_position(table, "row_idx")

    def _deduplicated(self, table: DataFrame) -> DataFrame:
        return minhash.remove_near_duplicates(table, self.config.dedup, ORDER)

    def _decontaminated(self, table: DataFrame) -> DataFrame:
        rules = self.config.contamination
        annotated = decontam.annotate(table, load_all(self.spark, rules.reference_sources).select("text"), rules)
        return decontam.split_contaminated(annotated, rules)[0]

    def run(self) -> dict[str, Any]:
        """Run all enabled stages; the summary. A failure is recorded in the metrics and raised again."""
        began = time.perf_counter()
        try:
            table = self._run()
            rows = self.stages[-1]["rows"]
            began_export = time.perf_counter()
            result = table.orderBy(*ORDER) if self.config.export.ordered else table
            export(result.drop(*ORDER), self.config.export, self.config.runtime.single_file_export)
            self.monitor.record("exported", rows, time.perf_counter() - began_export)
            summary = self._summary(table, rows)
            if self.config.visualization.enabled:
                summary["visualization"] = self._report(table, summary)
            summary["monitoring"] = self.monitor.finish(True, time.perf_counter() - began, rows)
            self._write_summary(summary)
            return summary
        except Exception as error:
            self.monitor.finish(False, time.perf_counter() - began, 0, str(error))
            raise

    def _run(self) -> DataFrame:
        c = self.config
        table = self._stage("normalized", self._normalized)
        self._write_shards("normalized", table)
        table = self._hooks("post_normalized", table)
        if c.dedup.enabled:
            table = self._stage("deduplicated", lambda t=table: self._deduplicated(t))
        table = self._hooks("post_dedup", table)
        if c.contamination.enabled:
            table = self._stage("decontaminated", lambda t=table: self._decontaminated(t))
        table = self._hooks("post_contamination", table)
        self.quality_summary: dict[str, Any] = {}
        if c.quality.enabled:
            counted = materialize(quality.enrich(table, c.quality.hf_tokenizer), "counted")
            self.quality_summary = _plain(quality.summary(counted, c.quality.percentiles).first().asDict(True))
            table = self._stage("quality_filtered", lambda: counted.where(quality.passes(c.quality)))
        table = self._hooks("post_quality", table)
        if c.augmentation.enabled:
            table = self._stage("augmented", lambda t=table: generate.generate(t, c.augmentation, self.backends))
        table = self._hooks("post_augmentation", table)
        if c.judge.enabled:
            table = self._stage("judge_filtered", lambda t=table: self._judged(t))
        table = self._hooks("pre_export", self._hooks("post_judge", table))
        self._write_shards("cleaned", table)
        return table

    def _judged(self, table: DataFrame) -> DataFrame:
        # verdicts are written before they are filtered, so no reply is asked for twice
        call = self.config.judge
        judged = materialize(generate.judge(table, call, self.backends, filtered=False), "judged")
        return judged if call.min_score is None else judged.where(generate.keeps_score(F.col(f"{call.output_field}.{call.score_key}"), call.min_score))

    def _summary(self, table: DataFrame, rows: int) -> dict[str, Any]:
        j = self.config.judge
        summary = {
            "generated_at": datetime.now(timezone.utc).isoformat(), "work_dir": self.folder, "export_path": self.config.export.path, "row_count": rows,
            "stages": self.stages, "quality": self.quality_summary, "shards": self.shards,
        }
        if j.enabled:
            found = generate.judge_summary(table, j.output_field, j.score_key).first().asDict()
            if found["sample_count"]:
                summary["judge"] = found
        return summary

    def _report(self, table: DataFrame, summary: dict[str, Any]) -> dict[str, str]:
        v, j = self.config.visualization, self.config.judge
        tokens = quality.metric_sample(table, F.col("quality_signals.token_count"), ORDER, v.include_samples)
        scores = quality.metric_sample(table, F.col(f"{j.output_field}.{j.score_key}"), ORDER, v.include_samples) if j.enabled else []
        return write_report(v.output_dir or os.path.join(self.folder, "report"), summary, tokens, scores)

    def _write_summary(self, summary: dict[str, Any]) -> None:
        save_text(os.path.join(self.folder, "pipeline_summary.json"), json.dumps(summary, ensure_ascii=False, indent=2))


def _plain(value: Any) -> Any:
    return {k: _plain(v) for k, v in value.items()} if isinstance(value, dict) else value


def run_pipeline(spark: SparkSession, config: Pipeline, **overrides: Any) -> dict[str, Any]:
    """Run a configuration, with some of its sections replaced."""
    return Run(spark, replace(config, **overrides)).run()
