import json
import os
import re
import warnings

import pytest

from tidewright.plans import cli
from tidewright.plans.config import pipeline_config
from tidewright.plans.monitor import Monitor, missing_artifacts, prometheus_labels
from tidewright.plans.pipeline import Run
from tidewright.plans.report import mermaid, page

ASKED = "How do we move the nightly export to the new queue?"
TOLD = "First drain the old queue, then switch the writer, and keep both readers for one week."
OTHER = ("Why did the morning report stay empty?", "The scan read a folder without files, so every later step had no rows, and nobody was told.")


def setup(tmp_path, **more):
    said = lambda q, a: [{"role": "user", "content": q}, {"role": "assistant", "content": a}]
    rows = [{"id": "sample-1", "messages": said(ASKED, TOLD)}, {"id": "sample-2", "messages": said(*OTHER)}, {"id": "sample-3", "messages": said(ASKED, TOLD)}]
    (tmp_path / "in.jsonl").write_text("\n".join(map(json.dumps, rows)))
    (tmp_path / "ref.jsonl").write_text(json.dumps({"text": f"{ASKED} First drain the old queue then switch the writer and keep going."}))
    return {
        "sources": [{"path": str(tmp_path / "in.jsonl"), "adapter": {"source_name": "demo", "id_key": "id", "messages_key": "messages"}}],
        "runtime": {"work_dir": str(tmp_path / "out"), "single_file_export": True},
        "sharding": {"rows_per_shard": 2, "export_type": "jsonl"},
        "contamination": {"enabled": True, "reference_sources": [{"path": str(tmp_path / "ref.jsonl"), "adapter": {"text_key": "text"}}], "ngram_size": 5, "max_contamination_ratio": 0.3},
        "quality": {"min_tokens": 4, "max_tokens": 4096},
        "export": {"path": str(tmp_path / "out/cleaned.jsonl")},
        **more,
    }


def _figures(pair, size):
    """(tokens, characters, distinct n-grams, matched ones) of a rendered exchange, counted with Python's own means."""
    text = "user: {}\n\nassistant: {}".format(*pair)
    words = re.findall(r"\w+", text.lower())
    return len(re.findall(r"\w+|[^\w\s]", text)), len(text), len({tuple(words[i : i + size]) for i in range(len(words) - size + 1)}), 0


def judge_model(prompt, system_prompt=None):
    return '{"score": 9, "reason": "good"}'


def test_golden_run(spark, tmp_path):
    judged = {"enabled": True, "backend": "callable", "callable_path": "tests.test_pipeline:judge_model", "min_score": 5.0}
    hook = {"hook": "post_quality", "class_path": "tidewright.operators.hooks.AlphanumericFilter", "init_kwargs": {"min_ratio": 0.1}, "name": "alnum"}
    generated = {"enabled": True, "backend": "callable", "callable_path": "tidewright.plans.catalog:echo_model"}
    summary = Run(spark, pipeline_config(setup(tmp_path, judge=judged, operators=[hook], augmentation=generated))).run()
    assert [(s["stage"], s["rows"]) for s in summary["stages"]] == [("normalized", 3), ("deduplicated", 2), ("decontaminated", 1), ("quality_filtered", 1), ("operator_alnum", 1), ("augmented", 1), ("judge_filtered", 1)]
    rows = [json.loads(line) for line in open(tmp_path / "out/cleaned.jsonl")]
    assert [r["sample_id"] for r in rows] == ["sample-2"]
    signals = rows[0]["quality_signals"]
    assert (signals["token_count"], signals["char_count"], signals["contamination_total_ngrams"], signals["contamination_matched_ngrams"]) == _figures(OTHER, 5)
    assert rows[0]["judge"]["normalized_score"] == 0.9 and summary["judge"]["mean"] == 9.0 and rows[0]["augmentation"]["generated_answer"]
    shards = {k: [m["rows"] for m in json.load(open(v))] for k, v in summary["shards"].items()}
    assert shards == {"normalized": [2, 1], "cleaned": [1]}
    assert missing_artifacts(str(tmp_path / "out/monitoring")) == [] and os.path.exists(tmp_path / "out/report/report.html")
    metrics = open(tmp_path / "out/monitoring/pipeline_metrics.prom").read()
    assert 'agent_pipeline_stage_rows{job="tidewright",stage="deduplicated"} 2' in metrics and "agent_pipeline_run_success" in metrics
    assert json.load(open(tmp_path / "out/pipeline_summary.json"))["row_count"] == 1


def test_export_without_order(spark, tmp_path):
    config = setup(tmp_path, export={"path": str(tmp_path / "out/cleaned.jsonl"), "ordered": False}, contamination={"enabled": False})
    summary = Run(spark, pipeline_config(config)).run()
    assert summary["row_count"] == 2 and sorted(json.loads(line)["sample_id"] for line in open(tmp_path / "out/cleaned.jsonl")) == ["sample-1", "sample-2"]


def test_failure_is_recorded(spark, tmp_path):
    config = setup(tmp_path)
    config["sources"][0]["path"] = str(tmp_path / "absent.jsonl")
    with pytest.raises(Exception):
        Run(spark, pipeline_config(config)).run()
    metrics = json.load(open(tmp_path / "out/monitoring/pipeline_metrics.json"))
    assert metrics["success"] is False and metrics["error_message"]


def test_configuration(tmp_path):
    with pytest.raises(ValueError):
        pipeline_config({})
    with pytest.raises(ValueError):
        pipeline_config({"sources": [{"path": "x"}], "quality": {"min_tokens": "5"}})
    with warnings.catch_warnings(record=True) as seen:
        warnings.simplefilter("always")
        made = pipeline_config({"sources": [{"path": "x", "odd": 1}], "quality": None, "judge": {"score_scale": 5}, "operators": [{"hook": "post_dedup", "class_path": "a.b", "init_kwargs": {"k": 1}}]})
    assert seen and made.quality.min_tokens == 16 and made.judge.score_scale == 5.0 and made.operators[0].init_kwargs == {"k": 1} and made.dedup.num_permutations == 256
    config = tmp_path / "c.json"
    config.write_text(json.dumps({"sources": [{"path": "x"}]}))
    cli.main(["validate", "--config", str(config)])
    with pytest.raises(SystemExit):
        cli.main(["check-metrics", "--dir", str(tmp_path)])
    assert not os.path.exists("outputs")


def test_monitor_and_report(tmp_path):
    m = Monitor(str(tmp_path), labels={"b": 'q"\\'})
    m.record("s", 10, 0.5, "n")
    out = m.finish(True, 1.0, 10)
    assert json.load(open(out["metrics_json"]))["stages"][0]["rows"] == 10
    assert prometheus_labels({"b": 'q"\\\n', "a": 1}) == '{a="1",b="q\\"\\\\\\n"}'
    assert "s0 --> s1" in mermaid([{"stage": "a", "rows": 1}, {"stage": "b", "rows": 2}])
    assert "&lt;x&gt;" in page([{"stage": "<x>", "rows": 1}], [1.0], [])
    cli.main(["alerts"])
    cli.main(["dashboard"])


def test_stream(spark, tmp_path):
    from tidewright.operators.adapt import Mapping
    from tidewright.operators.quality import Limits
    from tidewright.streaming.stateless import clean_stream, for_each_batch, read_json_stream

    (tmp_path / "s").mkdir()
    (tmp_path / "s/a.json").write_text('{"id": "1", "p": "ask me", "r": "an answer of some length"}\n{"id": "2", "p": "x", "r": ""}')
    stream = read_json_stream(spark, str(tmp_path / "s"), "id string, p string, r string")
    clean = clean_stream(stream, Mapping(id_key="id", prompt_key="p", response_key="r"), Limits(min_tokens=3))
    seen = []
    for_each_batch(clean, lambda df, _: seen.extend(r["sample_id"] for r in df.collect()), str(tmp_path / "cp")).trigger(availableNow=True).start().awaitTermination()
    assert seen == ["1"]
    with pytest.raises(ValueError):
        clean_stream(stream, Mapping(prompt_key="p"), Limits())
