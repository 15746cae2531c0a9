"""Named queries about single records: mapping, prompts, model calls, judging, hooks and chains."""

from __future__ import annotations

import hashlib
import json
import os
from http.server import BaseHTTPRequestHandler, ThreadingHTTPServer
from threading import Thread

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewright.functions.text import alphanumeric_ratio, sorted_json, squash, squashed_or_null
from tidewright.operators import blocks, generate, quality
from tidewright.operators.adapt import Mapping, adapt
from tidewright.operators.hooks import Injection, resolve
from tidewright.runtime import materialize, spread


def _table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    found = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return spread(found.select(*columns)) if columns else found


_MESSAGES = Mapping(source_name="samples", id_key="sample_id", messages_key="messages", system_prompt_key="system_prompt")
_SIGNALS = [f"quality_signals.{n}" for n in ("char_count", "message_count", "assistant_turn_count", "user_turn_count")]


# --- mapping ---------------------------------------------------------------------------------------------------------


def adapt_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Message lists with tool calls and system prompts as standard records."""
    made = adapt(_table(spark, sf_dir, "samples", "sample_id", "messages", "system_prompt"), _MESSAGES)
    return made.select("sample_id", "text", "system_prompt", "answer", *_SIGNALS)


def adapt_messages_with_empty(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same with empty messages kept as empty user messages."""
    mapping = Mapping(source_name="samples", id_key="sample_id", messages_key="messages", drop_empty_messages=False)
    made = adapt(_table(spark, sf_dir, "samples", "sample_id", "messages"), mapping)
    return made.select("sample_id", F.array_join(F.transform("messages", lambda m: F.concat_ws("=", m["role"], m["content"])), "|").alias("messages"), *_SIGNALS[1:])


def map_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Metadata given as a map, overlaid by a kept column."""
    given = _table(spark, sf_dir, "samples", "sample_id", "text", "source", F.create_map(*[x for n in ("lang", "domain", "source_name") for x in (F.lit(n), F.col(f"metadata.{n}"))]).alias("about"))
    made = adapt(given, Mapping(source_name="samples", id_key="sample_id", text_key="text", metadata_key="about", keep_fields=["source"]))
    return made.select("sample_id", *[F.col("metadata")[n].alias(n) for n in ("source_name", "adapter", "lang", "domain", "source")], F.size("metadata").alias("fields"))


def struct_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = adapt(_table(spark, sf_dir, "samples", "sample_id", "text", "metadata"), Mapping(source_name="samples", id_key="sample_id", text_key="text", metadata_key="metadata"))
    return made.select("sample_id", *[f"metadata.{n}" for n in ("source_name", "source_path", "adapter", "lang", "conv_id")])


def string_functions(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents", "doc_id", "text")
    return docs.select("doc_id", F.md5(squash(F.col("text"))).alias("squashed"), squashed_or_null(F.col("text")).isNull().alias("blank"), alphanumeric_ratio(F.col("text")).alias("ratio"))


#: Folder of the vocabulary files of public tokenizers.
TOKENIZERS = os.environ.get("TIDEWRIGHT_TOKENIZERS", "/opt/tokenizers")


def tokenizer_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of each document under a tokenizer file; SQL cannot count them."""
    return _table(spark, sf_dir, "documents", "doc_id", "text").select("doc_id", quality.tokenizer_count(F.col("text"), f"{TOKENIZERS}/byte_bpe_50k.json").alias("token_count"))


def sorted_tool_calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JSON with sorted keys, of every tool call."""
    said = _table(spark, sf_dir, "samples", "sample_id", F.explode("messages").alias("m")).where("m.tool_calls is not null")
    return said.select("sample_id", sorted_json(F.col("m.tool_calls")).alias("tool_calls"))


# --- prompts and models ----------------------------------------------------------------------------------------------


def render_prompt_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = _table(spark, sf_dir, "samples", "sample_id", "source", "metadata")
    return df.select("sample_id", generate.render_prompt(df, "{{{source:>24}}} {metadata_json}\n{judge_json}").alias("prompt"))


def digest_model(prompt: str, system_prompt: str | None = None) -> dict[str, str]:
    """A deterministic stand-in whose answer depends on the whole prompt: its digest and length."""
    return {"text": f"{hashlib.md5(prompt.encode()).hexdigest()} {len(prompt)}"}


def score_model(prompt: str, system_prompt: str | None = None) -> str:
    """A deterministic stand-in for a judge: the score follows from the length of the whole prompt."""
    size = len(prompt)
    return json.dumps({"score": size % 11, "reason": f"length {size}", "style": size % 5, "depth": size % 7})


def _generated(spark: SparkSession, sf_dir: str, **settings: object) -> DataFrame:
    call = generate.Generation(enabled=True, model="digest", prompt_template="{sample_id}\n{text}", **settings)
    made = generate.generate(_table(spark, sf_dir, "samples", "sample_id", "ingested_at", "text", "augmentation"), call)
    return made.select("sample_id", F.col("ingested_at").cast("string").alias("ingested_at"), *[f"augmentation.{n}" for n in ("generated_answer", "backend", "model", "error")])


def generation_stage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Model calls over whole records; errors of earlier calls stay in the output field."""
    return _generated(spark, sf_dir, backend="callable", callable_path="tidewright.plans.catalog_records:digest_model")


def generation_by_engine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The batch engine's backend, reached through a callable."""
    return _generated(spark, sf_dir, backend="ray_vllm", callable_path="tidewright.plans.catalog_records:digest_model")


class _Endpoint(BaseHTTPRequestHandler):
    """A chat-completions endpoint that answers as :func:`digest_model` does."""

    def do_POST(self) -> None:  # noqa: N802
        asked = json.loads(self.rfile.read(int(self.headers["Content-Length"])))
        answer = digest_model(asked["messages"][-1]["content"])["text"]
        body = json.dumps({"choices": [{"message": {"content": answer}}]}).encode()
        self.send_response(200)
        self.send_header("Content-Length", str(len(body)))
        self.end_headers()
        self.wfile.write(body)

    def log_message(self, *args: object) -> None:
        return


class _Server(ThreadingHTTPServer):
    request_queue_size = 256


def generation_over_http(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The HTTP backend against an endpoint on the driver's host; the answers are written before it closes."""
    host = spark.conf.get("spark.driver.host", "127.0.0.1")
    try:
        server = _Server((host, 0), _Endpoint)
    except OSError:  # an address of another network: executors of a local master reach the loopback
        host = "127.0.0.1"
        server = _Server((host, 0), _Endpoint)
    Thread(target=server.serve_forever, daemon=True).start()
    try:
        return materialize(_generated(spark, sf_dir, backend="async_http", base_url=f"http://{host}:{server.server_port}/v1", api_key="none"), "answers")
    finally:
        server.shutdown()
        server.server_close()


def judge_stage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Judging with the raw score as a filter."""
    call = generate.Judging(enabled=True, backend="callable", callable_path="tidewright.plans.catalog_records:score_model", model="length", prompt_template="{text}", min_score=5.0)
    made = generate.judge(_table(spark, sf_dir, "samples", "sample_id", "text"), call)
    return made.select("sample_id", *[f"judge.{n}" for n in ("score", "reason", "normalized_score", "raw_response", "model")])


def _served(spark: SparkSession, sf_dir: str, count: int) -> DataFrame:
    call = generate.Call(backend="callable", callable_path="tidewright.plans.catalog_records:digest_model")
    return blocks.serve(_table(spark, sf_dir, "samples", "sample_id", "text", "source", "metadata"), call, sample_count=count)


def batch_serving(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two answers to each record with their usage."""
    served = _served(spark, sf_dir, 2).withColumn("_r", F.col("metadata.inference_results"))
    return served.select("sample_id", F.size("_r").alias("answers"), F.col("_r")[1]["text"].alias("second"), F.col("_r")[0]["finish_reason"].alias("finish_reason"), F.col("_r")[0]["usage"]["total_tokens"].alias("total_tokens"), "metadata.lang")


def judge_dimensions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores by dimension under the record's metadata."""
    call = generate.Call(backend="callable", callable_path="tidewright.plans.catalog_records:score_model")
    judged = blocks.judge_block(_table(spark, sf_dir, "samples", "sample_id", "text", "metadata"), call, ["style", "depth"])
    return judged.select("sample_id", *[F.col("metadata.judge.scores")[d].alias(d) for d in ("style", "depth")], F.col("metadata.judge.reason").alias("reason"), "metadata.domain")


def sft_from_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Training rows, one for each served answer."""
    made = blocks.sft_export(_served(spark, sf_dir, 1), results="metadata.inference_results", extra={"domain": "metadata.domain"})
    return made.select("data_source", F.col("extra_info.domain").alias("domain"), F.array_join(F.transform("messages", lambda m: F.concat_ws("=", m["role"], m["content"])), "|").alias("messages"))


# --- hooks, chains, samples of metrics -------------------------------------------------------------------------------


class LengthFilter:
    """A user operator with options of its own."""

    def run(self, df: DataFrame, least: int = 0) -> DataFrame:
        return df.where(F.length("text") >= least)


def injected_operators(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two operators by class path, with options of their constructor and of their run."""
    found = resolve([
        Injection(hook="post_normalized", class_path="tidewright.operators.hooks.AlphanumericFilter", init_kwargs={"min_ratio": 0.8}), Injection(enabled=False, hook="nowhere"),
        Injection(hook="post_dedup", class_path="tidewright.plans.catalog_records:LengthFilter", run_kwargs={"least": 300}),
    ])
    docs = _table(spark, sf_dir, "documents", "doc_id", "text")
    for operator in found:
        docs = operator.apply(docs, context={"hook": operator.hook})
    return docs.select("doc_id", F.length("text").alias("chars"))


def chained_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A bundle of two blocks with a parameter; every output is a table by name."""
    steps = [
        {"id": "long", "block": blocks.numeric_filter, "inputs": ["${docs}"], "options": {"path": "n_chars", "comparison": ">=", "threshold": "$least"}},
        {"id": "english", "block": blocks.lambda_filter, "inputs": ["${long_output}"], "options": {"condition": lambda df: F.col("lang") == "en"}},
    ]
    chain = blocks.Chain({"docs": _table(spark, sf_dir, "documents", "doc_id", "n_chars", "lang")}).run(steps, {"least": 900})
    named = [chain.tables[t].select("doc_id", F.lit(t).alias("output")) for t in ("long_excluded", "english_output", "english_excluded")]
    return named[0].unionByName(named[1]).unionByName(named[2])


def experiment_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Results of every combination of choices."""
    docs = _table(spark, sf_dir, "documents", "n_chars", "lang")
    found = blocks.experiment_grid(docs, [1.0], lambda df, p: df.where((F.col("n_chars") >= p["least"]) & (F.col("lang") == p["lang"])).count(), least=[300, 900], lang=["en", "de"])
    return spark.createDataFrame([(f["sample_rate"], f["least"], f["lang"], f["result"]) for f in found], "sample_rate double, least int, lang string, result bigint")


def metric_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first values of a metric, as a report shows them."""
    values = quality.metric_sample(_table(spark, sf_dir, "documents"), F.col("n_chars"), ["doc_id"], 100)
    return spark.createDataFrame([(k, v) for k, v in enumerate(values)], "place int, value double")


QUERIES = (
    adapt_messages, adapt_messages_with_empty, map_metadata, struct_metadata, string_functions, tokenizer_counts, sorted_tool_calls, render_prompt_json, generation_stage, generation_by_engine, generation_over_http, judge_stage,
    batch_serving, judge_dimensions, sft_from_results, injected_operators, chained_blocks, experiment_grid, metric_sample,
)
