"""Blocks of the manual: filters on metadata, sampling, counters, statistics, batch serving, SFT export and chains."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewright.functions.text import token_count
from tidewright.operators.generate import Backend, Call, ask, check_call, judgement, make_backend, render_prompt
from tidewright.operators.quality import order_statistics, percentiles

# --- documents -------------------------------------------------------------------------------------------------------


def as_documents(df: DataFrame) -> DataFrame:
    """(id, text, metadata) view of standard records."""
    return df.select(F.col("sample_id").alias("id"), "text", "metadata")


def path_value(path: str | Sequence[str]) -> Column:
    """A nested field by dotted string or list of names."""
    parts = path.split(".") if isinstance(path, str) else list(path)
    return reduce(lambda column, part: column[part], parts[1:], F.col(f"`{parts[0]}`"))


# --- filters ---------------------------------------------------------------------------------------------------------

_COMPARE: dict[str, Callable[[Column, Column], Column]] = {
    ">=": lambda a, b: a >= b, ">": lambda a, b: a > b, "<=": lambda a, b: a <= b,
    "<": lambda a, b: a < b, "==": lambda a, b: a == b, "!=": lambda a, b: a != b,
}


def numeric_condition(path: str | Sequence[str], comparison: str, threshold: float, skip_missing: bool = True, keep_missing: bool = False) -> Column:
    """Comparison of a numeric field. Text that is no number raises; missing values are kept only if asked for.

    With ``skip_missing`` off, a missing value raises instead. NaN satisfies ``!=`` only.
    """
    if comparison not in _COMPARE:
        raise ValueError(f"unknown comparison {comparison!r}")
    value = path_value(path).cast("double")
    met = F.when(F.isnan(value), F.lit(comparison == "!=")).otherwise(_COMPARE[comparison](value, F.lit(float(threshold))))
    missing = F.lit(bool(keep_missing)) if skip_missing else F.raise_error(F.lit(f"missing value at {path}")).cast("boolean")
    return F.when(value.isNull(), missing).otherwise(met)


def numeric_filter(df: DataFrame, path: str | Sequence[str], comparison: str = ">=", threshold: float | None = None, percentile: float | None = None, **missing: bool) -> tuple[DataFrame, DataFrame]:
    """(kept, excluded) by a threshold, or by a percentile (0 to 100) of the field itself.

    The percentile is exact (missing and NaN values left out) and known before the filter is built. Of no values it keeps
    what ``keep_missing`` keeps.
    """
    if (threshold is None) == (percentile is None):
        raise ValueError("give either threshold or percentile")
    if percentile is not None:
        threshold = percentiles(df, path_value(path), [percentile / 100])[0]
        if threshold is None:
            met = F.lit(bool(missing.get("keep_missing", False)))
            return df.where(met), df.where(~met)
    met = numeric_condition(path, comparison, threshold, **missing)
    return df.where(met), df.where(~met)


#: Rows up to which a sample is one top-k list; a larger one is cut at the place in the order where it ends.
MOST_LISTED = 10_000


def sample_num(df: DataFrame, count: int, key: str, seed: int = 0) -> DataFrame:
    """``count`` rows, the same ones for the same data and seed: those with the smallest MD5 of seed and key.

    Ties of equal keys are broken by the key only, so repeated keys may leave a choice open. A small sample is a top-k per
    partition that is merged; for a large one the digest at which it ends is found first, and a filter keeps what lies
    below, so no task ever holds the sample.
    """
    keyed = df.withColumn("_order", F.md5(F.concat_ws(":", F.lit(str(seed)), F.col(key).cast("string"))))
    if count <= MOST_LISTED:
        return keyed.orderBy("_order", key).limit(count).drop("_order")
    place = F.conv(F.substring("_order", 1, 13), 16, 10).cast("double")  # 52 bits of the digest, exact as a double
    found, ends = order_statistics(keyed, place, lambda n: [min(count, n) - 1])
    if not found:
        return df.limit(0)
    before = keyed.where(place < F.lit(ends[0]))
    rest = keyed.where(place == F.lit(ends[0])).orderBy("_order", key).limit(count - before.count())
    return before.unionByName(rest).drop("_order")


def lambda_filter(df: DataFrame, condition: Callable[[DataFrame], Column]) -> tuple[DataFrame, DataFrame]:
    """(kept, excluded) by a function from the table to a condition; null is excluded."""
    met = F.coalesce(condition(df), F.lit(False))
    return df.where(met), df.where(~met)


# --- statistics ------------------------------------------------------------------------------------------------------


def metadata_stats(df: DataFrame, path: str | Sequence[str]) -> DataFrame:
    """One row: total, count, min, max, mean, p50, p75, p90, p95, p99 of a numeric field; missing values and NaN do not count."""
    shares = (50, 75, 90, 95, 99)
    value = path_value(path).cast("double")
    values = df.select(F.when(~F.isnan(value), value).alias("_v"))
    found = percentiles(values, F.col("_v"), [p / 100 for p in shares])
    counted = values.agg(F.count(F.lit(1)).alias("total"), F.count("_v").alias("count"), F.min("_v").alias("min"), F.max("_v").alias("max"), F.avg("_v").alias("mean"))
    return counted.select("*", *[F.lit(v).cast("double").alias(f"p{p}") for p, v in zip(shares, found)])


#: Marks around a message in the built-in chat templates: (before the role, after the role, after the content).
TEMPLATES = {"plain": ("", ": ", "\n"), "chatml": ("<|im_start|>", "\n", "<|im_end|>\n")}


def token_counter(df: DataFrame, messages: str = "messages", response: str | None = "answer", template: str = "plain", end_token: bool = False, count: Callable[[Column], Column] = token_count) -> DataFrame:
    """``df`` with prompt_tokens, response_tokens and total_tokens.

    The prompt is every message before the last assistant message, written in the chat template; a missing response has
    0 tokens. ``end_token`` adds one for the end of the response. ``count`` may be a tokenizer's count.
    """
    before, between, after = TEMPLATES[template]
    said = F.coalesce(F.col(messages), F.array().cast(df.schema[messages].dataType))
    last = F.element_at(said, -1)
    prompt = F.when((F.size(said) > 0) & (F.lower(last["role"]) == "assistant"), F.slice(said, 1, F.size(said) - 1)).otherwise(said)
    written = F.array_join(F.transform(prompt, lambda m: F.concat(F.lit(before), F.coalesce(m["role"], F.lit("user")), F.lit(between), F.coalesce(m["content"], F.lit("")), F.lit(after))), "")
    reply = F.col(response) if response else F.lit(None).cast("string")
    counted = df.withColumn("prompt_tokens", count(written)).withColumn("response_tokens", F.when(F.length(reply) > 0, count(reply) + int(end_token)).otherwise(F.lit(0)))
    return counted.withColumn("total_tokens", F.col("prompt_tokens") + F.col("response_tokens"))


# --- batch serving and judging ---------------------------------------------------------------------------------------

INFERENCE = "array<struct<text:string,finish_reason:string,usage:struct<prompt_tokens:int,completion_tokens:int,total_tokens:int>,raw_choice:string>>"


def serve(df: DataFrame, call: Call, query: Callable[[DataFrame], Column] | None = None, sample_count: int = 1, result_key: str = "inference_results", factory: Callable[[Call], Backend] = make_backend) -> DataFrame:
    """``df`` with ``metadata.<result_key>``: ``sample_count`` answers of the model to each record's query.

    The query is a column built by ``query``, else the prompt template. The samples of a record are asked side by side
    as rows of their own and put together again by one aggregate. Usage is counted in tokens of
    the built-in tokenizer; a failed call has finish reason ``error`` and its message in ``raw_choice``.
    """
    check_call(call)
    prompt = query(df) if query else render_prompt(df, call.prompt_template)
    fanned = df.withColumn("_prompt_text", prompt).withColumn("_copy", F.explode(F.sequence(F.lit(1), F.lit(max(1, sample_count)))))
    # a record's copies have consecutive row numbers, so the first one's number names the record
    answered = ask(fanned.withColumn("_row", F.monotonically_increasing_id()), call, F.col("_prompt_text"), factory)
    used = F.struct(token_count(F.col("_prompt")).alias("prompt_tokens"), token_count(F.col("_answer")).alias("completion_tokens"))
    one = F.struct(
        F.coalesce("_answer", F.lit("")).alias("text"), F.when(F.col("_error").isNull(), "stop").otherwise("error").alias("finish_reason"),
        F.struct(used["prompt_tokens"].alias("prompt_tokens"), used["completion_tokens"].alias("completion_tokens"), (used["prompt_tokens"] + used["completion_tokens"]).alias("total_tokens")).alias("usage"),
        F.coalesce("_error", "_answer").alias("raw_choice"),
    )
    kept = [c for c in df.columns]
    if sample_count <= 1:
        made = answered.withColumn("_results", F.array(one).cast(INFERENCE))
    else:
        numbered = answered.withColumn("_record", F.col("_row") - (F.col("_copy") - 1)).withColumn("_one", F.struct(F.col("_copy").alias("k"), one.alias("r")))
        grouped = numbered.groupBy("_record").agg(F.first(F.struct(*kept)).alias("_kept"), F.transform(F.array_sort(F.collect_list("_one")), lambda x: x["r"]).cast(INFERENCE).alias("_results"))
        made = grouped.select("_kept.*", "_results")
    return made.withColumn("metadata", _with_field(df, "metadata", result_key, F.col("_results"))).select(*kept)


def _with_field(df: DataFrame, column: str, name: str, value: Column) -> Column:
    return F.col(column).withField(name, value) if column in df.columns else F.struct(value.alias(name))


def judge_block(df: DataFrame, call: Call, dimensions: Sequence[str] = ("score",), scale: float = 10.0, save_reason: bool = True, result_key: str = "judge", factory: Callable[[Call], Backend] = make_backend) -> DataFrame:
    """``df`` with ``metadata.<result_key>``: a score, or a map of scores by dimension, and the reason if wanted.

    Several dimensions are read from the reply's JSON object by name; missing ones are null. The raw reply is dropped.
    """
    check_call(call)
    answered = ask(df, call, render_prompt(df, call.prompt_template), factory)
    if list(dimensions) == ["score"]:
        verdict = judgement(F.col("_answer"), scale)
        fields = [verdict["score"].alias("score"), *([verdict["reason"].alias("reason")] if save_reason else [])]
    else:
        parsed = F.from_json("_answer", T.StructType([*[T.StructField(d, T.DoubleType()) for d in dimensions], T.StructField("reason", T.StringType())]))
        scores = F.map_from_arrays(F.array(*[F.lit(d) for d in dimensions]), F.array(*[parsed[d] for d in dimensions]))
        fields = [scores.alias("scores"), *([parsed["reason"].alias("reason")] if save_reason else [])]
    made = answered.withColumn("_made", F.struct(*fields))
    return made.withColumn("metadata", _with_field(df, "metadata", result_key, F.col("_made"))).select(*df.columns)


# --- export ----------------------------------------------------------------------------------------------------------


def drop_metadata(df: DataFrame, *names: str) -> DataFrame:
    """Records without these fields of their metadata, as a writer adapter would leave them out."""
    return df.withColumn("metadata", F.col("metadata").dropFields(*names))


def sft_messages(prompt: Column, response: Column, system_prompt: str | None = None) -> Column:
    said = lambda role, content: F.struct(F.lit(role).alias("role"), content.alias("content"))
    return F.array(*([said("system", F.lit(system_prompt))] if system_prompt else []), said("user", prompt), said("assistant", response))


def sft_export(df: DataFrame, formatter: Callable[[DataFrame], Column] | None = None, results: str | None = None, source: str = "source", extra: dict[str, str] | None = None, system_prompt: str | None = None) -> DataFrame:
    """(messages, data_source, extra_info) training rows.

    By default one row per record with its text as prompt and ``answer`` as response; with ``results`` (a path to an
    array of structs with ``text``) one row per result; with ``formatter`` whatever message array it builds. Rows
    without a response are left out. ``extra`` maps names in ``extra_info`` to paths.
    """
    prompt = F.col("text")
    if results:
        df = df.withColumn("_result", F.explode(path_value(results)))
        response = F.col("_result.text")
    else:
        response = F.col("answer") if "answer" in df.columns else path_value("metadata.answer")
    messages = formatter(df) if formatter else sft_messages(prompt, response, system_prompt)
    kept = df if formatter else df.where(F.length(response) > 0)
    info = F.struct(*[path_value(p).alias(n) for n, p in (extra or {}).items()]) if extra else F.lit(None).cast("struct<ground_truth:string>")
    origin = path_value(source) if source.split(".")[0] in df.columns else F.lit(None).cast("string")
    return kept.select(messages.alias("messages"), origin.alias("data_source"), info.alias("extra_info"))


# --- chains ----------------------------------------------------------------------------------------------------------


@dataclass
class Chain:
    """Named blocks over lazy tables. A block's outputs are registered as ``id_output`` and ``id_<name>``."""

    tables: dict[str, DataFrame] = field(default_factory=dict)

    def add(self, identity: str, block: Callable[..., Any], *inputs: str, **options: Any) -> Chain:
        """Run a block on registered tables (``${name}`` or ``name``); options may refer to tables the same way."""
        look = lambda v: self.tables[v[2:-1]] if isinstance(v, str) and v.startswith("${") and v.endswith("}") else v
        made = block(*[self.tables[i.removeprefix("${").removesuffix("}")] for i in inputs], **{k: look(v) for k, v in options.items()})
        outputs = made if isinstance(made, dict) else {"output": made[0], "excluded": made[1]} if isinstance(made, tuple) else {"output": made}
        for name, table in outputs.items():
            self.tables[f"{identity}_{name}"] = table
        return self

    def run(self, steps: Sequence[dict[str, Any]], parameters: dict[str, Any] | None = None) -> Chain:
        """A bundle of steps ``{id, block, inputs, options}``; ``$name`` in options is replaced by a parameter."""
        given = parameters or {}
        fill = lambda v: given[v[1:]] if isinstance(v, str) and v.startswith("$") and v[1:] in given else v
        for step in steps:
            self.add(step["id"], step["block"], *step.get("inputs", []), **{k: fill(v) for k, v in step.get("options", {}).items()})
        return self


def experiment_grid(df: DataFrame, rates: Sequence[float], run: Callable[[DataFrame, dict[str, Any]], Any], seed: int = 0, **choices: Sequence[Any]) -> list[dict[str, Any]]:
    """Results of ``run`` for every sampling rate and every combination of choices."""
    import itertools

    results = []
    for rate in rates:
        part = df if rate >= 1 else df.sample(fraction=rate, seed=seed)
        for values in itertools.product(*choices.values()):
            point = {"sample_rate": rate, **dict(zip(choices, values))}
            results.append({**point, "result": run(part, point)})
    return results

