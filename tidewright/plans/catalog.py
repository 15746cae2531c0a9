"""Named queries over the tables of a data directory; each has the SQL it is compared against in ``oracle``."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewright.functions.text import alphanumeric_ratio, squash, stable_id, token_count
from tidewright.operators import blocks, decontam, generate, minhash, quality
from tidewright.operators.adapt import Mapping, adapt
from tidewright.runtime import latest_by, materialize, running_sum, spread
from tidewright.sources.writers import shard_sizes

#: Settings of a run: 256 permutations, candidates verified on their shingle sets at 0.8.
NEAR = minhash.Settings()
#: Rules of the queries on decontamination.
EIGHT = decontam.Rules(enabled=True, ngram_size=8, max_contamination_ratio=0.05)
LIMITS = quality.Limits(min_tokens=200, max_tokens=100_000, min_turns=2, min_assistant_turns=1)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# --- conversations ---------------------------------------------------------------------------------------------------


def _said(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(conv_id, turn, role, text): of each turn the latest delivery, blank turns left out."""
    turns = table(spark, sf_dir, "conversations").where("conv_id is not null and turn is not null").select("*", F.concat_ws(":", "conv_id", "turn").alias("_turn"))
    kept = latest_by(turns, "_turn", "logged_at", {"text": squash(F.col("text")), "role": F.lower(squash(F.col("role"))), "conv_id": F.col("conv_id"), "turn": F.col("turn")})
    return kept.where("text <> ''").select("conv_id", "turn", F.coalesce(F.nullif("role", F.lit("")), F.lit("user")).alias("role"), "text")


#: Turns of one bucket when they are numbered.
BUCKET_TURNS = 1000


def normalize_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(conv_id, position, block): the rendered conversation as its blocks in order; joined by blank lines they are its text.

    A conversation may hold a tenth of all turns, so its text is never put into one row: turns are numbered by buckets.
    """
    said = _said(spark, sf_dir).select("conv_id", "turn", F.concat("role", F.lit(": "), "text").alias("block"), F.floor(F.col("turn") / BUCKET_TURNS).alias("_bucket"), F.lit(1).cast("bigint").alias("_one"))
    numbered = running_sum(materialize(said, "turns"), ["conv_id"], "_bucket", ["turn"], "_one", "position")
    return numbered.select("conv_id", "position", "block")


def whole_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per conversation of any length: its signals, first user and assistant turn, and last assistant turn.

    Sums and extremes by partial aggregates; no row holds more than three turns. Turns are rendered with blank lines
    between them, so characters and tokens of the rendered conversation are sums over turns.
    """
    said = _said(spark, sf_dir).select("*", F.length("role") + F.length("text") + 2, token_count(F.concat("role", F.lit(": "), "text"))).toDF("conv_id", "turn", "role", "text", "chars", "tokens")
    by = lambda role: F.when(F.col("role") == role, F.struct("turn", "text"))
    turns_of = lambda role: F.count(F.when(F.col("role") == role, 1))
    signals = {
        "char_count": F.sum("chars") + 2 * (F.count(F.lit(1)) - 1), "message_count": F.count(F.lit(1)), "assistant_turn_count": turns_of("assistant"), "user_turn_count": turns_of("user"), "token_count": F.sum("tokens"),
    }
    made = said.groupBy("conv_id").agg(
        *[c.alias(n) for n, c in signals.items()], F.min(by("user"))["text"].alias("prompt"), F.min(by("assistant"))["text"].alias("response"),
        F.max(by("assistant"))["text"].alias("answer"), F.max(F.struct("turn", "role", "tokens")).alias("last"),
    )
    return made.select("conv_id", F.struct(*signals).alias("quality_signals"), "prompt", "response", "answer", "last")


def turn_signals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whole_conversations(spark, sf_dir).select("conv_id", *[f"quality_signals.{n}" for n in ("char_count", "message_count", "assistant_turn_count", "user_turn_count")])


def last_assistant_answer(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whole_conversations(spark, sf_dir).select("conv_id", "answer")


def quality_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = whole_conversations(spark, sf_dir).where(quality.passes(LIMITS))
    return kept.select("conv_id", *[f"quality_signals.{n}" for n in ("token_count", "message_count", "assistant_turn_count", "char_count")])


def prompt_response_adapter(spark: SparkSession, sf_dir: str) -> DataFrame:
    flat = whole_conversations(spark, sf_dir).select(F.col("conv_id").cast("string").alias("id"), "prompt", "response")
    made = adapt(flat, Mapping(source_name="pairs", id_key="id", prompt_key="prompt", response_key="response"))
    return made.select("sample_id", "text", "answer", "source", "quality_signals.message_count")


def sft_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    flat = whole_conversations(spark, sf_dir).select(F.col("conv_id").cast("string").alias("id"), F.lit("conversations").alias("source"), F.coalesce("prompt", F.lit("")).alias("text"), F.col("response").alias("answer"))
    made = blocks.sft_export(flat, extra={"id": "id"}, system_prompt="Be brief.")
    return made.select(F.col("extra_info.id").alias("id"), "data_source", F.array_join(F.transform("messages", lambda m: F.concat_ws("=", m["role"], m["content"])), "|").alias("messages"))


def token_counter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The prompt is the whole conversation, without the last turn if that is the assistant's."""
    prompt = F.col("quality_signals.token_count") - F.when(F.col("last.role") == "assistant", F.col("last.tokens")).otherwise(0)
    response = F.when(F.length("answer") > 0, token_count(F.col("answer")) + 1).otherwise(0)
    return whole_conversations(spark, sf_dir).select("conv_id", prompt.alias("prompt_tokens"), response.alias("response_tokens"), (prompt + response).alias("total_tokens"))


def render_prompt(spark: SparkSession, sf_dir: str) -> DataFrame:
    chat = whole_conversations(spark, sf_dir)
    template = "Rate conversation {conv_id} ({quality_signals[message_count]} messages).\n\n{answer}\n{unknown}"
    return chat.select("conv_id", generate.render_prompt(chat, template).alias("prompt"))


# --- documents -------------------------------------------------------------------------------------------------------


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents")


def _texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, text) on all cores, for work that takes long per row."""
    return spread(_documents(spark, sf_dir).select("doc_id", "text"))


def normalize_text_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = adapt(spread(_documents(spark, sf_dir).select("doc_id", "text", "lang")), Mapping(source_name="documents", id_key="doc_id", text_key="text", keep_fields=["lang"]))
    return made.select("sample_id", "text", "answer", "source", F.col("metadata.lang").alias("lang"), "quality_signals.char_count", "quality_signals.message_count", "quality_signals.user_turn_count")


def stable_sample_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _documents(spark, sf_dir).select("doc_id", stable_id(F.lit("documents"), F.col("doc_id"), squash(F.col("text"))).alias("sample_id"))


def union_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two sources as one table of standard records, summed up by source."""
    a = adapt(_texts(spark, sf_dir), Mapping(source_name="documents", id_key="doc_id", text_key="text"))
    b = adapt(table(spark, sf_dir, "benchmark"), Mapping(source_name="benchmark", id_key="item_id", text_key="text"))
    both = a.unionByName(b, allowMissingColumns=True)
    return both.groupBy("source").agg(F.count(F.lit(1)).alias("records"), F.sum("quality_signals.char_count").alias("chars"), F.countDistinct(F.md5("text")).alias("texts"))


def token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _documents(spark, sf_dir).select("doc_id", token_count(F.col("text")).alias("token_count"))


def token_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = quality.summary(_texts(spark, sf_dir), [0.1, 0.5, 0.9], token_count(F.col("text")))
    return found.select("sample_count", "min", "max", "mean", *[F.col("percentiles")[str(p)].alias(n) for p, n in ((0.1, "p10"), (0.5, "p50"), (0.9, "p90"))])


def alphanumeric_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _documents(spark, sf_dir).where(alphanumeric_ratio(F.col("text")) >= 0.8).select("doc_id")


def decontam_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = decontam.reference_index(table(spark, sf_dir, "benchmark"), EIGHT)
    return decontam.scores(_texts(spark, sf_dir), index, EIGHT, "doc_id")


def _decontam_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam_score(spark, sf_dir).withColumn("_clean", decontam.keeps(EIGHT, F.col("matched"), F.col("ratio")))


def decontam_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _decontam_split(spark, sf_dir).where("_clean").select("doc_id")


def decontam_excluded(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _decontam_split(spark, sf_dir).where("not _clean").select("doc_id", "matched", "total")


def minhash_signature(spark: SparkSession, sf_dir: str) -> DataFrame:
    signed = minhash.signatures_in_batches(_texts(spark, sf_dir), NEAR, ["doc_id"])
    return signed.select("doc_id", F.array_join("_signature", ",").alias("signature"))


def lsh_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    signed = minhash.signatures_in_batches(_texts(spark, sf_dir), NEAR, ["doc_id"])
    return minhash.candidate_links(minhash.band_keys(signed, NEAR, ["doc_id"]), "doc_id")


def near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.remove_near_duplicates(_texts(spark, sf_dir), NEAR, ["doc_id"]).select("doc_id")


def minhash_block(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the manual's block removes, with another hash function."""
    return minhash.minhash_block(_texts(spark, sf_dir), "doc_id", hash_fc="sha1", precision=32)["remove_ids"]


def shard_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_sizes(_documents(spark, sf_dir), 128, "doc_id")


def numeric_filter_threshold(spark: SparkSession, sf_dir: str) -> DataFrame:
    return blocks.numeric_filter(_documents(spark, sf_dir), "n_chars", ">=", 900)[0].select("doc_id", "n_chars")


def numeric_filter_percentile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return blocks.numeric_filter(_documents(spark, sf_dir), "n_chars", ">", percentile=75)[1].select("doc_id", "n_chars")


def metadata_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return blocks.metadata_stats(table(spark, sf_dir, "samples"), "quality_signals.token_count")


def sample_num(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The sampling operator: a fixed number of documents, the same for the same seed."""
    return blocks.sample_num(_documents(spark, sf_dir), 100, "doc_id", seed=7).select("doc_id", "n_chars")


# --- verdicts --------------------------------------------------------------------------------------------------------


def judge_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Score and normalised score of the judges' raw replies, by delivery."""
    parsed = table(spark, sf_dir, "samples").select("sample_id", "ingested_at", generate.judgement(F.col("judge.raw_response")).alias("v"))
    return parsed.select("sample_id", F.col("ingested_at").cast("string").alias("ingested_at"), F.col("v.score").alias("score"), F.col("v.normalized_score").alias("normalized_score"))


def judge_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = table(spark, sf_dir, "samples").where(generate.keeps_score(F.col("judge.score"), 7.0))
    return kept.select("sample_id", F.col("ingested_at").cast("string").alias("ingested_at"))


def judge_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = table(spark, sf_dir, "samples").where(~F.isnan("judge.score"))
    return generate.judge_summary(kept)


def echo_model(prompt: str, system_prompt: str | None = None) -> dict[str, str]:
    """A deterministic stand-in for a model: the prompt in capitals."""
    return {"text": prompt.upper().strip()}


def callable_generation(spark: SparkSession, sf_dir: str) -> DataFrame:
    call = generate.Generation(enabled=True, backend="callable", callable_path="tidewright.plans.catalog:echo_model", model="echo", prompt_template="{suite}/{item_id}: {text}", keep_prompt=True)
    made = generate.generate(table(spark, sf_dir, "benchmark"), call)
    return made.select("item_id", "augmentation.generated_answer", "augmentation.model", "augmentation.error")


def _stage_counts(spark: SparkSession, sf_dir: str, dedup: minhash.Settings) -> DataFrame:
    """The stages pass on ids and a few numbers of each document; texts are written once, normalised, and never joined back."""
    mapped = adapt(_texts(spark, sf_dir), Mapping(source_name="documents", id_key="doc_id", text_key="text"))
    docs = materialize(mapped.select(F.col("sample_id").cast("bigint").alias("doc_id"), "text", "quality_signals", "messages"), "normalized")
    groups = minhash.near_duplicate_groups(docs, dedup, "doc_id")
    dropped = groups.where("node <> root").select(F.col("node").alias("doc_id"))
    limits = quality.Limits(min_tokens=100, max_tokens=400, min_assistant_turns=0)
    signed = quality.enrich(decontam.annotate(docs, table(spark, sf_dir, "benchmark"), EIGHT), stats=False)
    clean = decontam.keeps(EIGHT, F.coalesce("quality_signals.contamination_matched_ngrams", F.lit(0)), F.coalesce("quality_signals.contamination_ratio", F.lit(0.0)))
    flags = signed.select("doc_id", quality.passes(limits).alias("good"), clean.alias("clean")).join(dropped.withColumn("_gone", F.lit(True)), "doc_id", "left")
    flags = flags.select("good", "clean", F.col("_gone").isNull().alias("unique"))
    stages = {"normalized": F.lit(True), "deduplicated": F.col("unique"), "decontaminated": F.col("unique") & F.col("clean"), "quality_filtered": F.col("unique") & F.col("clean") & F.col("good")}
    counted = flags.agg(*[F.count(F.when(c, 1)).alias(n) for n, c in stages.items()])
    return counted.select(F.explode(F.array(*[F.struct(F.lit(n).alias("stage"), F.col(n).alias("rows")) for n in stages])).alias("_s")).select("_s.*")


def pipeline_stage_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows after each stage of a run over the documents: normalised, deduplicated, decontaminated, filtered."""
    return _stage_counts(spark, sf_dir, NEAR)


_QUERIES: tuple[Callable[[SparkSession, str], DataFrame], ...] = (
    normalize_conversations, turn_signals, last_assistant_answer, quality_filter, prompt_response_adapter, sft_export, token_counter, render_prompt,
    
    normalize_text_source, stable_sample_id, union_sources, token_counts, token_summary, alphanumeric_filter, decontam_score, decontam_filter, decontam_excluded,
    minhash_signature, lsh_candidates, near_dedup, minhash_block, shard_manifest, numeric_filter_threshold, numeric_filter_percentile, metadata_stats, sample_num,
    judge_parse, judge_filter, judge_summary, callable_generation, pipeline_stage_counts,
)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    from tidewright.plans import catalog_io, catalog_records

    return {q.__name__: q for q in (*_QUERIES, *catalog_records.QUERIES, *catalog_io.QUERIES)}


def oracle_sql() -> dict[str, str]:
    from tidewright.plans import oracle, oracle_more

    return {**oracle.SQL, **oracle_more.SQL}
