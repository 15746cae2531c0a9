"""The standard chat record."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewright.functions.text import squash, squashed_or_null

MESSAGE = T.StructType([T.StructField("role", T.StringType()), T.StructField("content", T.StringType()), T.StructField("tool_calls", T.StringType())])
MESSAGES = T.ArrayType(MESSAGE)

#: Names and types of the signals; the later ones are null until their stage has run. Fixed values.
SIGNALS = {
    "char_count": "int",
    "message_count": "int",
    "assistant_turn_count": "int",
    "user_turn_count": "int",
    "token_count": "int",
    "contamination_ratio": "double",
    "contamination_matched_ngrams": "int",
    "contamination_total_ngrams": "int",
}
#: Columns of a standard record, in order. Fixed values.
COLUMNS = ("sample_id", "text", "messages", "system_prompt", "answer", "source", "metadata", "quality_signals", "augmentation", "judge")


def generation_type(text_key: str = "generated_answer") -> str:
    return f"struct<`{text_key}`:string,backend:string,model:string,error:string,prompt:string>"


def judge_type(score_key: str = "score", reason_key: str = "reason", raw_key: str = "raw_response") -> str:
    return f"struct<`{score_key}`:double,`{reason_key}`:string,normalized_score:double,`{raw_key}`:string,backend:string,model:string,error:string,prompt:string>"


def turns(messages: Column, role: str) -> Column:
    """How many messages have this role."""
    return F.size(F.filter(F.coalesce(messages, F.array().cast(MESSAGES)), lambda m: F.lower(m["role"]) == F.lit(role)))


def default_signals(text: Column, messages: Column) -> Column:
    """Signals of a fresh record: sizes and turns, all later fields null."""
    known = {
        "char_count": F.length(F.coalesce(text, F.lit(""))),
        "message_count": F.size(F.coalesce(messages, F.array().cast(MESSAGES))),
        "assistant_turn_count": turns(messages, "assistant"),
        "user_turn_count": turns(messages, "user"),
    }
    return F.struct(*[known.get(name, F.lit(None)).cast(kind).alias(name) for name, kind in SIGNALS.items()])


def with_signals(existing: Column, changes: dict[str, Column]) -> Column:
    """``existing`` signals with some fields replaced."""
    for name, value in changes.items():
        existing = existing.withField(name, value.cast(SIGNALS[name]))
    return existing


def render_conversation(messages: Column, system_prompt: Column | None = None, tool_json: Column | None = None, squashed: bool = False) -> Column:
    """``role: content`` blocks with blank lines between them, the system prompt first, tool calls after their message.

    Messages without content are left out with their tool calls. ``tool_json``, an array parallel to ``messages``,
    overrides how tool calls are written. ``squashed`` says that roles and contents are normalised already.
    """
    filled = F.coalesce(messages, F.array().cast(MESSAGES))

    def block(message: Column, i: Column) -> Column:
        role = message["role"] if squashed else F.lower(F.coalesce(squashed_or_null(message["role"]), F.lit("user")))
        content = message["content"] if squashed else squash(message["content"])
        calls = F.nullif(message["tool_calls"] if tool_json is None else F.get(tool_json, i), F.lit(""))
        calls = F.when(~calls.isin("[]", "{}", "null", "0", "false", '""'), calls)
        return F.when(content != "", F.concat_ws("\n\n", F.concat(role, F.lit(": "), content), F.concat(F.lit("tool_calls: "), calls)))

    blocks = F.array_compact(F.transform(filled, block))
    if system_prompt is not None:
        opening = F.concat(F.lit("system: "), system_prompt if squashed else squashed_or_null(system_prompt))
        blocks = F.concat(F.array_compact(F.array(opening)), blocks)
    return F.trim(F.array_join(blocks, "\n\n"))


def last_assistant(messages: Column, squashed: bool = False) -> Column:
    """Content of the last assistant message that is not blank, squashed; null without one."""
    if squashed:
        return F.try_element_at(F.filter(messages, lambda m: (m["role"] == "assistant") & (m["content"] != "")), F.lit(-1))["content"]
    spoken = F.filter(F.coalesce(messages, F.array().cast(MESSAGES)), lambda m: (F.lower(m["role"]) == "assistant") & squashed_or_null(m["content"]).isNotNull())
    return squash_null(F.try_element_at(spoken, F.lit(-1))["content"])


def squash_null(text: Column) -> Column:
    return F.when(text.isNotNull(), squash(text))
