"""Mapping of source records to the standard chat record, resolved against the source's schema at plan time."""

from __future__ import annotations

import json
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewright.functions.text import sorted_json, squash, squashed_or_null, stable_id
from tidewright.schema import COLUMNS, MESSAGES, default_signals, generation_type, judge_type, last_assistant, render_conversation


@dataclass
class Mapping:
    """Which source column plays which part; null means that the source has no such column."""

    source_name: str | None = None
    id_key: str | None = None
    messages_key: str | None = None
    message_role_key: str = "role"
    message_content_key: str = "content"
    system_prompt_key: str | None = None
    prompt_key: str | None = None
    response_key: str | None = None
    instruction_key: str | None = None
    input_key: str | None = None
    output_key: str | None = None
    text_key: str | None = None
    metadata_key: str | None = None
    keep_fields: list[str] = field(default_factory=list)
    drop_empty_messages: bool = True


def _as_text(column: Column, kind: T.DataType) -> Column:
    """The value as a string: JSON for nested types."""
    return F.to_json(column) if isinstance(kind, (T.ArrayType, T.StructType, T.MapType)) else column.cast("string")


class _Row:
    """Columns of a source by key; a key that is unset or absent has none.

    Texts are squashed once, in columns of their own (:meth:`bound`), which every later expression reads.
    """

    def __init__(self, df: DataFrame):
        self.fields = {f.name: f.dataType for f in df.schema.fields}

    def get(self, key: str | None) -> Column | None:
        return _as_text(F.col(f"`{key}`"), self.fields[key]) if key and key in self.fields else None

    def bound(self, df: DataFrame, mapping: Mapping) -> DataFrame:
        keys = dict.fromkeys(k for k in (mapping.prompt_key, mapping.instruction_key, mapping.text_key, mapping.input_key, mapping.response_key, mapping.output_key, mapping.system_prompt_key) if k in self.fields)
        return df.select("*", *[squash(self.get(k)).alias(f"__squashed_{k}") for k in keys])

    def filled(self, *keys: str | None) -> Column:
        """The first of these columns that is not blank, squashed; null if all are."""
        there = [F.nullif(F.col(f"`__squashed_{k}`"), F.lit("")) for k in keys if k in self.fields]
        return F.coalesce(*there, F.lit(None).cast("string"))


def _message(item: Column, kind: T.DataType, mapping: Mapping) -> Column:
    """A normalised message, or null if it says nothing."""
    null = F.lit(None).cast(MESSAGES.elementType)
    if isinstance(kind, T.StructType):
        parts = {f.name: f.dataType for f in kind.fields}
        part = lambda name: _as_text(item[name], parts[name]) if name in parts else F.lit(None).cast("string")
        role = F.lower(F.coalesce(squashed_or_null(part(mapping.message_role_key)), F.lit("user")))
        content, calls = squash(part(mapping.message_content_key)), part("tool_calls")
    elif isinstance(kind, T.MapType):
        role = F.lower(F.coalesce(squashed_or_null(item[mapping.message_role_key]), F.lit("user")))
        content, calls = squash(item[mapping.message_content_key]), _as_text(item["tool_calls"], kind.valueType)
    else:
        role, content, calls = F.lit("user"), squash(_as_text(item, kind)), F.lit(None).cast("string")
    made = F.struct(role.alias("role"), content.alias("content"), calls.alias("tool_calls")).cast(MESSAGES.elementType)
    return F.when(item.isNotNull() & (content != ""), made).otherwise(null)


def _said(role: str, content: Column) -> Column:
    made = F.struct(F.lit(role).alias("role"), content.alias("content"), F.lit(None).cast("string").alias("tool_calls"))
    return F.when(content.isNotNull(), made.cast(MESSAGES.elementType))


def messages_of(df: DataFrame, mapping: Mapping) -> Column:
    """The record's messages: the message list if it says anything, else prompt, input and response.

    The prompt is the first filled of prompt, instruction and text column, the input follows it after a blank. A dropped
    message of a list is replaced by an empty user message if ``drop_empty_messages`` is off. A record with nothing but
    a blank text has one empty user message; one with nothing at all has none. ``df`` has the columns of
    :meth:`_Row.bound`.
    """
    row = _Row(df)
    prompt = row.filled(mapping.prompt_key, mapping.instruction_key, mapping.text_key)
    extra = row.filled(mapping.input_key)
    response = row.filled(mapping.response_key, mapping.output_key)
    asked = F.nullif(F.concat_ws(" ", prompt, extra), F.lit(""))
    pair = F.array_compact(F.array(_said("user", asked), _said("assistant", response)))
    text = row.get(mapping.text_key)
    if text is not None:
        pair = F.when((F.size(pair) == 0) & (F.length(text) > 0), F.array(_said("user", F.lit("")))).otherwise(pair)
    pair = pair.cast(MESSAGES)
    kind = row.fields.get(mapping.messages_key) if mapping.messages_key else None
    if not isinstance(kind, T.ArrayType):
        return pair
    listed = F.transform(F.col(f"`{mapping.messages_key}`"), lambda m: _message(m, kind.elementType, mapping))
    listed = F.array_compact(listed) if mapping.drop_empty_messages else F.transform(listed, lambda m: F.coalesce(m, _said("user", F.lit(""))))
    return F.when(F.size(listed) > 0, listed).otherwise(pair).cast(MESSAGES)


def metadata_of(df: DataFrame, mapping: Mapping, source_name: str, source_path: str) -> Column:
    """Origin of the record, overlaid by the fields of the metadata column, overlaid by the kept columns.

    A struct column gives a struct with all its fields; a map column, whose keys are known at run time only, makes the
    whole a map of strings.
    """
    parts = {"source_name": F.lit(source_name), "source_path": F.lit(source_path), "adapter": F.lit("tidewright")}
    kept = {name: F.col(f"`{name}`") for name in mapping.keep_fields if name in df.columns}
    kind = df.schema[mapping.metadata_key].dataType if mapping.metadata_key in df.columns else None
    if isinstance(kind, T.MapType):
        own = F.coalesce(F.transform_values(F.col(f"`{mapping.metadata_key}`"), lambda k, v: _as_text(v, kind.valueType)), F.create_map().cast("map<string,string>"))
        last = F.create_map(*[x for n, c in kept.items() for x in (F.lit(n), _as_text(c, df.schema[n].dataType))]).cast("map<string,string>")
        first = F.create_map(*[x for n, c in parts.items() for x in (F.lit(n), c)])
        beside = lambda low, high: F.map_concat(F.map_filter(low, lambda k, _: ~F.map_contains_key(high, k)), high)
        return beside(beside(first, own), last)
    if isinstance(kind, T.StructType):
        whole = F.col(f"`{mapping.metadata_key}`")
        for f in kind.fields:
            value = whole[f.name]
            parts[f.name] = F.when(whole.isNotNull(), value).otherwise(parts[f.name]) if f.name in parts and isinstance(f.dataType, T.StringType) else value
    parts |= kept
    return F.struct(*[c.alias(n) for n, c in parts.items()])


def adapt(df: DataFrame, mapping: Mapping, source_path: str = "", position: Column | None = None, generation: str | None = None, judge: str | None = None) -> DataFrame:
    """Standard records of ``df``: one projection, no shuffle.

    ``position`` is the record's place within its source, used for generated ids (0 where it is not given). The ids of a
    source are taken as they are and need not be unique. Null and blank values never become text; source columns are
    dropped unless ``keep_fields`` names them.
    """
    name = mapping.source_name or source_path.rsplit("/", 1)[-1]
    row = _Row(df)
    bound = row.bound(df, mapping)
    base = bound.select("*", messages_of(bound, mapping).alias("__messages")).withColumn("__system", row.filled(mapping.system_prompt_key))
    tools = F.transform("__messages", lambda m: m["tool_calls"])
    has_tools = isinstance(df.schema[mapping.messages_key].dataType, T.ArrayType) if mapping.messages_key in df.columns else False
    if has_tools and "tool_calls" in df.schema[mapping.messages_key].dataType.simpleString():
        # one JSON array per record goes through Python, and only where a message has tool calls
        raw = F.when(F.exists("__messages", lambda m: m["tool_calls"].isNotNull()), F.to_json(tools))
        base = base.withColumn("__tools", F.from_json(_sorted_each(raw), "array<string>"))
    else:
        base = base.withColumn("__tools", F.lit(None).cast("array<string>"))
    rendered = render_conversation(F.col("__messages"), F.col("__system"), F.coalesce("__tools", tools), squashed=True)
    given = row.get(mapping.text_key)
    text = F.when(F.length(given) > 0, F.col(f"`__squashed_{mapping.text_key}`")).otherwise(rendered) if given is not None else rendered
    base = base.withColumn("__text", text)
    identity = row.get(mapping.id_key)
    made = stable_id(F.lit(name), (position if position is not None else F.lit(0)).cast("bigint"), F.col("__text"))
    answer = F.coalesce(row.filled(mapping.response_key, mapping.output_key), last_assistant(F.col("__messages"), squashed=True))
    columns = {
        "sample_id": F.coalesce(identity, made) if identity is not None else made,
        "text": F.col("__text"),
        "messages": F.col("__messages"),
        "system_prompt": F.col("__system"),
        "answer": answer,
        "source": F.lit(name),
        "metadata": metadata_of(df, mapping, name, source_path),
        "quality_signals": default_signals(F.col("__text"), F.col("__messages")),
        "augmentation": F.lit(None).cast(generation or generation_type()),
        "judge": F.lit(None).cast(judge or judge_type()),
    }
    return base.select(*[columns[c].alias(c) for c in COLUMNS])


def _sorted_each(array_json: Column) -> Column:
    """A JSON array of JSON strings with every member's keys sorted."""
    def run(values: pa.Array) -> pa.Array:
        out = []
        for value in values.to_pylist():
            if value is None:
                out.append(None)
                continue
            members = []
            for member in json.loads(value):
                try:
                    members.append(None if member is None else json.dumps(json.loads(member), ensure_ascii=False, sort_keys=True))
                except ValueError:
                    members.append(member)
            out.append(json.dumps(members, ensure_ascii=False))
        return pa.array(out, pa.string())

    return F.arrow_udf(run, T.StringType())(array_json)


def canonical_tool_calls(column: Column) -> Column:
    """Tool calls with sorted keys, as they are written into rendered text."""
    return F.when(column.isNotNull(), sorted_json(column))
