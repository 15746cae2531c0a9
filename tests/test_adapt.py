from tidewright.operators.adapt import Mapping, adapt

MSG = "array<struct<role:string,content:string,tool_calls:string>>"


def one(spark, schema, row, **mapping):
    return adapt(spark.createDataFrame([row], schema), Mapping(**mapping), "x/file.jsonl").first()


def test_prompt_response_and_kept_field(spark):
    r = one(spark, "id string, prompt string, response string, task string", ("demo-1", " Fix  it ", "Done", "debug"), id_key="id", prompt_key="prompt", response_key="response", keep_fields=["task", "absent"])
    assert r["sample_id"] == "demo-1" and [m["role"] for m in r["messages"]] == ["user", "assistant"]
    assert r["metadata"]["task"] == "debug" and r["answer"] == "Done" and r["text"] == "user: Fix it\n\nassistant: Done"
    assert r["quality_signals"]["message_count"] == 2 and r["quality_signals"]["token_count"] is None and r["judge"] is None


def test_instruction_input_output(spark):
    r = one(spark, "instruction string, input string, output string", ("Add", "1 2", "3"), instruction_key="instruction", input_key="input", output_key="output")
    assert r["messages"][0]["content"] == "Add 1 2" and r["answer"] == "3"
    r = one(spark, "instruction string, input string, output string", (None, "only", None), instruction_key="instruction", input_key="input", output_key="output")
    assert [m["content"] for m in r["messages"]] == ["only"] and r["answer"] is None


def test_messages_rules(spark):
    said = [("USER", "hi", None), (None, "there", None), ("assistant", "  ", '{"b":1}'), ("assistant", "ok", '{"b": 1, "a": 2}'), None]
    r = one(spark, f"m {MSG}", (said,), messages_key="m")
    assert [(m["role"], m["content"]) for m in r["messages"]] == [("user", "hi"), ("user", "there"), ("assistant", "ok")]
    assert r["text"].endswith('assistant: ok\n\ntool_calls: {"a": 2, "b": 1}')
    r = one(spark, f"m {MSG}", (said,), messages_key="m", drop_empty_messages=False)
    assert [(m["role"], m["content"]) for m in r["messages"]][2] == ("user", "") and len(r["messages"]) == 5


def test_blank_list_falls_through_to_prompt(spark):
    r = one(spark, f"m {MSG}, p string", ([("user", " ", None)], "ask"), messages_key="m", prompt_key="p")
    assert [m["content"] for m in r["messages"]] == ["ask"]


def test_plain_strings_and_other_keys(spark):
    assert [m["content"] for m in one(spark, "m array<string>", (["a", " ", "b"],), messages_key="m")["messages"]] == ["a", "b"]
    r = one(spark, "m array<struct<from:string,value:string>>", ([("Human", "q"), ("gpt", "a")],), messages_key="m", message_role_key="from", message_content_key="value")
    assert [(m["role"], m["content"]) for m in r["messages"]] == [("human", "q"), ("gpt", "a")]


def test_text_source(spark):
    r = one(spark, "text string", ("two\n words",), text_key="text")
    assert r["text"] == "two words" and r["sample_id"].startswith("file.jsonl-00000000-")
    r = one(spark, "text string", ("  ",), text_key="text")
    assert r["text"] == "" and [m["content"] for m in r["messages"]] == [""]
    r = one(spark, "text string", (None,), text_key="text")
    assert r["messages"] == [] and r["text"] == ""


def test_clashing_columns_and_metadata(spark):
    r = one(spark, "id int, text string, messages string, metadata struct<source_name:string,k:int>", (5, "t", "not a list", ("given", 3)), id_key="id", text_key="text", messages_key="messages", metadata_key="metadata")
    assert r["sample_id"] == "5" and r["metadata"]["source_name"] == "given" and r["metadata"]["k"] == 3


def test_system_prompt_and_empty_table(spark):
    r = one(spark, "s string, p string", (" Be  kind ", "q"), system_prompt_key="s", prompt_key="p")
    assert r["system_prompt"] == "Be kind" and r["text"] == "system: Be kind\n\nuser: q"
    assert adapt(spark.createDataFrame([], "p string"), Mapping(prompt_key="p")).count() == 0
