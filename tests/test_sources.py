import json

import pandas as pd
import pyarrow as pa
import pyarrow.feather
import pytest

from tidewright.operators.adapt import Mapping
from tidewright.sources import readers, writers


@pytest.fixture()
def table():
    return pa.table({"id": ["a", "b", "c"], "text": ["one", "two, \"x\"", None]})


def texts(df):
    return [r["text"] for r in df.orderBy("id").collect()]


def test_all_formats(spark, tmp_path, table):
    frame = table.to_pandas()
    frame.to_json(tmp_path / "l.jsonl", orient="records", lines=True)
    (tmp_path / "a.json").write_text(json.dumps(frame.to_dict("records"), default=str).replace("NaN", "null"))
    frame.to_csv(tmp_path / "c.csv", index=False, quoting=1, na_rep="")
    frame.to_parquet(tmp_path / "p.parquet")
    with pa.OSFile(str(tmp_path / "f.arrow"), "wb") as out, pa.ipc.new_file(out, table.schema) as w:
        w.write_table(table, max_chunksize=2)
    with pa.OSFile(str(tmp_path / "s.arrow"), "wb") as out, pa.ipc.new_stream(out, table.schema) as w:
        w.write_table(table)
    pyarrow.feather.write_feather(table, str(tmp_path / "x.feather"))
    for name in ("l.jsonl", "a.json", "c.csv", "p.parquet", "f.arrow", "s.arrow", "x.feather"):
        assert texts(readers.read(spark, str(tmp_path / name))) == ["one", 'two, "x"', None], name
    assert readers.format_of("x.arrow", "json") == "arrow" and readers.format_of("x.csv", "odd") == "csv" and readers.format_of("d/x.jsonl.zst") == "json"
    with pytest.raises(ValueError):
        readers.format_of("nothing")


def test_arrow_types_and_empty(spark, tmp_path):
    t = pa.table({"d": pa.array(["u", "v"]).dictionary_encode(), "l": pa.array(["x", None], pa.large_string()), "n": pa.array([[1], []], pa.list_(pa.int32()))})
    pyarrow.feather.write_feather(t, str(tmp_path / "t.feather"))
    assert [tuple(r) for r in readers.read(spark, str(tmp_path / "t.feather")).collect()] == [("u", "x", [1]), ("v", None, [])]
    pyarrow.feather.write_feather(t.slice(0, 0), str(tmp_path / "e.feather"))
    assert readers.read(spark, str(tmp_path / "e.feather")).count() == 0


def test_positions_and_union(spark, tmp_path):
    pd.DataFrame({"text": [f"t{i}" for i in range(7)]}).to_json(tmp_path / "a.jsonl", orient="records", lines=True)
    pd.DataFrame({"q": ["hi"], "task": ["debug"]}).to_json(tmp_path / "b.jsonl", orient="records", lines=True)
    a = readers.Source(str(tmp_path / "a.jsonl"), adapter=Mapping(text_key="text"))
    b = readers.Source(str(tmp_path / "b.jsonl"), adapter=Mapping(source_name="b", prompt_key="q", keep_fields=["task"]))
    rows = readers.load_all(spark, [a, b]).collect()
    assert [r["sample_id"][:16] for r in rows[:2]] == ["a.jsonl-00000000", "a.jsonl-00000001"] and len(rows) == 8
    assert rows[-1]["metadata"]["task"] == "debug" and rows[0]["metadata"]["task"] is None and rows[-1]["source_ord"] == 1
    with pytest.raises(ValueError):
        readers.load_all(spark, [])


def test_shards(spark, tmp_path):
    df = spark.createDataFrame([(i * 3, f"r{i}") for i in range(7)], "i bigint, v string").repartition(3)
    manifest = json.loads(open(writers.write_shards(df, str(tmp_path / "s"), 3, "jsonl", index="i")).read())
    assert [m["rows"] for m in manifest] == [3, 2, 2]
    assert [json.loads(line)["v"] for line in open(tmp_path / "s/shard-00000.jsonl")] == ["r0", "r1", "r2"]
    assert [json.loads(line)["v"] for line in open(tmp_path / "s/shard-00002.jsonl")] == ["r5", "r6"]
    assert {r["shard"]: r["rows"] for r in writers.shard_sizes(df, 3, "i").collect()} == {0: 3, 1: 2, 2: 2}
    empty = json.loads(open(writers.write_shards(df.limit(0), str(tmp_path / "e"), 3, "parquet", index="i")).read())
    assert [m["rows"] for m in empty] == [0]


def test_export_and_chunks(spark, tmp_path):
    df = spark.createDataFrame([("a", (3,)), ("b", (4,))], "sample_id string, stats struct<num_token:int>")
    writers.export(df, writers.Export(path=str(tmp_path / "o.jsonl")), single_file=True)
    assert [json.loads(line) for line in open(tmp_path / "o.jsonl")] == [{"sample_id": "a"}, {"sample_id": "b"}]
    assert spark.read.json(str(tmp_path / "o_stats")).count() == 2
    writers.export(df, writers.Export(path=str(tmp_path / "p.parquet"), keep_stats_in_result=True, export_shard_size=10))
    assert spark.read.parquet(str(tmp_path / "p.parquet")).columns == ["sample_id", "stats"]
    made = writers.write_chunks(spark.range(5).repartition(1), str(tmp_path / "c"), 2)
    assert [m["path"].rsplit("/", 1)[1] for m in made] == ["chunk_0_0.json", "chunk_0_1.json", "chunk_0_2.json"]
    with pytest.raises(ValueError):
        writers.export_type_of("x.odd")


def test_chunk_readers(spark, tmp_path):
    from pyspark.sql import functions as F

    (tmp_path / "d" / "sub").mkdir(parents=True)
    pd.DataFrame({"text": ["x"], "id": [1]}).to_json(tmp_path / "d/sub/a.jsonl.gz", orient="records", lines=True)
    pd.DataFrame({"t": ["y"]}).to_parquet(tmp_path / "p.parquet")
    got = readers.read_chunks(spark, [
        {"path": str(tmp_path / "d"), "format": "jsonl", "glob": "*.jsonl.gz", "recursive": True},
        {"path": str(tmp_path / "p.parquet"), "adapter": lambda d: d.select(F.col("_file").alias("id"), F.col("t").alias("text"))},
    ])
    assert sorted(r["text"] for r in got.collect()) == ["x", "y"]
