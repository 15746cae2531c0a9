"""Writing: contiguous shards with a manifest, exports, chunks, and single files."""

from __future__ import annotations

import json
import os
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from typing import Any

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidewright.runtime import broadcast_if_small, running_sum
from tidewright.sources.files import delete, move, parts, write_text
from tidewright.sources.readers import with_position

#: Spark writers by export type.
WRITERS = {"parquet": "parquet", "jsonl": "json", "json": "json", "csv": "csv", "orc": "orc"}


@dataclass
class Sharding:
    enabled: bool = True
    rows_per_shard: int = 50000
    export_type: str = "parquet"
    output_dir: str | None = None


@dataclass
class Export:
    path: str = "outputs/tidewright/cleaned.parquet"
    export_type: str | None = None
    export_shard_size: int = 0
    export_stats: bool = True
    keep_stats_in_result: bool = False
    keep_hashes_in_result: bool = False
    #: Keep the order of the records. That sorts the whole result; a large one that needs no order is written faster without.
    ordered: bool = True


def shard_count(rows: int, rows_per_shard: int) -> int:
    """Shards for so many rows: at least one."""
    return max(1, -(-rows // max(1, rows_per_shard)))


def assign_shards(df: DataFrame, rows: int, rows_per_shard: int, position: str) -> DataFrame:
    """``df`` with ``shard``: contiguous shards whose sizes differ by one at most, larger ones first.

    ``position`` numbers the rows from 0 without gaps; the shard follows from it by arithmetic, without a sort.
    """
    count = shard_count(rows, rows_per_shard)
    size, larger = divmod(rows, count)
    at, turn = F.col(position), larger * (size + 1)
    tail = F.lit(larger) + F.floor((at - turn) / max(1, size))
    return df.withColumn("shard", F.when(at < turn, F.floor(at / (size + 1))).otherwise(tail).cast("int"))


#: Numbers of one bucket when rows are counted in order.
BUCKET = 10_000


def dense_position(df: DataFrame, index: str, group: str | None = None, out: str = "_position") -> DataFrame:
    """``df`` with each row's rank from 0 in the order (``group``, ``index``); ``index`` is a whole number per row.

    Rows are counted by buckets of neighbouring numbers, the bucket counts are added up, and each bucket ranks its own
    rows: no task sorts the whole, and the result does not depend on how the table is partitioned.
    """
    keyed = df.withColumn("_group", (F.col(group) if group else F.lit(0)).cast("int")).withColumn("_bucket", F.floor(F.col(index) / BUCKET)).withColumn("_one", F.lit(1).cast("bigint"))
    inside = running_sum(keyed, ["_group"], "_bucket", [index], "_one", "_inside")
    sizes = keyed.groupBy("_group").agg(F.count(F.lit(1)).alias("_size"))
    before = Window.orderBy("_group").rowsBetween(Window.unboundedPreceding, -1)  # one row per source
    starts = sizes.select("_group", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_start"))
    return inside.join(broadcast_if_small(starts), "_group").withColumn(out, F.col("_start") + F.col("_inside")).drop("_group", "_bucket", "_one", "_inside", "_start")


def shard_sizes(df: DataFrame, rows_per_shard: int, index: str, group: str | None = None) -> DataFrame:
    """(shard, rows) that :func:`write_shards` would write for rows in this order."""
    placed = dense_position(df.select(index, *([group] if group else [])), index, group)
    return assign_shards(placed, df.count(), rows_per_shard, "_position").groupBy("shard").agg(F.count(F.lit(1)).alias("rows"))


#: Files renamed at once; a rename is a request to the name service and moves no data.
RENAMES_AT_ONCE = 16


def write_shards(df: DataFrame, folder: str, rows_per_shard: int, export_type: str = "parquet", index: str | None = None, group: str | None = None) -> str:
    """Write ``df`` as ``shard-00000.<type>`` ... with ``manifest.json``, in the order (``group``, ``index``); the manifest's path.

    Without ``index`` the order is that of the files ``df`` reads. The order columns are not written. Every shard is one
    file, written by the task that holds its rows; an empty table yields one empty shard.
    """
    spark = df.sparkSession
    numbered = dense_position(df, index, group) if index else with_position(df)
    dropped = [c for c in (index, group) if c]
    numbered, df = numbered.drop(*dropped), df.drop(*dropped)
    rows = df.count()
    count = shard_count(rows, rows_per_shard)
    staged = f"{folder}/_staged"
    sharded = assign_shards(numbered, rows, rows_per_shard, "_position")
    ordered = sharded.repartitionByRange(count, "shard").sortWithinPartitions("shard", "_position").drop("_position")
    ordered.write.mode("overwrite").partitionBy("shard").format(WRITERS[export_type]).save(staged)
    sizes = {r["shard"]: r["rows"] for r in sharded.groupBy("shard").agg(F.count(F.lit(1)).alias("rows")).collect()}  # one row per shard, as in the manifest

    def place(shard: int) -> dict[str, Any]:
        target = f"{folder}/shard-{shard:05d}.{export_type}"
        found = parts(spark, f"{staged}/shard={shard}") if sizes.get(shard) else []
        if len(found) == 1:
            move(spark, found[0], target)
        elif not found:
            write_single(df.limit(0), target, export_type)
        else:
            write_single(spark.read.format(WRITERS[export_type]).schema(df.schema).load(f"{staged}/shard={shard}"), target, export_type)
        return {"shard_id": shard, "rows": sizes.get(shard, 0), "path": target}

    with ThreadPoolExecutor(RENAMES_AT_ONCE) as pool:
        manifest = list(pool.map(place, range(count)))
    delete(spark, staged)
    path = f"{folder}/manifest.json"
    write_text(spark, path, json.dumps(manifest, ensure_ascii=False, indent=2))
    return path


def write_single(df: DataFrame, path: str, export_type: str = "parquet", **options: Any) -> str:
    """``df`` as one file at ``path``. For small results: all rows pass through one task."""
    spark, folder = df.sparkSession, f"{path}.parts"
    df.coalesce(1).write.mode("overwrite").options(**options).format(WRITERS[export_type]).save(folder)
    found = parts(spark, folder)
    if found:
        move(spark, found[0], path)
    else:
        write_text(spark, path, "")
    delete(spark, folder)
    return path


def export_type_of(path: str, given: str | None = None) -> str:
    """The given type, else the path's suffix."""
    kind = given or os.path.splitext(path)[1].lstrip(".")
    if kind not in WRITERS:
        raise ValueError(f"cannot tell the export type of {path}")
    return kind


#: Columns that belong to other stages' bookkeeping: statistics and hashes.
STATS, HASHES = ("stats",), ("minhash", "_signature")


def export(df: DataFrame, settings: Export, single_file: bool = False) -> str:
    """Write the result; statistics go beside it as ``<path>_stats`` and stay in the result only if wanted.

    A positive shard size bounds the bytes of a file (estimated from the mean row), so large results become a folder of
    files; ``single_file`` makes one file at exactly the path.
    """
    kind = export_type_of(settings.path, settings.export_type)
    stats = [c for c in STATS if c in df.columns]
    dropped = [*([] if settings.keep_stats_in_result else stats), *([] if settings.keep_hashes_in_result else [c for c in HASHES if c in df.columns])]
    if settings.export_stats and stats:
        df.select("sample_id", *stats).write.mode("overwrite").json(f"{os.path.splitext(settings.path)[0]}_stats")
    result = df.drop(*dropped)
    if single_file:
        return write_single(result, settings.path, kind)
    writer = result.write.mode("overwrite")
    if settings.export_shard_size > 0:
        mean = result.select(F.avg(F.length(F.to_json(F.struct(*result.columns))))).first()[0] or 1.0
        writer = writer.option("maxRecordsPerFile", max(1, int(settings.export_shard_size / mean)))
    writer.format(WRITERS[kind]).save(settings.path)
    return settings.path


def write_chunks(df: DataFrame, folder: str, chunk_size: int, compression: str | None = None) -> list[dict[str, Any]]:
    """JSON lines in files of at most ``chunk_size`` records named ``chunk_<task>_<number>``; (path, records) of each."""
    spark, staged = df.sparkSession, f"{folder}/_staged"
    df.write.mode("overwrite").option("maxRecordsPerFile", chunk_size).options(**({"compression": compression} if compression else {})).json(staged)
    written, numbers = [], {}
    for part in parts(spark, staged):
        name = part.rsplit("/", 1)[-1]
        task = int(name.split("-")[1])
        number = numbers[task] = numbers.get(task, -1) + 1
        target = f"{folder}/chunk_{task}_{number}{name[name.index('.json') :]}"
        move(spark, part, target)
        written.append({"path": target})
    delete(spark, staged)
    return written
