"""A Spark data source for Arrow IPC files, Arrow streams and Feather files: one partition per file and record batch."""

from __future__ import annotations

from collections.abc import Iterator
from fnmatch import fnmatch

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.pandas.types import from_arrow_schema
from pyspark.sql.types import StructType

#: Record batches of a file that make one partition at least.
BATCHES_PER_PARTITION = 16


def located(path: str) -> tuple[fs.FileSystem, str]:
    """File system and path of an address (``file:``, ``hdfs:``, ``s3:``, ...) or of a plain path."""
    if "://" in path:
        return fs.FileSystem.from_uri(path)
    return fs.LocalFileSystem(), path.removeprefix("file:")


def _files(path: str) -> list[str]:
    """Addresses of the Arrow files of a file, folder or (for the last part of the path) pattern."""
    system, inside = located(path)
    head = path[: len(path) - len(inside)] if path.endswith(inside) else ""
    folder, _, name = inside.rpartition("/")
    if any(c in name for c in "*?["):
        found = [i.path for i in system.get_file_info(fs.FileSelector(folder or ".", recursive=False)) if i.is_file and fnmatch(i.base_name, name)]
    elif system.get_file_info(inside).type == fs.FileType.Directory:
        found = [i.path for i in system.get_file_info(fs.FileSelector(inside, recursive=True)) if i.is_file and i.base_name.endswith((".arrow", ".feather"))]
    else:
        found = [inside]
    return [head + p for p in sorted(found)]


def _open(path: str) -> pa.ipc.RecordBatchFileReader | pa.ipc.RecordBatchStreamReader:
    """The file form if it is one, else the stream form. Local files are memory-mapped: only what is read is loaded."""
    system, inside = located(path)
    start = (lambda: pa.memory_map(inside)) if isinstance(system, fs.LocalFileSystem) else (lambda: system.open_input_file(inside))
    try:
        return pa.ipc.open_file(start())
    except pa.ArrowInvalid:
        return pa.ipc.open_stream(start())


def write_arrow(df: DataFrame, folder: str, suffix: str = "arrow") -> DataFrame:
    """Write ``df`` as Arrow IPC files (Feather V2 is the same format), one per partition; (path, rows) of each file."""
    system, inside = located(folder)
    system.create_dir(inside, recursive=True)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, path = located(folder)
        target = f"{path}/part-{TaskContext.get().partitionId():05d}.{suffix}"
        writer, rows, out = None, 0, None
        for batch in batches:
            if writer is None:
                out = own.open_output_stream(target)
                writer = pa.ipc.new_file(out, batch.schema)
            writer.write_batch(batch)
            rows += batch.num_rows
        if writer is not None:
            writer.close()
            out.close()
            yield pa.RecordBatch.from_arrays([pa.array([target]), pa.array([rows], pa.int64())], ["path", "rows"])

    written = df.mapInArrow(run, "path string, rows bigint").collect()  # one row per file
    return df.sparkSession.createDataFrame(written, "path string, rows bigint")


class Piece(InputPartition):
    def __init__(self, path: str, start: int, end: int | None):
        self.path, self.start, self.end = path, start, end


class ArrowReader(DataSourceReader):
    def __init__(self, schema: StructType, files: list[str]):
        self.schema, self.files = schema, files

    def partitions(self) -> list[Piece]:
        pieces = []
        for path in self.files:
            opened = _open(path)
            if isinstance(opened, pa.ipc.RecordBatchFileReader):
                count = opened.num_record_batches
                pieces += [Piece(path, k, min(k + BATCHES_PER_PARTITION, count)) for k in range(0, count, BATCHES_PER_PARTITION)]
            else:
                pieces.append(Piece(path, 0, None))
        return pieces

    def read(self, partition: Piece) -> Iterator[pa.RecordBatch]:
        if partition is None:
            return
        names = self.schema.names
        opened = _open(partition.path)
        batches = iter(opened) if partition.end is None else (opened.get_batch(k) for k in range(partition.start, partition.end))
        for batch in batches:
            there = set(batch.schema.names)
            columns = [_plain(batch.column(n)) if n in there else pa.nulls(batch.num_rows) for n in names]
            yield pa.RecordBatch.from_arrays(columns, names)


def _plain(array: pa.Array) -> pa.Array:
    """Arrow types that Spark does not read, as ones it does."""
    if pa.types.is_dictionary(array.type):
        return array.dictionary_decode()
    if pa.types.is_large_string(array.type):
        return array.cast(pa.string())
    if pa.types.is_large_binary(array.type):
        return array.cast(pa.binary())
    if pa.types.is_large_list(array.type):
        return array.cast(pa.list_(array.type.value_type))
    if pa.types.is_timestamp(array.type) and array.type.unit != "us":
        return array.cast(pa.timestamp("us", array.type.tz), safe=False)
    if pa.types.is_unsigned_integer(array.type):
        return array.cast(pa.int64())
    if pa.types.is_null(array.type):
        return array.cast(pa.string())
    return array


def _plain_type(kind: pa.DataType) -> pa.DataType:
    return _plain(pa.nulls(0, kind)).type if not pa.types.is_dictionary(kind) else kind.value_type


class ArrowSource(DataSource):
    """``spark.read.format("tidewright_arrow").load(path)`` for a file, a folder or a glob; the first file's schema."""

    @classmethod
    def name(cls) -> str:
        return "tidewright_arrow"

    def _paths(self) -> list[str]:
        found = _files(self.options["path"])
        if not found:
            raise ValueError(f"no Arrow files at {self.options['path']}")
        return found

    def schema(self) -> StructType:
        first = _open(self._paths()[0]).schema
        return from_arrow_schema(pa.schema([pa.field(f.name, _plain_type(f.type)) for f in first]))

    def reader(self, schema: StructType) -> ArrowReader:
        return ArrowReader(schema, self._paths())


def register(spark: SparkSession) -> None:
    spark.dataSource.register(ArrowSource)
