"""Session helpers shared by all operators: shared storage, lineage cuts, size-checked broadcasts."""

from __future__ import annotations

import atexit
import re
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows a side may have and still be broadcast. At the row widths used here (under 200 bytes) this stays below 20 MB.
BROADCAST_ROWS = 100_000

_written: list[tuple[SparkSession, str]] = []


def build_session(app: str = "tidewright", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the operators rely on; existing settings of a cluster win."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    defaults = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.ui.enabled": "false",
    }
    for key, value in {**defaults, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """Folder that all executors reach: ``spark.checkpoint.dir``, else the context's checkpoint folder.

    Only when neither is set and the master is local (one machine, as in tests) is a folder of our own made.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    sc = spark.sparkContext
    current = sc.getCheckpointDir() if hasattr(sc, "getCheckpointDir") else None
    if current:
        return current.rstrip("/")
    if not sc.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="tidewright-"))
    return sc.getCheckpointDir().rstrip("/")


def materialize(df: DataFrame, label: str = "table", *folders: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: a lineage cut that survives the loss of executors.

    With ``folders``, columns of few values, the table is laid out by them, and a filter on them reads its folder only.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/tidewright-{label}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").partitionBy(*folders).parquet(path)
    _written.append((spark, path))
    table = spark.read.schema(df.schema).parquet(path)
    table._written_path = path
    return table


def scratch(spark: SparkSession, label: str) -> str:
    """A new place in the shared folder for files that :func:`release` deletes."""
    path = f"{shared_dir(spark)}/tidewright-{label}-{uuid.uuid4().hex}"
    _written.append((spark, path))
    return path


def _delete(spark: SparkSession, path: str) -> None:
    try:
        target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)
    except Exception:  # the session may be gone already
        pass


def discard(*tables: DataFrame) -> None:
    """Delete tables of :func:`materialize` that nothing reads any more: all that was made of them has been written."""
    for table in tables:
        entry = (table.sparkSession, table._written_path)
        _written.remove(entry)
        _delete(*entry)


def release() -> None:
    """Delete the tables written by :func:`materialize`; called at exit as well."""
    while _written:
        _delete(*_written.pop())


atexit.register(release)


#: Operators of a plan that are not worth running twice, by the names of their nodes. Fixed values.
_COSTLY = ("Aggregate", "Join", "Window", "Distinct", "MapIn", "FlatMap", "EvalPython", "Generate", "Sort")


def _costly(df: DataFrame) -> bool:
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    return any(re.search(rf"^[\s:+-]*{name}", line) for line in plan.splitlines() for name in _COSTLY)


def broadcast_if_small(df: DataFrame, max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Mark ``df`` for broadcast only when a count shows it has at most ``max_rows`` rows; else leave the join to AQE.

    A side that is more than a scan is written first, so that it is not computed once for the count and once for the join.
    """
    side = materialize(df, "side") if _costly(df) else df
    return F.broadcast(side) if side.limit(max_rows + 1).count() <= max_rows else side


def spread(scan: DataFrame) -> DataFrame:
    """A scan with fewer splits than the session has cores, dealt out to all of them; any other scan as it is.

    For files of one row group. Only for scans: asking a plan with a shuffle for its partitions would run it.
    """
    cores = scan.sparkSession.sparkContext.defaultParallelism
    return scan.repartition(cores) if scan.rdd.getNumPartitions() < cores else scan


def latest_by(df: DataFrame, key: str, order: str, columns: dict[str, Column]) -> DataFrame:
    """One row per non-null ``key``: the row with the greatest ``order``, ties broken by the greatest values.

    A partial aggregate runs before the shuffle, so a key that holds a third of all rows stays harmless.
    Null ``order`` counts as the smallest.
    """
    packed = F.struct(F.col(order).alias("_order"), *[c.alias(n) for n, c in columns.items()])
    best = df.where(F.col(key).isNotNull()).groupBy(F.col(key).alias(key)).agg(F.max(packed).alias("_best"))
    return best.select(key, *[F.col(f"_best.{n}").alias(n) for n in columns])


def running_sum(df: DataFrame, keys: list[str], bucket: str, order: list[str], value: str, out: str) -> DataFrame:
    """Exclusive running sum of ``value`` within ``keys`` in the order (``bucket``, ``order``), without one task per key.

    Sums per bucket are added up first (one small row per bucket), then each bucket runs its own window, so a key
    that holds a third of all rows is spread over its buckets.
    """
    from pyspark.sql import Window

    totals = df.groupBy(*keys, bucket).agg(F.sum(value).alias("_total"))
    before = Window.partitionBy(*keys).orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.select(*keys, bucket, F.coalesce(F.sum("_total").over(before), F.lit(0)).alias("_before"))
    inside = Window.partitionBy(*keys, bucket).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return (
        df.join(totals, [*keys, bucket])
        .withColumn(out, F.col("_before") + F.coalesce(F.sum(value).over(inside), F.lit(0)))
        .drop("_before")
    )
