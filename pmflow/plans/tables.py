"""Table storage on plain Parquet: versioned full rewrites, per-partition
idempotent overwrites, and the processed-file manifest.

A full refresh never overwrites a path that is being read: the new data goes
to a fresh version folder, and a one-row commit record is appended to the
table's ``_versions`` log afterwards. Readers take the newest committed
version, so a failed or half-written job is never visible (S10, Q13 of the
reference's DELETE+INSERT transaction).
"""

from __future__ import annotations

import time
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

VERSION_LOG = "_versions"
#: How tables are compressed: facts are mostly long, padded text.
CODEC = "zstd"
#: Files that a task writes at a time.
WRITERS = 8
LOG_SCHEMA = "table string, version string, path string, committed_ms long, tag string"


def _log_path(root: str, name: str) -> str:
    return f"{root.rstrip('/')}/{name}/{VERSION_LOG}"


def one_row(spark: SparkSession, schema: str, *values) -> DataFrame:
    """A row of plain values, without a Python worker (``schema``: name type, ...)."""
    fields = [f.strip().split(" ", 1) for f in schema.split(", ")]
    row = spark.range(1, numPartitions=1)
    return row.select(*[F.lit(v).cast(t).alias(n) for (n, t), v in zip(fields, values)])


def exists(spark: SparkSession, path: str) -> bool:
    """Whether there is anything at ``path``, on whatever filesystem it names."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def make_folder(spark: SparkSession, path: str) -> None:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(p)


def remove(spark: SparkSession, path: str) -> None:
    """Remove a folder that nothing refers to any more."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def folder_values(spark: SparkSession, path: str, name: str) -> set[int]:
    """The numbers in the names of a table's ``name=...`` folders."""
    if not exists(spark, path):
        return set()
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    names = [f.getPath().getName() for f in p.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(p)]
    return {int(n.removeprefix(f"{name}=")) for n in names if n.startswith(f"{name}=")}


def batches(spark: SparkSession, path: str) -> set[int]:
    """The numbers of a table's batches."""
    return folder_values(spark, path, "batch")


def write_version(df: DataFrame, root: str, name: str, *, partition_by: list[str] | None = None,
                  tag: str | None = None) -> str:
    """Write ``df`` as a new version of table ``name``; commit it last. ``tag``
    says which input the version holds (see ``current_tag``)."""
    spark = df.sparkSession
    version = f"v{int(time.time() * 1000)}-{uuid.uuid4().hex[:8]}"
    path = f"{root.rstrip('/')}/{name}/{version}"
    w = df.write.mode("overwrite").option("compression", CODEC)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
    commit = one_row(spark, LOG_SCHEMA, name, version, path, int(time.time() * 1000), tag)
    commit.write.mode("append").parquet(_log_path(root, name))
    return path


def _commits(spark: SparkSession, root: str, name: str) -> DataFrame | None:
    path = _log_path(root, name)
    if not exists(spark, path):
        return None
    return spark.read.schema(LOG_SCHEMA).parquet(path)


def current_path(spark: SparkSession, root: str, name: str) -> str | None:
    log = _commits(spark, root, name)
    if log is None:
        return None
    row = log.orderBy(F.col("committed_ms").desc(), F.col("version").desc()).select("path").first()
    return row[0] if row else None


def current_tag(spark: SparkSession, root: str, name: str) -> str | None:
    log = _commits(spark, root, name)
    if log is None:
        return None
    row = log.orderBy(F.col("committed_ms").desc(), F.col("version").desc()).select("tag").first()
    return row[0] if row else None


def committed(spark: SparkSession, root: str, name: str, tag: str) -> bool:
    """Whether some version was committed with ``tag``: a replayed input is not
    applied twice."""
    log = _commits(spark, root, name)
    return log is not None and not log.where(F.col("tag") == tag).isEmpty()


def read_current(spark: SparkSession, root: str, name: str) -> DataFrame | None:
    p = current_path(spark, root, name)
    return spark.read.parquet(p) if p else None


def overwrite_partitions(df: DataFrame, path: str, partition_by: list[str]) -> None:
    """Idempotent rewrite of exactly the partitions present in ``df`` (S8):
    dynamic partition overwrite, so a rerun of one source file replaces only
    its own output."""
    df.sparkSession.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    df.write.mode("overwrite").option("compression", CODEC).partitionBy(*partition_by).parquet(path)


def append(df: DataFrame, path: str, partition_by: list[str] | None = None) -> None:
    w = df.write.mode("append").option("compression", CODEC)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def read_or_none(spark: SparkSession, path: str, schema=None) -> DataFrame | None:
    """The table at ``path``, None if nothing is there (no folder, or no file in
    it: a partitioned write of no rows); other errors rise."""
    if not exists(spark, path):
        return None
    r = spark.read
    if schema is not None:
        r = r.schema(schema)
    try:
        return r.parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "UNABLE_TO_INFER_SCHEMA":
            raise
        return None


def write_batch(df: DataFrame, path: str, batch: int, partition_by: list[str] | None = None) -> None:
    """One numbered batch of a table: a batch that runs again replaces itself.
    Tasks that hold few partitions, as after a rebalance, write them side by side,
    without sorting their rows; more than ``WRITERS`` are sorted from there on."""
    w = df.write.mode("overwrite").option("partitionOverwriteMode", "static").option("compression", CODEC)
    if partition_by:
        w = w.partitionBy(*partition_by)
    conf, name = df.sparkSession.conf, "spark.sql.maxConcurrentOutputFileWriters"
    before = conf.get(name)
    conf.set(name, str(WRITERS))
    try:
        w.parquet(f"{path}/batch={batch}")
    finally:
        conf.set(name, before)


def other_batches(table: DataFrame | None, batch: int) -> DataFrame | None:
    """The rows of all batches but ``batch``, which may be one that comes again
    (a partition filter)."""
    return table if table is None else table.where(F.col("batch") != batch)


def chunk_start(block, chunk_size: int):
    """The first block of a block's range."""
    return block - F.pmod(block, F.lit(int(chunk_size)))


def write_by_chunk(df: DataFrame, path: str, chunk_size: int, *, batch: int | None = None,
                   block_col: str = "block_number") -> None:
    """Blocks / trades stored per block range (``chunk_start``). A re-fetched
    range replaces only itself; with ``batch``, a batch replaces only itself and
    ranges of others stay."""
    out = df.withColumn("chunk_start", chunk_start(F.col(block_col), chunk_size))
    if batch is None:
        overwrite_partitions(out, path, ["chunk_start"])
    else:
        write_batch(out.hint("rebalance", "chunk_start"), path, batch, ["chunk_start"])


def resolve_data_root(spark: SparkSession, base: str, subdir: str = "trades",
                      candidates: tuple[str, ...] = ("exchange", "data/exchange")) -> str | None:
    """The raw root is ``base/<c>`` for the first candidate whose ``subdir`` is readable."""
    for c in candidates:
        root = f"{base.rstrip('/')}/{c}"
        if read_or_none(spark, f"{root}/{subdir}") is not None:
            return root
    return None
