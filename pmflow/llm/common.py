"""Helpers shared by the training-data operators.

``append_columns`` runs a function over Arrow batches of a DataFrame and adds
its columns to the rows. An input column whose name equals an output's (names
compare without case, as Spark compares them) is replaced by the output; all
other columns pass through.
"""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from pmflow.session import scratch_path

#: Rows and bytes of an Arrow batch: a batch of long documents stays small.
BATCH_ROWS = 1000
BATCH_BYTES = 4 << 20


#: What operators keep in a Python worker from task to task, by operator.
KEPT: dict[str, dict] = {}


def lean_worker(keep: str = "") -> None:
    """Give back what an earlier task of this Python worker has freed, and what
    other operators than ``keep`` kept in it: workers live on from stage to
    stage, and would keep a stage's peak."""
    for name, held in KEPT.items():
        if name != keep:
            held.clear()
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except AttributeError:  # another C library than glibc
        pass


def bounded_batches(spark: SparkSession) -> None:
    """Bound the Arrow batches sent to Python by rows and bytes."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def others(df: DataFrame, names: Iterable[str]) -> list[str]:
    """Columns of ``df`` whose names don't clash with ``names``."""
    taken = {n.lower() for n in names}
    return [c for c in df.columns if c.lower() not in taken]


def column(name: str):
    """A column by its plain name, dots and all."""
    return F.col("`" + name.replace("`", "``") + "`")


def append_columns(df: DataFrame, inputs: dict[str, object], schema: str,
                   make: Callable[[], Callable[..., list]], drop: Iterable[str] = (), keep_worker: str = "") -> DataFrame:
    """``df`` with the columns of ``schema`` (DDL) appended.

    ``inputs`` maps argument names to Columns. ``make()`` runs once in a task
    and returns ``fn(**lists) -> list of columns``, each a list or an Arrow
    array as long as the batch. ``drop`` names columns that are not passed on,
    ``keep_worker`` the operator whose ``KEPT`` the tasks use.
    """
    bounded_batches(df.sparkSession)
    out = T.StructType.fromDDL(schema)
    keep = others(df, [f.name for f in out.fields] + list(drop))
    keep_fields = [df.schema[c] for c in keep]
    full = T.StructType([T.StructField(f.name, f.dataType, True) for f in keep_fields] + out.fields)
    arrow = to_arrow_schema(full)
    n_keep, names = len(keep), list(inputs)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lean_worker(keep_worker)
        fn = make()
        for b in batches:
            args = {n: b.column(n_keep + i).to_pylist() for i, n in enumerate(names)}
            cols = fn(**args)
            made = [c if isinstance(c, pa.Array) else pa.array(c, arrow.field(n_keep + i).type)
                    for i, c in enumerate(cols)]
            kept = [b.column(i) for i in range(n_keep)]
            yield pa.RecordBatch.from_arrays(kept + made, names=arrow.names)
        del fn
        lean_worker(keep_worker)

    given = df.select(*[column(c) for c in keep], *[c.alias(f"_in_{n}") for n, c in inputs.items()])
    return given.mapInArrow(run, full)


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` under the shared checkpoint folder and read it back: cuts
    the lineage, survives lost executors, and is computed once."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def place(df: DataFrame, order: list, name: str, group: str | None = None) -> DataFrame:
    """``df`` as a written table with ``at`` (its place, from 0, under ``order``,
    a list of Columns that ends in tie-breakers); with ``group``, a column by
    which ``order`` begins (nulls first), also ``group_no`` (the group's place),
    ``group_at`` (place within the group) and ``group_n`` (its rows). The rows are range-sorted, so a group of any size is
    spread over tasks, and numbered by the rows that stand in earlier partitions:
    only counts per partition (and group) meet in a window, no rows."""
    sorted_ = df.repartitionByRange(*order).sortWithinPartitions(*order)
    t = materialise(sorted_.withColumn("_id", F.monotonically_increasing_id()), name)
    part, within = F.shiftright("_id", 33), F.col("_id").bitwiseAND((1 << 33) - 1)
    t = t.withColumns({"_part": part, "_in": within}).drop("_id")
    if group is None:
        # a row per partition of the sort: bounded by their number
        counts = t.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
        before = counts.select("_part", (F.sum("_n").over(Window.orderBy("_part")) - F.col("_n")).alias("_before"))
        t = t.join(F.broadcast(before), "_part").withColumn("at", F.col("_before") + F.col("_in"))
        return t.drop("_part", "_in", "_before")
    counts = materialise(t.groupBy("_part", F.col(group).alias("_g")).agg(
        F.count(F.lit(1)).alias("_n"), F.min("_in").alias("_first")), f"{name}-counts")
    whole = counts.groupBy("_part").agg(F.sum("_n").alias("_rows"))
    whole = whole.select("_part", (F.sum("_rows").over(Window.orderBy("_part")) - F.col("_rows")).alias("_before"))
    numbers = place(counts.select("_g").distinct(), [F.asc_nulls_first("_g")], f"{name}-groups")
    numbers = numbers.select(F.col("_g").alias("_no_g"), F.col("at").alias("group_no"))
    own = Window.partitionBy("_g")
    here = counts.select("_part", "_g", "_first", F.sum("_n").over(own).alias("group_n"),
                         (F.sum("_n").over(own.orderBy("_part")) - F.col("_n")).alias("_group_before"))
    here = here.join(numbers, F.col("_g").eqNullSafe(F.col("_no_g"))).join(F.broadcast(whole), "_part")
    here = here.withColumnRenamed("_part", "_p")
    t = t.join(here, (F.col("_part") == F.col("_p")) & F.col(group).eqNullSafe(F.col("_g")))
    return t.withColumns({"at": F.col("_before") + F.col("_in"),
                          "group_at": F.col("_group_before") + F.col("_in") - F.col("_first")}).drop(
        "_part", "_p", "_g", "_no_g", "_in", "_first", "_before", "_group_before")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")
