"""Where intermediate tables go, and numbering of rows by an order."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_folder(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``; a temporary one only where none is set.

    All executors must see it, so on a cluster a missing setting is an error. The
    fallback is for one-machine sessions such as tests.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        context = spark.sparkContext._jsc.sc()
        current = context.getCheckpointDir()
        if current.isDefined():
            return current.get()
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("Set spark.checkpoint.dir to a folder that all executors see.")
        folder = tempfile.mkdtemp(prefix="rosterlink-")
        spark.sparkContext.setCheckpointDir(folder)
    return folder


def settled(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared folder once and read it back: lineage ends, lost executors cost nothing."""
    spark = df.sparkSession
    path = f"{shared_folder(spark).rstrip('/')}/{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def numbered(df: DataFrame, order: list[Column], name: str) -> DataFrame:
    """Add the dense position (from 0) by ``order``, nulls placed as the order says.

    Rows are dealt out by range and written once; only the row counts of the
    ranges meet on the driver. Rows equal in ``order`` stand in any order, so
    give an order that tells rows apart.
    """
    ranged = df.repartitionByRange(*order).sortWithinPartitions(*order)
    # The lower 33 bits of the id count the rows of a partition, the upper ones name it.
    ranged = settled(ranged.withColumn("_at", F.monotonically_increasing_id()))
    part = F.shiftright("_at", 33)
    counts = dict(ranged.groupBy(part.alias("part")).count().collect())
    # Rows before each range, found by the range's number.
    offsets, total = [], 0
    for key in range(max(counts, default=-1) + 1):
        offsets.append(total)
        total += counts.get(key, 0)
    base = F.get(F.array(*map(F.lit, offsets)).cast("array<bigint>"), part.cast("int")) if offsets else F.lit(0)
    return ranged.withColumn(name, (base + F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))).cast("long")).drop("_at")
