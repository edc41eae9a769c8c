"""Running sums and numbering of rows, and cutting of lineage for iterative operators."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _folder(df: DataFrame) -> str:
    """The folder that spark.checkpoint.dir names; a temporary one only where that is unset on a local master (tests)."""
    sc = df.sparkSession.sparkContext
    if not sc.getCheckpointDir():
        where = df.sparkSession.conf.get("spark.checkpoint.dir", None)
        if not where and not re.fullmatch(r"local(\[.*\])?", sc.master):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        sc.setCheckpointDir(where or tempfile.mkdtemp(prefix="spark-checkpoint-"))
    return sc.getCheckpointDir()


def checkpointed(df: DataFrame) -> DataFrame:
    """``df`` in the checkpoints' folder."""
    _folder(df)
    return df.checkpoint()


def written(df: DataFrame) -> DataFrame:
    """``df`` as packed files in the checkpoints' folder: a fraction of a checkpoint, but read in other parts than written."""
    where = f"{_folder(df)}/{uuid.uuid4().hex}"
    df.write.parquet(where)
    return df.sparkSession.read.schema(df.schema).parquet(where)


def running_sums(df: DataFrame, sums: dict[str, Column], *order: Column) -> DataFrame:
    """``df`` with, for each name, the bigint sum of its values over the rows before in a total order, without a single-task window.

    Rows are sorted by range; each range's sums start after those of the ranges before it.
    """
    values = {f"_value_{name}": v.cast("bigint") for name, v in sums.items()}
    ranged = checkpointed(df.withColumns(values).repartitionByRange(*order).withColumn("_range", F.spark_partition_id()))
    totals = ranged.groupBy("_range").agg(*(F.sum(v).alias(v) for v in values)).collect()  # one row a partition
    before, so_far = [], dict.fromkeys(values, 0)
    for r in sorted(totals):
        before += [F.lit(r._range), F.struct(*(F.lit(n).cast("bigint").alias(v) for v, n in so_far.items()))]
        so_far = {v: n + r[v] for v, n in so_far.items()}
    if not before:
        return df.withColumns({name: F.lit(0).cast("bigint") for name in sums})
    within = Window.partitionBy("_range").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    start = F.element_at(F.create_map(*before), F.col("_range"))
    return ranged.withColumns({name: (F.coalesce(F.sum(v).over(within), F.lit(0)) + start[v]).cast("bigint") for name, v in zip(sums, values)}).drop("_range", *values)


def numbered(df: DataFrame, name: str, *order: Column) -> DataFrame:
    """``df`` with a bigint column of positions from 0 in a total order."""
    return running_sums(df, {name: F.lit(1)}, *order)
