"""Helpers shared by the corpus operators."""

from __future__ import annotations

import math
import tempfile

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Use the cluster's ``spark.checkpoint.dir``; set one only where none is set and the session is local (tests)."""
    sc = spark.sparkContext
    if sc.getConf().get("spark.checkpoint.dir") or sc._jsc.sc().getCheckpointDir().isDefined():
        return
    if sc.master != "local" and not sc.master.startswith("local["):
        raise RuntimeError("set spark.checkpoint.dir to a folder that the whole cluster shares")
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="factloom-checkpoint-"))


def settle(df: DataFrame) -> DataFrame:
    """Compute ``df`` once into the shared checkpoint folder and cut its lineage."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint()


def text_of(column: str = "text") -> Column:
    """The text, with null read as the empty text."""
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def packed(df: DataFrame, **keys: Column) -> DataFrame:
    """All columns as one struct ``_row`` beside ``keys``, so that no column name can clash."""
    return df.select(*[c.alias(n) for n, c in keys.items()], F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("_row"))


def unpacked(df: DataFrame, columns: list[str], **outputs: Column) -> DataFrame:
    """The packed columns again, then ``outputs``; an output replaces an input column of its name."""
    kept = [F.col("_row").getField(c).alias(c) for c in columns if c not in outputs]
    return df.select(*kept, *[c.alias(n) for n, c in outputs.items()])


def groups_for(rows: int, per_group: int = 16384, least: int = 256, most: int = 1 << 16) -> int:
    """How many hash groups keep about ``per_group`` rows each; ``least`` of them on small input, ``most`` on the largest."""
    return min(most, max(least, math.ceil(rows / per_group)))


def small_or_shuffled(df: DataFrame, nbytes: int, most: int = 32 << 20) -> DataFrame:
    """Mark ``df`` for broadcast only if its counted size is within ``most`` bytes."""
    return F.broadcast(df) if nbytes <= most else df
