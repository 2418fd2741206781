"""Uniform shuffle into shards of exact size by a hypergeometric communication matrix.

Rows fall into blocks by a hash of their id and contents. The driver counts the blocks and
draws, block after block, how many of its rows go to each shard: a multivariate
hypergeometric draw from the room the shards have left, so column sums are the
shard sizes (at most one apart) and every assignment is equally likely. Then
each block permutes its rows and deals the drawn counts, rows are exchanged,
and each shard permutes what it received; the position is the row's slot.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import groups_for, packed, small_or_shuffled, unpacked


def communication_matrix(block_rows: list[int], shards: int, seed: int) -> np.ndarray:
    """Draw the block-by-shard counts; rows sum to ``block_rows``, columns are at most one apart."""
    total, rng = sum(block_rows), np.random.default_rng(seed)
    room = np.full(shards, total // shards, dtype=np.int64)
    room[rng.permutation(shards)[: total % shards]] += 1
    matrix = np.zeros((len(block_rows), shards), dtype=np.int64)
    for i, n in enumerate(block_rows):
        matrix[i] = rng.multivariate_hypergeometric(room, n, method="marginals")
        room -= matrix[i]
    return matrix


def shuffle_into_shards(df: DataFrame, shards: int = 8, id_col: str = "doc_id", seed: int = 20240607) -> DataFrame:
    """Put every row into one of ``shards`` shards; add ``shard`` (int) and ``slot`` (long).

    Shard sizes differ by at most one row; slots of a shard run from 0 without
    gaps, in uniformly random order. The same rows, ids and seed give the same
    result on any cluster.

    Null ids are ids like any other. Rows that repeat an id, null included, are
    told apart by their contents and spread by them over the blocks; only rows
    that are equal in everything share one. Texts are carried, never read beyond
    a hash, so empty and very long ones make no difference. An empty table gives
    an empty result. All input columns are returned; one that is named ``shard``
    or ``slot`` is replaced.

    The driver holds one count for each block and shard and for each cell. There
    are 2 ** 22 of these at most, so 32 MB; beyond that blocks have more than
    16,384 rows, which a task sorts and spills.
    """
    if shards < 1:
        raise ValueError("shards must be positive")
    spark, rows = df.sparkSession, df.count()
    blocks = groups_for(rows, most=max(256, min(1 << 16, (1 << 22) // shards)))
    contents = F.xxhash64(*[F.col(f"`{c}`") for c, kind in df.dtypes if "map<" not in kind])
    block = F.pmod(F.xxhash64(F.lit(seed), F.col(id_col), contents), F.lit(blocks)).cast("int")
    counted = sorted(map(tuple, df.groupBy(block.alias("b")).count().collect()))
    matrix = communication_matrix([n for _, n in counted], shards, seed)
    ends = np.cumsum(matrix, axis=1)
    dealt = spark.createDataFrame([(b, n, e.tolist()) for (b, n), e in zip(counted, ends)], "_block int, _rows long, _ends array<long>")
    dealt_bytes = len(counted) * (shards + 2) * 8
    bits = max(0, (blocks // shards - 1).bit_length())

    def placed(frame: DataFrame) -> DataFrame:
        """From block and rank: the shard, the key that orders it, and the cell of that order."""
        mix = F.xxhash64(F.lit(seed + 2), F.col("_block"), F.col("_rank"))
        cell = F.shiftrightunsigned(mix, 64 - bits) if bits else F.lit(0).cast("long")
        return frame.withColumns({"_shard": F.size(F.filter("_ends", lambda e: e <= F.col("_rank"))), "_mix": mix, "_cell": cell})

    # Blocks and ranks alone fix every cell's size: no second look at the data.
    ranks = small_or_shuffled(dealt, dealt_bytes).repartition("_block").select("_block", "_ends", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_rows") - 1)).alias("_rank"))
    cells = sorted(map(tuple, placed(ranks).groupBy("_shard", "_cell").count().collect()))
    starts, at, last = [], 0, None
    for shard, cell, n in cells:
        at = 0 if shard != last else at
        starts.append((shard, cell, at))
        at, last = at + n, shard
    starts_df = spark.createDataFrame(starts, "_shard int, _cell long, _start long")

    work = packed(df, _block=block, _id=F.col(id_col), _hash=contents)
    local = Window.partitionBy("_block").orderBy(F.xxhash64(F.lit(seed + 1), F.col("_id")), "_id", "_hash")
    ranked = work.withColumn("_rank", (F.row_number().over(local) - 1).cast("long")).drop("_id", "_hash")
    sent = placed(ranked.join(small_or_shuffled(dealt, dealt_bytes), "_block")).drop("_ends", "_rows")
    arrived = Window.partitionBy("_shard", "_cell").orderBy("_mix", "_block", "_rank")
    slotted = sent.withColumn("_at", F.row_number().over(arrived) - 1).join(small_or_shuffled(starts_df, len(starts) * 24), ["_shard", "_cell"])
    return unpacked(slotted, df.columns, shard=F.col("_shard").cast("int"), slot=(F.col("_start") + F.col("_at")).cast("long"))
