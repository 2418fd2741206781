"""Matching rules that plain equality joins don't have, as compositions of DataFrame operations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def asof(left: DataFrame, right: DataFrame, by: str | list[str], on: str, value: str, forward: bool = False) -> DataFrame:
    """Add ``value`` of the row of ``right`` nearest before ``on`` (or after, if ``forward``), equal included.

    One shuffle on ``by``: both sides are stacked and the last value seen is
    carried along the order, so no range of rows is paired. Ties in ``right``:
    backward takes the largest value, forward the smallest. Left rows without a
    neighbour get null.
    """
    keys = [by] if isinstance(by, str) else by
    payload = F.struct(*[F.col(c) for c in left.columns])
    stacked = left.select(*keys, F.col(on).alias("_on"), F.lit(1).alias("_side"), payload.alias("_row"), F.lit(None).cast(right.schema[value].dataType).alias("_value")).unionByName(
        right.where(F.col(on).isNotNull()).select(*keys, F.col(on).alias("_on"), F.lit(0).alias("_side"), F.col(value).alias("_value")), allowMissingColumns=True)
    order = [F.desc("_on"), "_side", F.desc("_value")] if forward else ["_on", "_side", "_value"]
    window = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return stacked.withColumn("_found", F.last("_value", True).over(window)).where("_side = 1").select("_row.*", F.when(F.col("_on").isNotNull(), F.col("_found")).alias(value))


def unique_or_null(df: DataFrame, key: str | list[str], value: str) -> DataFrame:
    """(key, value) where the key has exactly one distinct value, else null."""
    keys = [key] if isinstance(key, str) else key
    found = df.groupBy(*keys).agg(F.min(value).alias("_lo"), F.max(value).alias("_hi"))
    return found.select(*keys, F.when(F.col("_lo") == F.col("_hi"), F.col("_lo")).alias(value))


def first_match(candidates: DataFrame, targets: DataFrame, id_col: str, rank: str, candidate: str, target_key: str, result: str) -> DataFrame:
    """(id, result): the target of the smallest rank among an id's candidate keys that exist.

    Candidates are (id, rank, candidate) rows; the join is an equality join, and
    the choice an aggregate.
    """
    hits = candidates.join(targets.select(F.col(target_key).alias(candidate), F.col(result)), candidate)
    return hits.groupBy(id_col).agg(F.min_by(result, F.struct(rank, result)).alias(result))


def longest_prefix(df: DataFrame, prefixes: DataFrame, path: str, prefix: str, *columns: str) -> DataFrame:
    """Add the columns of the longest ``prefix`` that is the path or a folder above it; null if none.

    A path's own ancestors are its only possible prefixes, so they are listed
    and joined by equality: no pair of path and prefix is tried that can't match.
    Equal prefixes: the smallest row.
    """
    parts = F.split(F.col(path), "/")
    ancestors = F.transform(F.sequence(F.lit(1), F.size(parts)), lambda n: F.array_join(F.slice(parts, 1, n), "/"))
    paths = df.select(path).where(F.col(path).isNotNull()).distinct()
    listed = paths.select(path, F.explode(ancestors).alias("_prefix"))
    known = prefixes.select(F.regexp_replace(prefix, "(?<=.)/+$", "").alias("_prefix"), F.struct(*columns).alias("_cols")).groupBy("_prefix").agg(F.min("_cols").alias("_cols"))
    best = listed.join(known, "_prefix").groupBy(path).agg(F.max_by("_cols", F.length("_prefix")).alias("_cols"))
    return df.join(best, path, "left").select(*df.columns, *[F.col("_cols").getField(c).alias(c) for c in columns])


def innermost(points: DataFrame, ranges: DataFrame, by: str | list[str], at: str, start: str, end: str, value: str) -> DataFrame:
    """Add ``value`` of the smallest range with start < at < end: the one that starts last.

    Ranges nest (or are apart), as blocks of a text do. Starts, ends and points
    are swept in order, and the open range is found among the ranges that start
    before, kept per ``by`` group as an array: groups are files, so arrays are small.
    """
    keys = [by] if isinstance(by, str) else by
    held = ranges.groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct(F.col(start).alias("s"), F.col(end).alias("e"), F.col(value).alias("v"))), False).alias("_ranges"))
    joined = points.join(held, keys, "left")
    return joined.select(*points.columns, F.get(F.filter("_ranges", lambda r: (r["s"] < F.col(at)) & (F.col(at) < r["e"])), F.lit(0)).getField("v").alias(value))


def ranked(*choices: Column) -> Column:
    """An array of (rank, candidate) structs of the non-null choices, ranks from 0."""
    listed = F.array(*[F.struct(F.lit(i).alias("rank"), c.alias("candidate")) for i, c in enumerate(choices)])
    return F.filter(listed, lambda x: x["candidate"].isNotNull())
